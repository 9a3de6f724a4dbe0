"""Spreadsheet workbooks. A workbook is one zip file, so one task opens one workbook; a folder of them
is read in parallel. The codec below only turns a workbook's bytes into rows of text."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources.columns import use_columns
from quayside.sources.delimited import decimal_number

ROWS_SCHEMA = "file string, sheet string, sheet_index int, row int, cells array<string>"
_ARROW = pa.schema(
    [
        ("file", pa.string()),
        ("sheet", pa.string()),
        ("sheet_index", pa.int32()),
        ("row", pa.int32()),
        ("cells", pa.list_(pa.string())),
    ]
)
_BATCH = 4096
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Built-in number formats that show a date or time.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _children(element, name: str) -> list:
    return [child for child in element if _tag(child) == name]


def _text(element) -> str:
    """Text of a string item; phonetic hints are not part of it."""
    parts = []
    for child in element:
        if _tag(child) == "t":
            parts.append(child.text or "")
        elif _tag(child) == "r":
            parts += [t.text or "" for t in _children(child, "t")]
    return "".join(parts)


def _column(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        index = index * 26 + ord(letter) - 64
    return index - 1


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Style numbers whose number format is a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    formats = set(_DATE_FORMATS)
    for group in _children(root, "numFmts"):
        for fmt in group:
            code = re.sub(r'"[^"]*"|\\.|\[(?!h|m|s)[^\]]*\]', "", fmt.get("formatCode", "").lower())
            if re.search("[dmyhs]", code):
                formats.add(int(fmt.get("numFmtId")))
    return {
        i
        for group in _children(root, "cellXfs")
        for i, xf in enumerate(group)
        if int(xf.get("numFmtId", 0)) in formats
    }


def _number(raw: str) -> str:
    value = float(raw)
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)


def _moment(raw: str, epoch: datetime) -> str:
    days = float(raw)
    if epoch.year == 1899 and days < 60:
        days += 1  # the format counts a 29 February 1900 that never was
    at = epoch + timedelta(milliseconds=round(days * 86_400_000))
    return at.isoformat(sep=" ")


def _cell(cell, shared: list[str], dates: set[int], epoch: datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = _children(cell, "is")
        return _text(inline[0]) if inline else None
    values = _children(cell, "v")
    raw = values[0].text if values else None
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "true" if raw == "1" else "false"
    if kind in ("str", "d"):
        return raw
    if int(cell.get("s", 0)) in dates:
        return _moment(raw, epoch)
    return _number(raw)


def read_sheets(
    content: bytes, wanted: str | None = None, last_row: int | None = None
) -> Iterator[tuple[str, int, int, list[str | None]]]:
    """``(sheet, sheet index, row, cells)`` of a workbook, streamed row by row.

    ``wanted`` is a sheet's name, or its index in digits; all sheets without it.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
        rels = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        targets = {rel.get("Id"): rel.get("Target") for rel in rels}
        old_mac = any(p.get("date1904") in ("1", "true") for p in _children(workbook, "workbookPr"))
        epoch = datetime(1904, 1, 1) if old_mac else datetime(1899, 12, 30)
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        dates = _date_styles(book)
        sheets = [s for group in _children(workbook, "sheets") for s in group]
        for index, sheet in enumerate(sheets):
            name = sheet.get("name")
            if wanted is not None and wanted != name and wanted != str(index):
                continue
            target = targets[sheet.get(_REL)].lstrip("/")
            with book.open(target if target.startswith("xl/") else f"xl/{target}") as part:
                at, width = -1, 0
                for _, element in ElementTree.iterparse(part):
                    if _tag(element) == "dimension":  # the used range, written before the rows
                        width = _column(element.get("ref").rpartition(":")[2]) + 1
                    if _tag(element) != "row":
                        continue
                    at = int(element.get("r", at + 2)) - 1
                    cells: list[str | None] = []
                    for cell in _children(element, "c"):
                        column = _column(cell.get("r")) if cell.get("r") else len(cells)
                        cells += [None] * (column - len(cells))
                        cells.append(_cell(cell, shared, dates, epoch))
                    cells += [None] * (width - len(cells))
                    element.clear()
                    if last_row is not None and at > last_row:
                        break
                    yield name, index, at, cells


def workbook_files(spark: SparkSession, path: str) -> DataFrame:
    """The workbooks below a path as ``path, content``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xls[xm]").load(path)
    return files.select("path", "content")


def scan_workbooks(files: DataFrame, sheet: str | None = None, last_row: int | None = None) -> DataFrame:
    """Rows of ``path, content`` workbooks: ``file, sheet, sheet_index, row, cells``.

    ``sheet`` is a name or an index in digits; ``None`` reads all. Output goes out in bounded batches.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                for name, index, row, cells in read_sheets(content.as_py(), sheet, last_row):
                    out.append((path.as_py(), name, index, row, cells))
                    if len(out) == _BATCH:
                        yield _batch(out)
                        out = []
        if out:
            yield _batch(out)

    return files.select("path", "content").mapInArrow(rows, ROWS_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, _ARROW)], schema=_ARROW
    )


def sheet_selector(value: str | None) -> str:
    """Blank means the first sheet; digits are an index, other text a name."""
    text = (value or "").strip()
    return str(int(text)) if text.isdigit() else text or "0"


def _unique_names(cells: list[str | None]) -> list[str]:
    """Header cells as names: blanks numbered, repeats with a counter."""
    names: list[str] = []
    for i, cell in enumerate(cells):
        base = cell if cell else f"Unnamed: {i}"
        name, n = base, 0
        while name in names:
            n += 1
            name = f"{base}.{n}"
        names.append(name)
    return names


def sheet_table(
    files: DataFrame,
    sheet: str | None = None,
    header_row: int = 0,
    usecols: str | None = None,
    decimal: str = ".",
    decimal_columns: tuple[str, ...] = (),
) -> DataFrame:
    """One sheet of every workbook as a table of text columns, with ``_file`` and ``_row`` as order.

    Column names come from row ``header_row``. Workbooks may differ in column order: each layout is
    read by its own positions and the columns are put together by name.
    """
    selector = sheet_selector(sheet)
    heads = scan_workbooks(files, selector, header_row).filter(F.col("row") == header_row)
    # distinct header rows: one per layout, not per file
    layouts = [r["cells"] for r in heads.select("cells").distinct().collect()]
    if not layouts:
        raise ValueError(f"no sheet {sheet!r} with a row {header_row}")
    names: list[str] = []
    for cells in layouts:
        names += [n for n in _unique_names(cells) if n not in names]
    rows = scan_workbooks(files, selector).filter(F.col("row") > header_row)
    if len(layouts) == 1:
        value = {n: F.get("cells", F.lit(i)) for i, n in enumerate(names)}
    else:
        head = heads.select("file", F.col("cells").alias("_head"))
        rows = rows.join(head, "file")
        value = {}
        for n in names:
            at = F.lit(None).cast("int")
            for cells in layouts:
                unique = _unique_names(cells)
                if n in unique:
                    same = F.col("_head").eqNullSafe(_array(cells))
                    at = F.when(same, F.lit(unique.index(n))).otherwise(at)
            value[n] = F.get("cells", at)
    place = [F.col("file").alias("_file"), F.col("row").alias("_row")]
    table = rows.select(*place, *[c.alias(n) for n, c in value.items()])
    wanted = use_columns(table.drop("_file", "_row"), usecols).columns
    table = table.select("_file", "_row", *[F.col(f"`{c}`") for c in wanted])
    return table.withColumns({c: decimal_number(F.col(f"`{c}`"), decimal) for c in decimal_columns})


def _array(cells: list[str | None]):
    return F.array(*[F.lit(c).cast("string") for c in cells])


def workbook_fanout(files: DataFrame, sheets: dict[str, str], header_row: int = 0) -> dict[str, DataFrame]:
    """One table per sheet of the same workbooks: ``{output name: sheet}`` to ``{output name: table}``."""
    return {name: sheet_table(files, sheet, header_row) for name, sheet in sheets.items()}
