"""JSON lines, mixed folders, API envelopes and paged documents."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.audit import all_string
from quayside.operators.sets import union_drifting
from quayside.sources.delimited import csv_layouts, scan_delimited

_BROKEN = "_broken_line"
JSON_FILES = "*.{[jJ][sS][oO][nN],[jJ][sS][oO][nN][lL]}"
TEXT_FILES = "*.{[cC][sS][vV],[tT][xX][tT]}"


def scan_json_lines(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    glob: str | None = None,
    as_text: bool = False,
) -> DataFrame:
    """One record per line. Give a schema to save the pass over the data that finds one out.

    ``as_text`` keeps numbers and booleans the way they are written.
    """
    reader = spark.read.option("primitivesAsString", as_text)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def _json_part(spark: SparkSession, path: str) -> DataFrame | None:
    """JSON-lines files as text columns, without the files that hold a line which is no record."""
    options = {"primitivesAsString": "true", "columnNameOfCorruptRecord": _BROKEN}
    try:
        found = spark.read.options(pathGlobFilter=JSON_FILES, **options).json(path).schema
    except AnalysisException:  # no such file
        return None
    fields = [f for f in found if f.name != _BROKEN]
    if not fields:
        return None
    lines = spark.read.option("pathGlobFilter", JSON_FILES).text(path).filter(F.trim("value") != "")
    schema = T.StructType([*fields, T.StructField(_BROKEN, T.StringType())])
    record = F.from_json("value", schema, options)
    rows = lines.select(record.alias("_record"), F.col("_metadata.file_path").alias("source_file"))
    broken = rows.filter(F.col("_record")[_BROKEN].isNotNull()).select("source_file").distinct()
    whole = rows.join(broken, "source_file", "left_anti")
    return all_string(whole.select("_record.*", "source_file").drop(_BROKEN))


def _text_parts(spark: SparkSession, path: str) -> list[DataFrame]:
    parts = []
    for header, files in sorted(csv_layouts(spark, path, TEXT_FILES).items()):
        names = next(csv.reader([header]), [])
        if not any(names):
            continue
        part = scan_delimited(spark, files, columns=names)
        parts.append(part.select("*", F.col("_metadata.file_path").alias("source_file")))
    return parts


def scan_mixed_folder(spark: SparkSession, path: str) -> DataFrame:
    """A folder of JSON-lines and comma-separated files as one all-text table with ``source_file``.

    The extension picks the reader; other files, empty files and JSON files with an unreadable line
    are passed over. Files of different columns are put together by name. The passes that look ahead
    (JSON schema, unreadable lines, first lines) read the data once more each but shuffle none of it.
    """
    parts = [p for p in [_json_part(spark, path), *_text_parts(spark, path)] if p is not None]
    if not parts:
        raise ValueError(f"nothing to read in {path}")
    return union_drifting(parts)


def scan_envelope(documents: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """The elements of each document's ``payload`` array, as JSON text in ``element``.

    A null or missing payload gives no rows; a payload that is no array fails the query.
    """
    # taken from each document once: Spark would copy it into every place that names it, and into filters of its own
    held = documents.select(*keep, F.get_json_object(F.col(body), "$.payload").alias("_payload"))
    payload = F.col("_payload")
    wrong = F.raise_error(F.concat(F.lit("payload is no list: "), payload)).cast("string")
    checked = F.when(payload.isNull() | F.startswith(F.ltrim(payload), F.lit("[")), payload).otherwise(wrong)
    found = held.select(*keep, F.posexplode_outer(F.from_json(checked, "array<string>")).alias("_place", "element"))
    return found.where("_place is not null").drop("_place")


PAGE_HEAD = "data struct<total: bigint, limit: bigint>"


def page_items(pages: DataFrame, item_schema: str, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """The items of all pages, one row each. ``item_schema`` lists an item's fields."""
    parsed = F.from_json(F.col(body), f"data struct<scan: array<struct<{item_schema}>>>")
    return pages.select(*keep, F.explode(parsed["data"]["scan"]).alias("item")).select(*keep, "item.*")


def page_gaps(pages: DataFrame, page: str = "page", body: str = "body") -> DataFrame:
    """Numbers of the pages that should be there and are not.

    The first page's total and limit say how many there should be; without them none is expected.
    The numbers come from a distributed range, as there may be very many.
    """
    head = F.from_json(F.col(body), PAGE_HEAD)["data"]
    first_page = pages.filter(F.col(page) == pages.agg(F.min(page)).scalar())
    first = first_page.select(head["total"].alias("total"), head["limit"].alias("limit")).first()
    last = -(-first["total"] // first["limit"]) if first and first["total"] and first["limit"] else 0
    expected = pages.sparkSession.range(1, last + 1).toDF("page")
    found = pages.filter(F.get_json_object(body, "$.data.scan").isNotNull())
    return expected.join(found.select(F.col(page).cast("bigint").alias("page")), "page", "left_anti")
