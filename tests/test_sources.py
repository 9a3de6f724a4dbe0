import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from quayside.queries.scans import workbook_bytes
from quayside import storage
from quayside.sources import columns, delimited, documents, tables, workbook


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# columns -------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "spec, expected",
    [
        (None, ["cod", "nome", "uf", "x"]),
        ("", ["cod", "nome", "uf", "x"]),
        ("A:C", ["cod", "nome", "uf"]),
        ("b:d", ["nome", "uf", "x"]),
        ("0,3", ["cod", "x"]),
        ("uf, cod", ["cod", "uf"]),
        ("nome", ["nome"]),
    ],
)
def test_wanted_columns(spec, expected):
    assert columns.wanted_columns(spec, ["cod", "nome", "uf", "x"]) == expected


def test_unknown_column():
    with pytest.raises(ValueError, match="no column"):
        columns.wanted_columns("cod,9", ["cod"])
    assert columns.wanted_columns("AA:AB", [str(i) for i in range(30)]) == ["26", "27"]


def test_projection_keeps_the_key(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_id int, a int, b int")
    assert columns.project_fields(df, ["b"]).columns == ["_id", "b"]
    assert columns.project_fields(df, []).columns == ["_id", "a", "b"]


# delimited -----------------------------------------------------------------------------------------


def test_latin1_semicolon_decimal_comma(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("código;valor;uf\nSão;1.5;RJ\nNA;2,25;\n".encode("latin-1"))
    df = delimited.scan_delimited(spark, str(tmp_path), sep=";", encoding="latin1", decimal=",", decimal_columns=["valor"])
    assert df.columns == ["código", "valor", "uf"]
    assert rows(df) == [("São", 1.5, "RJ"), (None, 2.25, None)]
    named = delimited.scan_delimited(spark, str(tmp_path), sep=";", encoding="latin1", columns=["a", "b", "c"])
    assert rows(named) == [("São", "1.5", "RJ"), (None, "2,25", None)]


def test_no_header_and_lower_header(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"{i}.csv").write_text(f"report {i},\n,\ncod,nome\n{i},x\n{i}0,y\n")
    df = delimited.scan_delimited(spark, str(tmp_path), header=2)
    assert df.columns == ["cod", "nome"]
    assert rows(df) == [("1", "x"), ("10", "y"), ("2", "x"), ("20", "y")]
    assert delimited.scan_delimited(spark, str(tmp_path), header=None).columns == ["_c0", "_c1"]


def test_lower_header_in_a_split_file(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("preamble,\ncod,nome\n" + "".join(f"{i},name {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = delimited.scan_delimited(spark, str(path), header=1)
        assert df.rdd.getNumPartitions() > 1
        assert df.agg(F.count("cod"), F.sum(F.col("cod").cast("int"))).first()[:] == (5000, sum(range(5000)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gz_pipe_without_quoting(spark, tmp_path):
    with gzip.open(tmp_path / "a.gz", "wt", encoding="utf-8") as f:
        f.write('a|b|c\n1|"x|é\\\n2||nan\n')
    (tmp_path / "b.csv").write_text("not|read|this\n1|2|3\n")
    assert rows(delimited.scan_gz_pipe(spark, str(tmp_path))) == [("1", '"x', "é\\"), ("2", None, None)]


def test_quoted_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\n""y"""\n')
    assert rows(delimited.scan_delimited(spark, str(tmp_path), multi_line=True)) == [("1", 'x\n"y"')]


# documents -----------------------------------------------------------------------------------------


def test_mixed_folder(spark, tmp_path):
    (tmp_path / "good.jsonl").write_text('{"a": 1.50, "n": {"k": [1]}}\n\n{"b": true}\n')
    (tmp_path / "broken.json").write_text('{"a": 7}\n{"a": \n')
    (tmp_path / "x.CSV").write_text('b,a\n"1,5",2\n')
    (tmp_path / "y.txt").write_text("c\nz\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "image.png").write_bytes(b"\x00")
    df = documents.scan_mixed_folder(spark, str(tmp_path))
    assert {t for _, t in df.dtypes} == {"string"}
    got = df.withColumn("source_file", F.regexp_extract("source_file", "[^/]+$", 0))
    assert rows(got.select("source_file", "a", "b", "c", "n")) == [
        ("good.jsonl", "1.5", None, None, '{"k":["1"]}'),
        ("good.jsonl", None, "true", None, None),
        ("x.CSV", "2", "1,5", None, None),
        ("y.txt", None, None, "z", None),
    ]


def test_mixed_folder_with_nothing_in_it(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing to read"):
        documents.scan_mixed_folder(spark, str(tmp_path))


def test_json_lines_as_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1.50, "b": true}\n')
    assert rows(documents.scan_json_lines(spark, str(tmp_path), as_text=True)) == [("1.50", "true")]
    assert rows(documents.scan_json_lines(spark, str(tmp_path), "a double")) == [(1.5,)]


def test_envelope(spark):
    bodies = ['{"payload": [{"id": 1}, "x", 5]}', '{"payload": null}', "{}", '{"payload": []}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert rows(documents.scan_envelope(df)) == [("5",), ("x",), ('{"id":1}',)]
    wrong = spark.createDataFrame([('{"payload": {"id": 1}}',)], "body string")
    with pytest.raises(Exception, match="payload is no list"):
        documents.scan_envelope(wrong).collect()


def test_pages_and_gaps(spark):
    def page(n, total=7, limit=2):
        return (n, json.dumps({"data": {"total": total, "limit": limit, "scan": [{"sku": str(n)}]}}))

    df = spark.createDataFrame([page(1), page(2, 99), page(4), (3, None)], "page int, body string")
    assert rows(documents.page_items(df, "sku: string", keep=["page"])) == [(1, "1"), (2, "2"), (4, "4")]
    # ceil(7 / 2) pages by the first page's head; the third came without a body
    assert rows(documents.page_gaps(df)) == [(3,)]
    assert documents.page_gaps(spark.createDataFrame([page(1, limit=0)], "page int, body string")).count() == 0


# tables --------------------------------------------------------------------------------------------


def test_external_table_and_run_folder(spark, tmp_path):
    for day, value in (("2025-01-01", "a"), ("2025-01-02", "b")):
        folder = tmp_path / f"dt={day}"
        folder.mkdir()
        (folder / "f.csv").write_text(f'v,w\n"{value}\nx",1\n')
    df = tables.external_table(spark, str(tmp_path), "csv", multi_line=True)
    assert dict(df.dtypes)["dt"] == "date"
    day = tables.run_folder(df, date(2025, 1, 2))
    assert rows(day) == [("b\nx", "1", date(2025, 1, 2))]
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()
    assert storage.partition_values(spark, str(tmp_path)) == ["2025-01-01", "2025-01-02"]
    assert storage.partition_values(spark, str(tmp_path / "none")) == []


def test_drifting_parquet(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "a"))
    spark.range(1).selectExpr("id", "'x' as b").write.mode("append").parquet(str(tmp_path / "a"))
    assert set(tables.scan_parquet(spark, str(tmp_path / "a"), merge_schema=True).columns) == {"id", "b"}


def test_free_query(spark):
    df = spark.range(5)
    assert rows(tables.scan_free_query(spark, "select max(id) as m from {t}", t=df)) == [(4,)]


# workbooks -----------------------------------------------------------------------------------------


def book(tmp_path, name, sheets):
    (tmp_path / name).write_bytes(workbook_bytes(sheets))


def test_sheet_selector():
    assert [workbook.sheet_selector(v) for v in (None, "", " 2 ", "Info Lojas")] == ["0", "0", "2", "Info Lojas"]


def test_sheet_table_with_a_lower_header(spark, tmp_path):
    sheet = [["Report"], [], ["Loja", "Valor", "Valor", None], [1, "1,5", 2.5, "é"], [2.0, None, 3]]
    book(tmp_path, "a.xlsx", {"Outra": [["x"]], "Info Lojas": sheet})
    files = workbook.workbook_files(spark, str(tmp_path))
    df = workbook.sheet_table(files, "Info Lojas", 2, decimal=",", decimal_columns=("Valor",))
    assert df.columns == ["_file", "_row", "Loja", "Valor", "Valor.1", "Unnamed: 3"]
    assert rows(df.drop("_file")) == [(3, "1", 1.5, "2.5", "é"), (4, "2", None, "3", None)]
    assert workbook.sheet_table(files, "1", 2, usecols="A:B").columns == ["_file", "_row", "Loja", "Valor"]
    with pytest.raises(ValueError, match="no sheet"):
        workbook.sheet_table(files, "Nenhuma")


def test_workbooks_of_different_layouts(spark, tmp_path):
    book(tmp_path, "a.xlsx", {"S": [["x", "y"], [1, 2]]})
    book(tmp_path, "b.xlsx", {"S": [["y", "z"], [3, 4]]})
    df = workbook.sheet_table(workbook.workbook_files(spark, str(tmp_path)), "S")
    assert rows(df.select("x", "y", "z")) == [("1", "2", None), (None, "3", "4")]


def test_cell_kinds():
    import io
    import zipfile

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    cells = """<row r="3"><c r="A3" t="s"><v>1</v></c><c r="C3" s="1"><v>45000.5</v></c><c r="D3" t="b"><v>1</v></c>
        <c r="E3" t="e"><v>#N/A</v></c><c r="F3" t="str"><v>f</v></c><c r="G3"><v>0.10000000000000001</v></c>
        <c r="H3" s="2"><v>60</v></c><c r="I3"/></row>"""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        z.writestr("xl/_rels/workbook.xml.rels", '<R><Relationship Id="rId1" Target="/xl/worksheets/sheet1.xml"/></R>')
        z.writestr(
            "xl/sharedStrings.xml",
            f'<sst xmlns="{main}"><si><t>a</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si></sst>',
        )
        z.writestr(
            "xl/styles.xml",
            f"""<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="164" formatCode="dd/mm/yyyy"/>
                <numFmt numFmtId="165" formatCode="[Red]0.00 &quot;dias&quot;"/></numFmts>
                <cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>""",
        )
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{cells}</sheetData></worksheet>')
    read = list(workbook.read_sheets(out.getvalue()))
    assert read == [("S", 0, 2, ["rich", None, "2023-03-15 12:00:00", "true", None, "f", "0.1", "60", None])]
    assert list(workbook.read_sheets(out.getvalue(), "other")) == []
    assert list(workbook.read_sheets(out.getvalue(), last_row=1)) == []


# files of several layouts and splits -----------------------------------------------------------------


def pack(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_gz_pipe_layouts_are_read_once(spark, tmp_path):
    pack(tmp_path / "run=2025-01-01" / "a b%20c.gz", "k|v|w", "1|x|y", "", "2|short", "3|a|b|too|many")
    pack(tmp_path / "run=2025-01-01" / "b.gz", "w|k", "z|4")
    pack(tmp_path / "run=2025-01-02" / "c.gz", "k|k", "5|6")
    pack(tmp_path / "run=2025-01-02" / "d.gz", "k|v|w")
    (tmp_path / "run=2025-01-02" / "e.gz").write_bytes(gzip.compress(b""))
    df = delimited.scan_gz_pipe(spark, str(tmp_path))
    assert df.columns == ["k", "v", "w"]
    assert rows(df) == sorted([("1", "x", "y"), ("2", "short", None), ("3", "a", "b"), ("4", None, "z"), ("5", None, None)], key=str)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and plan.count("FileScan csv") == 3
    assert rows(delimited.scan_gz_pipe(spark, str(tmp_path), ["w", "x"]).filter("w is not null")) == [("b", None), ("y", None), ("z", None)]
    pruned = delimited.scan_gz_pipe(spark, str(tmp_path)).select("w")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c2:string>" in pruned


def test_header_below_in_files_of_several_splits(spark, tmp_path):
    body = [f"{i};row {i}" for i in range(4000)]
    (tmp_path / "a.csv").write_text("\n".join(["Title", "", "of;three;words", "note", "key;name", *body]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(["Title", "x", "note", "key;name", "n1;note", "Title;x"]) + "\n")
    (tmp_path / "short.csv").write_text("Title\nx\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = delimited.scan_delimited(spark, str(tmp_path), sep=";", header=3)
        assert df.rdd.getNumPartitions() > 4
        assert df.columns == ["key", "name"]
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "Exchange" not in plan and "Join" not in plan and plan.count("FileScan csv") == 1
    assert sorted(map(tuple, got), key=str) == sorted([tuple(b.split(";")) for b in body] + [("n1", "note"), ("Title", "x")], key=str)


def test_header_below_must_be_one(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t\na,b\n1,2\n")
    (tmp_path / "b.csv").write_text("t\nb,a\n1,2\n")
    with pytest.raises(ValueError, match="other columns"):
        delimited.scan_delimited(spark, str(tmp_path), header=1)
    assert rows(delimited.scan_delimited(spark, str(tmp_path), header=1, columns=["x", "y"])) == [("1", "2"), ("1", "2")]
    (tmp_path / "c.csv").write_text('t\n"a,\n x",b\n"1\n2",3\n')
    assert delimited.scan_delimited(spark, str(tmp_path / "c.csv"), header=1, multi_line=True).columns == ["a,\n x", "b"]
    assert rows(delimited.scan_delimited(spark, str(tmp_path / "c.csv"), header=1, multi_line=True)) == [("1\n2", "3")]


def test_json_of_an_envelope_is_parsed_once(spark):
    """Conditions on the fields of a record, and on the elements of a payload, must not parse the text again."""
    from quayside.operators.nested import raw_fallback
    from quayside.sources.documents import scan_envelope

    rows = [('{"payload": [{"id":1,"at":"b"}, {"at": "c", "id": 2}, {"id":"x"}, "gone", null]}',), ('{"payload": []}',), ("{}",), (None,)]
    found = raw_fallback(scan_envelope(spark.createDataFrame(rows, "body string")), "element", "id bigint, at string")
    kept = found.where("id > 0 and id < 9 and at > 'a'")
    assert kept.count() == 2 and found.count() == 5
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    # one for the list, one for the record
    assert plan.count("get_json_object") <= 1 and plan.count("from_json") == 2
    raw = [r["_raw"] for r in found.collect()]
    assert raw.count(None) == 3 and set(raw) == {None, '{"id":"x"}', "gone"}
