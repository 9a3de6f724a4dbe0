from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from quayside.operators import audit, casting, configs, dedup, filters, lookups, nested, sets
from quayside.session import scratch_path


def rows(df):
    return [tuple(r) for r in df.collect()]


# audit ---------------------------------------------------------------------------------------------


def test_ingestion_time_is_local_wall_clock(spark):
    df = audit.with_ingestion_time(spark.range(1), datetime(2025, 1, 1, 2, 0, 0, 5, timezone.utc))
    assert df.first()["DT_INGESTAO"] == datetime(2024, 12, 31, 23, 0, 0, 5)
    assert dict(df.dtypes)["DT_INGESTAO"] == "timestamp_ntz"


def test_landing_schema(spark):
    df = spark.createDataFrame([(1, None, ["x"])], "b int, a double, c array<string>")
    landed = audit.landing_schema(df, datetime(2025, 1, 1, 2))
    assert landed.dtypes == [
        ("a", "string"), ("b", "string"), ("c", "string"), ("dt_ingestao", "timestamp_ntz"), ("id_execucao", "string"),
    ]
    assert rows(landed) == [(None, "1", '["x"]', datetime(2025, 1, 1, 2), "20250101T020000Z")]
    assert rows(audit.all_string(df.select("a"), null_token="nan")) == [("nan",)]


# casts ---------------------------------------------------------------------------------------------

TYPES = {"i": "INTEGER", "n": "NUMERIC", "b": "BOOLEAN", "d": "DATE", "t": "TIMESTAMP", "s": "STRING"}


def test_cast_to_schema_and_rejects(spark):
    df = spark.createDataFrame(
        [
            ("1e3", "1.5", "True", "2020-01-02", "2020-01-02T03:00:00Z", "x", 5),
            ("3.5", "n/d", "yes", "2020-13-02", "bad", None, 6),
            (None, None, None, None, None, None, None),
        ],
        "i string, n string, b string, d string, t string, s string, extra int",
    )
    seen = Observation()
    typed = casting.cast_to_schema(df, TYPES, seen)
    assert rows(typed) == [
        (1000, 1.5, True, date(2020, 1, 2), datetime(2020, 1, 2, 3), "x", "5"),
        (None, None, None, None, None, None, "6"),
        (None,) * 7,
    ]
    expected = {"i": 1, "n": 1, "b": 1, "d": 1, "t": 1, "s": 0}
    assert seen.get == expected
    assert dict(rows(casting.cast_rejects(df, TYPES))) == expected


def test_infer_types(spark):
    df = spark.createDataFrame(
        [("1", "1.0", "x", "TRUE", None, "1.5", float("nan"), {"k": 1}), ("2", None, "1", "false", None, "nan", 2.0, None)],
        "whole string, whole_float string, mixed string, flag string, empty string, real string, x double, m map<string,int>",
    )
    typed = casting.infer_types(df)
    assert [t for _, t in typed.dtypes] == ["bigint", "bigint", "string", "boolean", "string", "double", "double", "string"]
    assert rows(typed) == [
        (1, 1, "x", True, None, 1.5, None, '{"k":1}'),
        (2, None, "1", False, None, None, 2.0, None),
    ]


def test_inferred_kinds_of_odd_numbers(spark):
    columns = {"long": ["1234567890123456789", "1e3"], "wide": ["99999999999999999999", "1"], "inf": ["inf", "1"], "dot": [".0", "7."]}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{c}` string" for c in columns))
    assert casting.best_types(df) == {"long": "bigint", "wide": "double", "inf": "double", "dot": "bigint"}


LANDED = "ID string, AMOUNT string, FLAG string, AT string, DT string, ODD string, DT_INGESTAO timestamp_ntz, ID_EXECUCAO string"


def landed(spark, flag="true", amount="1.25"):
    run = datetime(2025, 1, 1)
    return spark.createDataFrame([("7", amount, flag, "2020-01-02 03:04:05", "2000-01-01", "o", run, "r")], LANDED)


def test_typed_projections(spark):
    catalogue = [("ID", "bigint"), ("AMOUNT", "money"), ("FLAG", "bit"), ("AT", "datetime"), ("DT", "date"), ("ODD", "geometry")]
    typed = casting.typed_projection(landed(spark), catalogue, "sqlserver", "AT")
    assert typed.dtypes == [
        ("DT", "date"), ("ID", "bigint"), ("AMOUNT", "decimal(38,9)"), ("FLAG", "boolean"), ("AT", "timestamp_ntz"),
        ("ODD", "string"), ("DT_INGESTAO", "timestamp_ntz"), ("ID_EXECUCAO", "string"),
    ]
    assert typed.first()["DT"] == date(2020, 1, 2) and typed.first()["AMOUNT"] == Decimal("1.25")
    # without a derived DT the source's own column of that name is kept
    assert "DT" in casting.typed_projection(landed(spark), catalogue, "sqlserver").columns


def test_precision_in_a_type_name_is_ignored(spark):
    catalogue = [("AT", "timestamp(6)"), ("AMOUNT", "NUMBER(10,2)"), ("ID", "timestamp(6) with time zone")]
    typed = casting.typed_projection(landed(spark), catalogue, "oracle")
    assert dict(typed.dtypes)["AT"] == "timestamp"
    assert dict(typed.dtypes)["AMOUNT"] == "decimal(38,9)"
    assert dict(typed.dtypes)["ID"] == "timestamp"


def test_bad_value_is_null_or_fails_when_strict(spark):
    catalogue = [("FLAG", "bit"), ("AMOUNT", "money")]
    loose = casting.typed_projection(landed(spark, "yes", "x"), catalogue, "sqlserver").first()
    assert loose["FLAG"] is None and loose["AMOUNT"] is None
    for bad in (landed(spark, flag="yes"), landed(spark, amount="x")):
        with pytest.raises(Exception):
            casting.typed_projection(bad, catalogue, "sqlserver", strict=True).collect()


def test_partition_source():
    row = {"partition_column": "P", "filter_column": "F", "incremental_join_clause": "a = b"}
    assert casting.partition_source(row) == "F"
    assert casting.partition_source({**row, "incremental_join_clause": None}) == "P"


# nested --------------------------------------------------------------------------------------------


def test_programs_keep_their_product(spark):
    price = "struct<maximumPrice: double, PMC: double>"
    schema = f"""_id string, sku string, code string, pbm string, displayName string, eans array<string>, pbms array<struct<
        pbm: string, displayName: string, data: struct<ean: string, ValorBase: double, ValorMaximo: double,
        Desconto: double, PorcentagemDesconto: double, price: {price}>>>"""
    two = [("A", "a", ("e", 1.0, 2.0, 3.0, 4.0, (9.0, 8.0))), ("B", "b", ("e", 5.0, 6.0, 7.0, 8.0, None))]
    df = spark.createDataFrame([("1", "s1", "c1", "p", "one", [], two), ("2", "s2", "c2", "p", "two", None, [])], schema)
    flat = nested.flatten_programs(df)
    assert flat.columns == list(nested.PROGRAM_COLUMNS)
    assert sorted(rows(flat), key=str) == [
        ("1", "s1", "c1", "p", "A", "one", "a", 1.0, 2.0, 3.0, 4.0, 9.0, 8.0),
        ("1", "s1", "c1", "p", "B", "one", "b", 5.0, 6.0, 7.0, 8.0, None, None),
        ("2", "s2", "c2", "p", None, "two", *[None] * 7),
    ]


def test_price_that_is_no_record(spark):
    text = '[{"_id": "1", "pbms": [{"pbm": "A", "data": {"price": "call us"}}, {"pbm": "B", "data": {"price": {"PMC": 2.5}}}]}]'
    df = spark.createDataFrame([(text,)], "body string").select(
        F.explode(F.from_json("body", f"array<struct<{PROGRAM_FIELDS}>>")).alias("p")
    ).select("p.*")
    assert [(r["pbmspbm"], r["PMC"]) for r in nested.flatten_programs(df).collect()] == [("A", None), ("B", 2.5)]


PROGRAM_FIELDS = nested.PROGRAM_SCHEMA.replace("\n", " ")


def test_offers(spark):
    schema = """sku string, reference_code string, last_scan struct<data: array<struct<
        domain: string, price: double, sold_by: string, sellers: array<struct<name: string>>>>>"""
    offers = [(" a.com ", 1.0, "s", [("x",)]), (None, None, None, None)]
    df = spark.createDataFrame([("1", None, (offers,)), ("2", "r", None), ("3", "r", ([],))], schema)
    flat = nested.flatten_offers(df, datetime(2025, 1, 1))
    assert len(flat.columns) == 16
    got = [(r["SKU"], r["REFERENCE_CODE"], r["DOMAIN"], r["PRICE"], r["SELLERS"]) for r in flat.collect()]
    assert got == [("1", "", "a.com", 1.0, '[{"name":"x"}]'), ("1", "", "", None, "[]")]


def test_scalars(spark):
    df = spark.createDataFrame(
        [(("abc",), ("1.5",), ("2020-01-01T00:00:00Z",), datetime(2020, 1, 1, 2), date(2020, 1, 1), Decimal("1.50"), ["x"], 5)],
        """_id struct<`$oid`: string>, amount struct<`$numberDecimal`: string>, at struct<`$date`: string>,
           ts timestamp_ntz, d date, dec decimal(5,2), l array<string>, n int""",
    )
    assert rows(nested.normalize_scalars(df)) == [
        ("abc", Decimal("1.5"), "2020-01-01T00:00:00Z", "2020-01-01T02:00:00", "2020-01-01", Decimal("1.50"), '["x"]', 5)
    ]


def test_raw_fallback(spark):
    df = spark.createDataFrame([('{"id": 1}',), ("text",), ("[1]",), (None,)], "element string")
    assert rows(nested.raw_fallback(df, "element", "id int")) == [(1, None), (None, "text"), (None, "[1]"), (None, None)]


# filters -------------------------------------------------------------------------------------------


def test_incremental_window(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", False), (2, "2024-01-02T00:00:00Z", False), (3, "2024-01-03", True), (4, "2024-01-03", None), (5, "bad", False)],
        "i int, f string, deleted boolean",
    )
    assert [r[0] for r in filters.incremental_window(df, "f", "2024-01-02").collect()] == [2]
    assert [r[0] for r in filters.incremental_window(df, "f", "2024-01-01", "2024-01-02").collect()] == [1]
    assert filters.incremental_window(df, None, "2024-01-01").count() == 5


def test_watermark(spark):
    df = spark.createDataFrame([(date(2024, 1, 5),), (date(2024, 1, 3),)], "DT date")
    assert filters.high_watermark(df).first()[0] == date(2024, 1, 4)
    assert filters.high_watermark(df.limit(0)).first()[0] == date(1900, 1, 1)
    path = scratch_path(spark, "watermark")
    assert filters.start_of_extract(spark, path) == date(1900, 1, 1)
    df.write.parquet(path)
    assert filters.start_of_extract(spark, path) == date(2024, 1, 4)
    assert filters.start_of_extract(spark, path, column="OTHER") == date(1900, 1, 1)
    assert filters.start_of_extract(spark, path, explicit="2020-01-01") == date(2020, 1, 1)


def test_late_rerun_of_an_old_day_empties_the_snapshot(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 1), datetime(2024, 1, 3)), (2, date(2024, 1, 2), datetime(2024, 1, 2)), (3, date(2024, 1, 2), datetime(2024, 1, 1))],
        "i int, dt date, dt_ingestao timestamp_ntz",
    )
    assert filters.latest_snapshot(df).count() == 0
    assert [r[0] for r in filters.latest_snapshot(df, within_latest_dt=True).collect()] == [2]


def test_eligible_cycles(spark):
    run = date(2025, 3, 10)  # minus 2 and 45 days: 2025-01-22
    data = [
        (1, "b", "2025-01-22T00:00:00Z"), (2, "a", "2025-01-21T23:59:59Z"), (3, "c", "2025-01-22T23:00:00-03:00"),
        (4, "b", "2025-03-01"), (5, "", "2025-03-01"), (6, None, "2025-03-01"), (7, "d", None), (8, "e", "bad"), (9, "a", "2025-02-01"),
    ]
    df = spark.createDataFrame(data, "n int, id string, cycleEndDate string")
    assert [r[0] for r in filters.eligible_cycles(df, run, "n").collect()] == ["b", "c", "a"]
    assert [r[0] for r in filters.eligible_cycles(df, run, "n", cap=2).collect()] == ["b", "c"]
    assert [r[0] for r in filters.eligible_cycles(df, run, "n", cap=None).collect()] == ["b", "c", "a"]


def test_lookback(spark):
    moments = [datetime(2025, 3, 7, 23, 59), datetime(2025, 3, 8), datetime(2025, 3, 14, 23), datetime(2025, 3, 15)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    assert [r[0] for r in filters.lookback_window(df, "t", date(2025, 3, 10)).collect()] == moments[1:3]


# duplicates ----------------------------------------------------------------------------------------


def test_keep_first_in_file_order(spark):
    path = scratch_path(spark, "dup")
    df = spark.createDataFrame([(5, "a", 1), (4, "a", 2), (3, "b", 3), (2, None, 4), (1, None, 5)], "i int, k string, v int")
    df.coalesce(1).write.parquet(path)
    kept = dedup.dedup_keep_first(spark.read.parquet(path), ["k"])
    assert kept.columns == ["i", "k", "v"]
    assert sorted(r["v"] for r in kept.collect()) == [1, 3, 4]
    assert sorted(r["v"] for r in dedup.dedup_keep_first(df, ["k"], ["i"]).collect()) == [2, 3, 5]


def test_latest_by_key_checks_deletion_last(spark):
    df = spark.createDataFrame([(1, 1, False), (1, 2, True), (2, 1, False)], "k int, at int, deleted boolean")
    assert rows(dedup.latest_by_key(df, ["k"], ["at"], "deleted")) == [(2, 1, False)]


def test_positions_follow_the_whole_order(spark):
    df = spark.range(1000).selectExpr("id % 3 as hot", "id")
    numbered = dedup.with_position(df, ["hot", "id"]).orderBy("position").collect()
    assert [r["position"] for r in numbered] == list(range(1, 1001))
    assert [(r["hot"], r["id"]) for r in numbered] == sorted((i % 3, i) for i in range(1000))


def test_positional_concat_pads_the_shorter(spark):
    left = spark.createDataFrame([("x",), ("y",), ("z",)], "a string")
    right = spark.createDataFrame([(1,)], "b int")
    got = dedup.positional_concat(left, right, ["a"], ["b"]).orderBy("position")
    assert rows(got) == [(1, "x", 1), (2, "y", None), (3, "z", None)]
    empty = dedup.positional_concat(left, right.limit(0), ["a"], ["b"])
    assert empty.count() == 3


# joins, sets, configuration ------------------------------------------------------------------------


def test_lookup(spark):
    files = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    table = spark.createDataFrame([("a", "csv")], "name string, format string")
    matched, rejected = lookups.lookup(files, table, ["name"], strict=False)
    assert rows(matched) == [("a", "csv")]
    assert sorted(rows(rejected), key=str) == [("b",), (None,)]
    with pytest.raises(Exception, match="no entry for b"):
        lookups.lookup(files.filter("name is not null"), table, ["name"])[0].collect()
    assert rows(lookups.lookup(files.filter("name = 'a'"), table, ["name"])[0]) == [("a", "csv")]


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    c = spark.createDataFrame([(True,)], "c boolean")
    assert rows(sets.union_batches([a, b])) == [(1, "x"), (2, "y")]
    assert rows(sets.union_drifting([a, c])) == [(1, "x", None), (None, None, True)]


CONFIG = "source_table_name string, source_file_name string, sheet_name string, target_table_name string, flag_table_created int, active boolean"


def config(spark):
    return spark.createDataFrame(
        [("s1", "f1", "B", "t1", 0, True), ("s2", "f1", "A", "t2", 1, True), ("s3", "f2", "A", "t3", 0, False)], CONFIG
    )


def test_pending_and_active(spark):
    c = config(spark)
    assert [r["source_table_name"] for r in configs.pending_config(c).collect()] == ["s1", "s3"]
    assert [r["target_table_name"] for r in configs.pending_config(c, [" f2 "], file_source=True).collect()] == ["t3"]
    assert [r["sheet_name"] for r in configs.active_config(c, ["f1"]).collect()] == ["A", "B"]
    with pytest.raises(ValueError, match="no active"):
        configs.active_config(c, ["f2"])


def test_mark_processed(spark):
    c = config(spark)
    done = spark.createDataFrame([("t3",), ("t3",)], "name string")
    for processed in (done, ["t3"]):
        marked = configs.mark_processed(c, processed)
        assert marked.columns == c.columns
        assert {r["target_table_name"]: r["flag_table_created"] for r in marked.collect()} == {"t1": 0, "t2": 1, "t3": 1}
    assert configs.mark_processed(c, []).count() == 3
