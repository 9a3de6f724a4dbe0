"""Batches that drift in columns and types."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quayside.operators.sets import union_drifting
from quayside.operators.widening import Widening, common_type, scan_drifting, union_widening


def kind(text):
    return T._parse_datatype_string(f"x {text}")["x"].dataType


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(
    "a, b, wide",
    [
        ("int", "bigint", "bigint"),
        ("smallint", "int", "int"),
        ("int", "decimal(5,2)", "decimal(12,2)"),
        ("bigint", "decimal(38,9)", "decimal(38,9)"),
        ("bigint", "decimal(38,30)", "double"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("float", "int", "double"),
        ("double", "decimal(10,2)", "double"),
        ("double", "string", "string"),
        ("boolean", "int", "string"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("date", "timestamp", "timestamp"),
        ("timestamp", "timestamp_ntz", "string"),
        ("array<int>", "array<string>", "array<string>"),
        ("array<int>", "int", "string"),
        ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("map<string,int>", "map<int,int>", "string"),
        ("struct<a:int,b:date>", "struct<A:bigint,c:string>", "struct<a:bigint,b:date,c:string>"),
        ("void", "struct<a:int>", "struct<a:int>"),
    ],
)
def test_common_types(spark, a, b, wide):
    assert common_type(kind(a), kind(b)).simpleString() == kind(wide).simpleString()
    if not a.startswith("struct"):
        assert common_type(kind(b), kind(a)).simpleString() == kind(wide).simpleString()


_leaf = st.sampled_from([T.IntegerType(), T.LongType(), T.DecimalType(10, 2), T.DecimalType(30, 1), T.DoubleType(), T.StringType(), T.DateType(), T.BooleanType(), T.TimestampNTZType()])
_type = st.recursive(_leaf, lambda inner: st.one_of(inner.map(T.ArrayType), st.dictionaries(st.sampled_from("abc"), inner, min_size=1).map(lambda d: T.StructType([T.StructField(n, d[n]) for n in sorted(d)]))), max_leaves=5)


def ordered(t):
    """The type without regard to the order of fields."""
    if isinstance(t, T.StructType):
        return ("struct", tuple(sorted((f.name, ordered(f.dataType)) for f in t)))
    return ("array", ordered(t.elementType)) if isinstance(t, T.ArrayType) else t.simpleString()


@settings(max_examples=200, deadline=None)
@given(_type, _type)
def test_meeting_is_commutative_idempotent_and_a_bound(a, b):
    wide = common_type(a, b)
    assert ordered(wide) == ordered(common_type(b, a)) and common_type(a, a) == a
    assert ordered(common_type(wide, a)) == ordered(wide) == ordered(common_type(wide, b))


def test_union_widens_values_and_tells(spark):
    a = spark.createDataFrame([(1, 5, [1], (1, True), date(2024, 1, 2))], "id int, v int, l array<int>, s struct<x:int,y:boolean>, d date")
    b = spark.createDataFrame([(2, "five", [2**40], (2.5, "z"), datetime(2024, 1, 2, 3))], "id int, V string, l array<bigint>, s struct<x:double,z:string>, d timestamp_ntz")
    c = spark.createDataFrame([(3, (1, [2]), Decimal("1.50"))], "id bigint, v struct<p:int,q:array<int>>, n decimal(5,2)")
    df, changes = union_widening([a, b, c])
    assert df.schema.simpleString() == "struct<id:bigint,v:string,l:array<bigint>,s:struct<x:double,y:boolean,z:string>,d:timestamp_ntz,n:decimal(5,2)>"
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, "5", [1], (1.0, True, None), datetime(2024, 1, 2), None),
        (2, "five", [2**40], (2.5, None, "z"), datetime(2024, 1, 2, 3), None),
        (3, '{"p":1,"q":[2]}', None, None, None, Decimal("1.50")),
    ]
    assert changes == [
        Widening("id", 0, "int", "bigint"), Widening("v", 0, "int", "string"), Widening("l[]", 0, "int", "bigint"),
        Widening("s.x", 0, "int", "double"), Widening("d", 0, "date", "timestamp_ntz"), Widening("id", 1, "int", "bigint"),
        Widening("v", 2, "struct<p:int,q:array<int>>", "string"),
    ]
    assert union_widening([a, a])[1] == [] and rows(union_drifting([a.select("id"), b.select("id")])) == [(1,), (2,)]


def test_folders_are_read_by_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(6):
        values = "id" if i % 2 else "cast(id as string) || 'x'"
        spark.range(2).selectExpr(f"{values} as v", "id as w").write.parquet(f"{path}/dt=2024-01-0{i + 1}")
    (tmp_path / "t" / "dt=2024-01-09").mkdir()
    df, changes = scan_drifting(spark, path)
    assert [(c.column, c.given, c.became) for c in changes] == [("v", "bigint", "string")]
    assert sorted(r["v"] for r in df.collect()) == sorted(["0x", "1x", "0", "1"] * 3)
    plan = df.filter("w = 1 and dt = date'2024-01-02'").select("w")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "EqualTo(w,1)" in plan and "v#" not in plan.split("FileScan")[1].split("Batched")[0]
    assert {str(r[0]) for r in df.select("dt").distinct().collect()} == {f"2024-01-0{i}" for i in range(1, 7)}


def test_files_of_one_folder_may_drift_too(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).write.parquet(f"{path}/dt=2024-01-01")
    spark.range(1).selectExpr("'a' as id").write.mode("append").parquet(f"{path}/dt=2024-01-01")
    df, _ = scan_drifting(spark, path, each_file=True)
    assert sorted(r["id"] for r in df.collect()) == ["0", "a"]
    with pytest.raises(FileNotFoundError):
        scan_drifting(spark, str(tmp_path / "none"))
