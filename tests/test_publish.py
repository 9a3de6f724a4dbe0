from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quayside import storage
from quayside.operators.audit import run_id_of, with_run_audit
from quayside.plans import publish


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def days(spark, values):
    return spark.createDataFrame([(v, date.fromisoformat(d)) for v, d in values], "v int, DT date")


def read(spark, path):
    return [(r["v"], str(r["DT"])) for r in spark.read.parquet(path).orderBy("v").collect()]


def test_csv_overwrite_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([('a"b,c', None, datetime(2025, 1, 1, 2)), (None, 1, None)], "s string, n int, t timestamp_ntz")
    publish.publish_csv_overwrite(df.limit(0), path)
    publish.publish_csv_overwrite(df, path)
    back = spark.read.options(**publish.CSV_OPTIONS).schema(df.schema).csv(path)
    assert rows(back) == rows(df)
    text = "".join(p.read_text() for p in (tmp_path / "t").glob("part-*"))
    assert '"a""b,c",,2025-01-01 02:00:00.000000' in text


def test_replace_partition_twice_is_once_and_leaves_the_rest(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.replace_partition(days(spark, [(1, "2025-01-01"), (2, "2025-01-02")]), path, "DT")
    for _ in range(2):
        publish.replace_partition(days(spark, [(3, "2025-01-02"), (4, "2025-01-03")]), path, "DT")
        assert read(spark, path) == [(1, "2025-01-01"), (3, "2025-01-02"), (4, "2025-01-03")]


def test_bounded_files(spark, tmp_path):
    publish.bounded_files(spark.range(25).coalesce(1), str(tmp_path / "t"), 10)
    sizes = spark.read.parquet(str(tmp_path / "t")).groupBy("_metadata.file_name").count()
    assert sorted(r["count"] for r in sizes.collect()) == [5, 10, 10]
    assert all(".snappy." in p.name for p in (tmp_path / "t").glob("part-*"))
    publish.bounded_files(spark.range(25).coalesce(1), str(tmp_path / "u"), 0)
    assert len(list((tmp_path / "u").glob("part-*"))) == 1


def test_append_run_is_idempotent_per_run(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = datetime(2025, 1, 1, 1), datetime(2025, 1, 1, 2)
    for run in (first, second, second):
        publish.append_run(with_run_audit(spark.range(2), run), path, run.date(), run_id_of(run))
    assert spark.read.parquet(path).groupBy("id_execucao").count().orderBy("id_execucao").collect() == [
        ("20250101T010000Z", 2),
        ("20250101T020000Z", 2),
    ]
    assert (tmp_path / "t" / "dt=2025-01-01" / "id_execucao=20250101T010000Z").is_dir()


def test_merge_range(spark, tmp_path):
    path = str(tmp_path / "t")
    base = [(1, "2025-01-01"), (2, "2025-01-02"), (3, "2025-01-03"), (4, "2025-01-04")]
    publish.replace_partition(days(spark, base), path, "DT")
    snapshot = days(spark, [(20, "2025-01-02"), (40, "2025-01-04"), (50, "2025-01-05")])
    publish.merge_range(spark, snapshot, path, "2025-01-02", date(2025, 1, 3))
    # the third vanishes, the fourth is outside the range and added to, the fifth is new
    assert read(spark, path) == [
        (1, "2025-01-01"), (4, "2025-01-04"), (20, "2025-01-02"), (40, "2025-01-04"), (50, "2025-01-05"),
    ]
    assert not [n for n in storage.child_folders(spark, path) if n.startswith("_merge")]


def test_merge_within_the_range_twice_is_once(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshot = days(spark, [(1, "2025-01-01"), (2, "2025-01-02")])
    for _ in range(2):
        publish.merge_range(spark, snapshot, path, "2025-01-01", "2025-01-02")
        assert read(spark, path) == [(1, "2025-01-01"), (2, "2025-01-02")]


def test_failing_merge_leaves_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.replace_partition(days(spark, [(1, "2025-01-01")]), path, "DT")
    broken = days(spark, [(2, "2025-01-01")]).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        publish.merge_range(spark, broken, path, "2025-01-01", "2025-01-01")
    assert read(spark, path) == [(1, "2025-01-01")]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "config")
    assert publish.publish_version(spark.range(1), path).endswith("v=1")
    assert publish.publish_version(spark.range(2), path).endswith("v=2")
    assert spark.read.parquet(path).filter("v = 2").count() == 2


@pytest.mark.parametrize(
    "name, mode, expected",
    [
        ("Info Lojas.xlsx", "overwrite", "arquivos/Info Lojas.csv"),
        ("share/a.b.txt", "partitioned", "arquivos/a.b/dt=2025-03-10/a.b.csv"),
        ("C:\\drop\\noext", "overwrite", "arquivos/noext.csv"),
    ],
)
def test_destination_path(spark, name, mode, expected):
    df = spark.createDataFrame([(name, mode)], "n string, m string")
    path = publish.destination_path(F.col("n"), F.lit("arquivos/"), F.col("m"), F.lit("csv"), date(2025, 3, 10))
    assert df.select(path).first()[0] == expected


def test_period_and_zone(spark):
    df = spark.createDataFrame([("FF_107_DIM.txt",), ("RPE_117_FF_PCP.txt",), ("x.txt",)], "n string")
    assert [r[0] for r in df.select(publish.period_folder(F.col("n"))).collect()] == ["semanal", "mensal", None]
    source = spark.createDataFrame([("transient/run=1/a.csv.gz",)], "p string")
    assert source.select(publish.zone_path(F.col("p"))).first()[0] == "landing/run=1/a.csv.parquet"
    assert publish.output_name("x/a.b.jsonl") == "a.b.parquet"


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        publish.publish_dated(spark.range(1), str(tmp_path), date(2025, 1, 1), "avro")
