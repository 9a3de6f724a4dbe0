"""The shape of plans: what is pushed down, cut before a shuffle, broadcast or not."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quayside.operators import dedup, filters, lookups
from quayside.plans.publish import spread_by
from quayside.sources.tables import external_table, run_folder, scan_collection

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


def test_one_row_per_key_is_taken_before_the_shuffle(events):
    shown = plan(dedup.dedup_keep_first(events, ["user_id"], ["event_id"]))
    first, second = shown.index("WindowGroupLimit"), shown.index("Exchange")
    assert "Partial" in shown and "Final" in shown and first < second
    # read from the bottom: scan, sort, partial limit, exchange, final limit
    tree = shown[: shown.index("(1)")] if "(1)" in shown else shown
    assert tree.count("Exchange") == 1


def test_collection_filter_and_fields_reach_the_scan(events):
    rows = events.withColumn("deleted", F.col("event_type") == "error")
    shown = plan(scan_collection(rows, "ts", "2024-01-05", "2024-01-20", ["value"], key="event_id"))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in shown and "LessThan(ts,2024-01-20T00:00)" in shown
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in shown
    assert "Exchange" not in shown


def test_lookback_is_pushed(events):
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan(filters.lookback_window(events, "ts", date(2024, 1, 20)))


def test_snapshot_prunes_by_a_subquery(spark, tmp_path):
    for day in ("2025-01-01", "2025-01-02"):
        spark.range(5).withColumn("dt_ingestao", F.lit(day).cast("timestamp_ntz")).write.parquet(f"{tmp_path}/dt={day}")
    snapshot = filters.latest_snapshot(external_table(spark, str(tmp_path)))
    assert "PartitionFilters: [isnotnull(dt" in plan(snapshot) and "= Subquery" in plan(snapshot)
    assert snapshot.count() == 5


def test_keys_are_sized_by_spark(spark):
    facts = spark.read.parquet(f"{SF}/lineitem.parquet")
    keys = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin LeftSemi" in plan(lookups.facts_for_keys(facts, keys.limit(10), "l_orderkey"))
        assert "SortMergeJoin LeftSemi" in plan(lookups.facts_for_keys(facts, keys, "l_orderkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_run_folder_is_a_partition_filter(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/dt=2025-01-01")
    df = run_folder(external_table(spark, str(tmp_path)), date(2025, 1, 1))
    assert "PartitionFilters: [isnotnull(dt" in plan(df)


def test_hot_partition_is_split_over_files(spark, tmp_path):
    hot = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(7).alias("dt"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        spread_by(hot, "dt").write.partitionBy("dt").parquet(f"{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("dt=*")}
    # the tasks of the hot folder split it; most of the others are one file
    assert files["dt=7"] > 3 and sorted(files.values())[len(files) // 2] == 1


def test_maxima_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("date_add(date'2024-01-01', cast(id as int)) as DT", "id").repartition(3).write.parquet(path)
    found = filters.footer_scan(spark, path)
    found.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 1000)
    df = filters.high_watermark(found)
    assert "PushedAggregation: [MAX(DT)]" in df._jdf.queryExecution().executedPlan().toString()
    assert [str(r.watermark) for r in df.collect()] == ["2024-04-08"]
    assert str(filters.start_of_extract(spark, path)) == "2024-04-08"
    # the caller's own session reads as before
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
