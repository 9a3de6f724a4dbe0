"""Sinks: publish, publish again, read back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from quayside import storage
from quayside.operators.audit import run_id_of, with_run_audit
from quayside.operators.filters import latest_snapshot
from quayside.plans import publish
from quayside.queries.register import query, table
from quayside.queries.scans import day_of
from quayside.session import scratch_path
from quayside.sources.tables import external_table
from quayside.streaming.arrivals import stream_ingest


@query("publish_csv_overwrite", "select o_orderkey, o_totalprice, o_orderpriority, o_orderdate::varchar o_orderdate from orders")
def publish_csv_overwrite(spark, sf_dir):
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders")
    publish.publish_csv_overwrite(orders.select("o_orderkey").filter("o_orderstatus = 'P'"), path)
    publish.publish_csv_overwrite(orders.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate"), path)
    schema = "o_orderkey bigint, o_totalprice double, o_orderpriority string, o_orderdate timestamp_ntz"
    return spark.read.options(**publish.CSV_OPTIONS).schema(schema).csv(path)


@query(
    "publish_dated",
    """select o_orderkey, o_totalprice, '2025-03-09' dt from orders where o_orderstatus = 'F'
       union all select o_orderkey, o_totalprice, '2025-03-10' from orders""",
)
def publish_dated(spark, sf_dir):
    path = scratch_path(spark, "dated")
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", "o_totalprice")
    publish.publish_dated(rows.filter(orders["o_orderstatus"] == "F"), path, date(2025, 3, 9))
    publish.publish_dated(rows.filter(orders["o_orderstatus"] == "P"), path, date(2025, 3, 10))
    publish.publish_dated(rows, path, date(2025, 3, 10))
    return external_table(spark, path, "csv", "o_orderkey bigint, o_totalprice double, dt date")


@query(
    "replace_partition",
    """select o_orderkey, case when year(o_orderdate) = 1997 then -o_totalprice else o_totalprice end o_totalprice,
              o_orderdate::date::varchar dt from orders""",
)
def replace_partition(spark, sf_dir):
    path = scratch_path(spark, "replace")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", day_of("o_orderdate").alias("dt"))
    publish.replace_partition(rows, path, "dt")
    again = rows.filter(F.year("dt") == 1997).withColumn("o_totalprice", -F.col("o_totalprice"))
    publish.replace_partition(again, path, "dt")
    return external_table(spark, path)


@query(
    "bounded_files",
    "select l_orderkey, l_linenumber, l_shipdate::varchar l_shipdate, true as within_bound from lineitem",
)
def bounded_files(spark, sf_dir):
    path = scratch_path(spark, "bounded")
    publish.bounded_files(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), path, 5000)
    rows = spark.read.parquet(path)
    # a row's number in its file never reaches the bound
    return rows.select("*", (F.col("_metadata.row_index") < 5000).alias("within_bound"))


@query(
    "append_run",
    """select o_orderkey, '2025-03-09 02:00:00' dt_ingestao, '20250309T020000Z' id_execucao, '2025-03-09' dt
       from orders where o_orderstatus = 'F'
       union all select o_orderkey, '2025-03-09 14:00:00', '20250309T140000Z', '2025-03-09' from orders""",
)
def append_run(spark, sf_dir):
    path = scratch_path(spark, "append")
    orders = table(spark, sf_dir, "orders")
    runs = [(orders.filter("o_orderstatus = 'F'"), datetime(2025, 3, 9, 2)), (orders, datetime(2025, 3, 9, 14))]
    for rows, run in [*runs, runs[1]]:  # the second run is retried
        publish.append_run(with_run_audit(rows.select("o_orderkey"), run), path, run.date(), run_id_of(run))
    return external_table(spark, path)


@query(
    "merge_range",
    """select o_orderkey, o_totalprice, o_orderdate::date::varchar "DT" from orders
       where year(o_orderdate) not between 1996 and 1998
       union all
       select o_orderkey, -o_totalprice, o_orderdate::date::varchar from orders
       where year(o_orderdate) in (1997, 1998, 2000)""",
)
def merge_range(spark, sf_dir):
    path = scratch_path(spark, "merge")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", day_of("o_orderdate").alias("DT"))
    publish.replace_partition(rows, path, "DT")
    # the snapshot lacks 1996, which must vanish, and brings rows of 2000, outside the range
    snapshot = rows.filter(F.year("DT").isin(1997, 1998, 2000)).withColumn("o_totalprice", -F.col("o_totalprice"))
    publish.merge_range(spark, snapshot, path, "1996-01-01", "1998-12-31")
    return external_table(spark, path)


@query("full_refresh", "select o_orderkey, o_totalprice from orders where o_orderstatus <> 'P'")
def full_refresh(spark, sf_dir):
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "refresh")
    orders = table(spark, sf_dir, "orders")
    publish.full_refresh(orders.select("o_orderkey", "o_totalprice"), path)
    run = datetime(2025, 3, 9, 2)
    publish.append_run(with_run_audit(orders.filter("o_orderstatus <> 'P'"), run), landing, run.date(), run_id_of(run))
    snapshot = latest_snapshot(external_table(spark, landing))
    publish.full_refresh(snapshot.select("o_orderkey", "o_totalprice"), path)
    return spark.read.parquet(path)


EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "ts"]
EVENT_TYPES = {"event_id": "INTEGER", "user_id": "INTEGER", "event_type": "STRING", "value": "FLOAT", "ts": "TIMESTAMP"}


@query(
    "stream_ingest",
    """select event_id, case when event_id % 50 <> 0 then user_id end user_id, event_type, value, ts::varchar ts,
              case when day(ts) <= 15 then '2024-01-15' else '2024-01-30' end run from events""",
)
def stream_ingest_query(spark, sf_dir):
    arrivals, target, checkpoint = (scratch_path(spark, n) for n in ("arrivals", "stream", "checkpoint"))
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 50 == 0, "anonymous").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        "event_type",
        "value",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
    )
    text = {"sep": "|", "quote": "", "escape": "", "header": True, "compression": "gzip"}
    first = F.dayofmonth(F.col("ts").cast("timestamp_ntz")) <= 15
    events.filter(first).write.csv(f"{arrivals}/run=2024-01-15", **text)
    stream_ingest(spark, arrivals, target, checkpoint, EVENT_COLUMNS, EVENT_TYPES)
    # the second call finds the first run's files in its checkpoint and takes only the new ones
    events.filter(~first).write.csv(f"{arrivals}/run=2024-01-30", **text)
    stream_ingest(spark, arrivals, target, checkpoint, EVENT_COLUMNS, EVENT_TYPES, rejects=f"{target}-rejects")
    return external_table(spark, target).drop("arrival")


@query(
    "stream_resent",
    """select event_id, user_id, case when day(ts) <= 15 then -value else value end "value",
              case when day(ts) <= 15 then '2024-01-15' else '2024-01-30' end run
       from events where not (day(ts) > 15 and user_id % 4 = 3)""",
)
def stream_resent(spark, sf_dir):
    """Files of a first run are sent again with other rows, one of a second run without any; the rest is not read again."""
    arrivals, target, checkpoint = (scratch_path(spark, n) for n in ("arrivals", "stream", "checkpoint"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    text = {"sep": "|", "quote": "", "escape": "", "header": True, "compression": "gzip"}
    first = F.dayofmonth("ts") <= 15

    def send(rows, folder):
        """One file, by a name that stays."""
        staged = scratch_path(spark, "sent")
        rows.select("event_id", "user_id", "value").coalesce(1).write.csv(staged, **text)
        part = next(n for n in storage.child_files(spark, staged) if n.endswith(".gz"))
        storage.make_folder(spark, folder)
        storage.delete(spark, f"{folder}/events.csv.gz")
        storage.rename(spark, f"{staged}/{part}", f"{folder}/events.csv.gz")

    def ingest():
        stream_ingest(spark, arrivals, target, checkpoint, ["event_id", "user_id", "value"], EVENT_TYPES)

    send(events.filter(first), f"{arrivals}/run=2024-01-15/a")
    for rest in range(4):
        send(events.filter(~first & (F.col("user_id") % 4 == rest)), f"{arrivals}/run=2024-01-30/b{rest}")
    ingest()
    send(events.filter(first).withColumn("value", -F.col("value")), f"{arrivals}/run=2024-01-15/a")
    send(events.limit(0), f"{arrivals}/run=2024-01-30/b3")
    ingest()
    return external_table(spark, target).drop("arrival")
