"""Incremental windows, watermarks, snapshots, cycles, duplicates."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from quayside.operators import dedup, filters
from quayside.operators.audit import run_id_of, with_run_audit
from quayside.operators.casting import typed_projection
from quayside.plans.publish import append_run
from quayside.queries.casting import SQLSERVER_LINES, _doubles
from quayside.queries.register import as_text, query, table
from quayside.queries.scans import events_with_deleted
from quayside.session import scratch_path
from quayside.sources.tables import external_table


@query(
    "incremental_window",
    "select event_id, ts::varchar ts, event_type from events where ts >= timestamp '2024-01-10' and event_type <> 'error'",
)
def incremental_window(spark, sf_dir):
    rows = events_with_deleted(spark, sf_dir)
    return filters.incremental_window(rows, "ts", "2024-01-10").select("event_id", "ts", "event_type")


@query(
    "lookback_window",
    "select event_id, ts::varchar ts from events where ts >= timestamp '2024-01-18' and ts < timestamp '2024-01-25'",
)
def lookback_window(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return filters.lookback_window(rows, "ts", date(2024, 1, 20))


@query("high_watermark", "select (max(ts)::date - 1)::varchar watermark from events")
def high_watermark(spark, sf_dir):
    target = table(spark, sf_dir, "events").withColumn("DT", F.to_date("ts"))
    return filters.high_watermark(target)


CUT_OFF = datetime(1998, 6, 1)
FIRST_RUN = datetime(2025, 3, 9, 2, 0, 0)
SECOND_RUN = datetime(2025, 3, 10, 2, 0, 0)


def land_lines_twice(spark, sf_dir) -> str:
    """Line items landed as text on two days: first those shipped before the cut-off, then all."""
    path = scratch_path(spark, "landing")
    lines = table(spark, sf_dir, "lineitem")
    for rows, run in ((lines.filter(F.col("l_shipdate") < F.lit(CUT_OFF)), FIRST_RUN), (lines, SECOND_RUN)):
        append_run(with_run_audit(as_text(rows), run), path, run.date(), run_id_of(run))
    return path


def typed_snapshot(spark, sf_dir):
    """The flagship chain: land twice, external table, latest snapshot, typed projection with ``DT``."""
    landed = external_table(spark, land_lines_twice(spark, sf_dir))
    return typed_projection(filters.latest_snapshot(landed), SQLSERVER_LINES, "sqlserver", "l_shipdate")


_SNAPSHOT = """
    select l_shipdate::date::varchar "DT", l_orderkey "L_ORDERKEY", l_linenumber::bigint "L_LINENUMBER",
           l_quantity "L_QUANTITY", l_extendedprice "L_EXTENDEDPRICE", l_discount "L_DISCOUNT",
           l_returnflag "L_RETURNFLAG", l_shipdate::varchar "L_SHIPDATE",
           '2025-03-10 02:00:00' "DT_INGESTAO", '20250310T020000Z' "ID_EXECUCAO" from lineitem
"""


@query("typed_snapshot", _SNAPSHOT)
def typed_snapshot_query(spark, sf_dir):
    return _doubles(typed_snapshot(spark, sf_dir))


@query(
    "latest_snapshot",
    """select o_orderkey::varchar o_orderkey, o_orderpriority, '2025-03-10' dt, '2025-03-10 02:00:00' dt_ingestao,
              '20250310T020000Z' id_execucao from orders""",
)
def latest_snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshots")
    orders = as_text(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"))
    append_run(with_run_audit(orders, FIRST_RUN), path, FIRST_RUN.date(), run_id_of(FIRST_RUN))
    append_run(with_run_audit(orders, SECOND_RUN), path, SECOND_RUN.date(), run_id_of(SECOND_RUN))
    return filters.latest_snapshot(external_table(spark, path))


@query(
    "eligible_cycles",
    """select id from (
         select o_custkey::varchar id, min(o_orderkey) seen from orders
         where o_orderkey % 13 <> 0 and o_orderdate::date >= date '2001-07-01' - 47 group by 1
         order by seen, id) order by id""",
)
def eligible_cycles(spark, sf_dir):
    return filters.eligible_cycles(_cycles(spark, sf_dir, "o_custkey"), date(2001, 7, 1), "o_orderkey")


def _cycles(spark, sf_dir, key: str):
    """A cycle record per order, with end dates as API text; every thirteenth does not parse."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    k = F.col("o_orderkey") % 13
    end = (
        F.when(k == 0, F.lit("soon"))
        .when(k % 2 == 0, F.concat(day, F.lit("T23:30:00.52Z")))
        .otherwise(F.concat(day, F.lit("T23:30:00-03:00")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col(key).alias("id"), end.alias("cycleEndDate"))


@query(
    "ordered_distinct",
    "select user_id, event_type, min(event_id) seen from events group by 1, 2",
)
def ordered_distinct(spark, sf_dir):
    return dedup.ordered_distinct(table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id", seen="seen")


@query(
    "dedup_keep_first",
    """select event_id, user_id, event_type, value, props from
       (select *, row_number() over (partition by user_id, event_type order by event_id) rn from events) where rn = 1""",
)
def dedup_keep_first(spark, sf_dir):
    return dedup.dedup_keep_first(table(spark, sf_dir, "events").drop("ts"), ["user_id", "event_type"], ["event_id"])


@query(
    "latest_by_key",
    """select event_id, user_id, ts::varchar ts, deleted from
       (select event_id, user_id, ts, event_type = 'error' as deleted,
               row_number() over (partition by user_id order by ts desc, event_id desc) rn from events)
       where rn = 1 and not deleted""",
)
def latest_by_key(spark, sf_dir):
    rows = events_with_deleted(spark, sf_dir).select("event_id", "user_id", "ts", "deleted")
    return dedup.latest_by_key(rows, ["user_id"], ["ts", "event_id"], "deleted")


@query(
    "footer_watermark",
    """select (max(o_orderdate::date) - 1)::date::varchar as watermark, '1900-01-01' as nothing_yet from orders""",
)
def footer_watermark(spark, sf_dir):
    """The watermark of a table that is not partitioned by its day: it comes from the files' footers."""
    path = scratch_path(spark, "watermark")
    table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("DT"), "o_orderkey").write.parquet(path)
    found = [(filters.start_of_extract(spark, path), filters.start_of_extract(spark, f"{path}-none"))]
    return spark.createDataFrame(found, "watermark date, nothing_yet date")
