"""Incremental, snapshot and look-back filters."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import commits, storage
from quayside.functions.dates import bound, coerce_datetime, iso_day, wall_time
from quayside.operators.dedup import ordered_distinct

# Fixed value: where an extract starts when its target holds nothing yet.
FIRST_DAY = date(1900, 1, 1)


def incremental_window(
    df: DataFrame,
    field: str | None,
    start: date | datetime | str | None = None,
    end: date | datetime | str | None = None,
    deleted: str | None = "deleted",
) -> DataFrame:
    """Rows of ``[start, end)`` that are not deleted; no field, no filter.

    A timestamp column is compared as it is, so the bounds reach the parquet scan; text is parsed
    first. A row whose ``deleted`` is null is left out, as an equality test on the source does.
    """
    if not field:
        return df
    dtype = df.schema[field].dataType
    is_time = isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType))
    value = F.col(f"`{field}`") if is_time else coerce_datetime(F.col(f"`{field}`"))
    kept = df
    if start is not None:
        kept = kept.filter(value >= bound(wall_time(start), dtype))
    if end is not None:
        kept = kept.filter(value < bound(wall_time(end), dtype))
    if deleted:
        kept = kept.filter(~F.col(f"`{deleted}`"))
    return kept


def high_watermark(target: DataFrame, column: str = "DT") -> DataFrame:
    """One row: the day before the newest day of the target, or the first day when it is empty.

    Over a ``footer_scan`` of a table whose column is a date no row is read.
    """
    day = F.col(column) if isinstance(target.schema[column].dataType, T.DateType) else F.col(column).cast("date")
    newest = F.max(day)
    return target.agg(F.coalesce(F.date_sub(newest, 1), F.lit(FIRST_DAY)).alias("watermark"))


def footer_scan(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table read so that plain maxima, minima and counts come from the files' footers.

    The session beside the caller's own has two settings for it: the newer parquet source, and its push-down of
    aggregates. It serves numbers, booleans and dates; other types are read as ever.
    """
    beside = spark.newSession()
    beside.conf.set("spark.sql.sources.useV1SourceList", "")
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return beside.read.parquet(path)


def start_of_extract(
    spark: SparkSession, path: str, column: str = "DT", explicit: date | str | None = None
) -> date:
    """Where an extract begins: the explicit day, else the target's watermark, else the first day.

    A target partitioned by the column is only listed, be it plain folders or commits. One that is missing or has
    no such column also starts at the first day.
    """
    if explicit:
        return wall_time(explicit).date()
    days = [d for v in storage.partition_values(spark, path, column) if (d := _day(v))] or commits.partition_days(spark, path, column)
    if days:
        return max(days) - timedelta(days=1)
    try:
        return high_watermark(footer_scan(spark, path), column).first()["watermark"]
    except (AnalysisException, KeyError):
        return FIRST_DAY


def _day(text: str) -> date | None:
    try:
        return date.fromisoformat(text)
    except ValueError:
        return None


def newest_folder(spark: SparkSession, uri: str, column: str = "dt") -> date | None:
    """The newest day among the partition folders, from their listing; None where they are not all days."""
    days = [_day(v) for v in storage.partition_values(spark, uri, column)]
    return max(days) if days and all(days) else None


def latest_snapshot(
    df: DataFrame,
    day: str = "dt",
    ingested: str = "dt_ingestao",
    within_latest_dt: bool = False,
    newest_day: date | None = None,
) -> DataFrame:
    """Rows of the newest day that also carry the newest ingestion time.

    Both maxima are scalar subqueries: the one on the partition column prunes partitions at run time.
    They are taken over the whole table, so a late re-run of an older day leaves nothing;
    ``within_latest_dt`` takes the newest ingestion time of the newest day instead. A ``newest_day`` known from
    the folders is a literal: with both, one day's files are all that is opened.
    """
    newest = df.agg(F.max(day)).scalar() if newest_day is None else F.lit(newest_day.isoformat()).cast(df.schema[day].dataType)
    latest = df.where(F.col(day) == newest)
    pool = latest if within_latest_dt else df
    newest_load = pool.agg(F.max(F.col(ingested).cast("timestamp_ntz"))).scalar()
    return latest.where(F.col(ingested).cast("timestamp_ntz") == newest_load)


def eligible_cycles(
    cycles: DataFrame,
    run_date: date,
    order: str,
    key: str = "id",
    end_field: str = "cycleEndDate",
    offset_days: int = 2,
    keep_days: int = 45,
    cap: int | None = None,
) -> DataFrame:
    """Distinct keys of cycles that ended recently enough, first seen first; a caller may want only ``cap`` of them."""
    oldest = run_date - timedelta(days=offset_days + keep_days)
    recent = cycles.filter(
        F.col(key).isNotNull()
        & (F.col(key).cast("string") != "")
        & (iso_day(F.col(end_field)) >= F.lit(oldest))
    )
    keys = recent.select(F.col(key).cast("string").alias(key), F.col(order).alias("_order"))
    return ordered_distinct(keys, [key], "_order", cap)


def lookback_window(
    df: DataFrame, field: str, run_date: date, offset_days: int = 2, period_days: int = 7
) -> DataFrame:
    """Rows updated in the period that starts ``offset_days`` before the run, at midnight."""
    since = datetime(run_date.year, run_date.month, run_date.day) - timedelta(days=offset_days)
    until = since + timedelta(days=period_days)
    dtype = df.schema[field].dataType
    return df.filter((F.col(field) >= bound(since, dtype)) & (F.col(field) < bound(until, dtype)))
