"""Duplicates, latest rows, ordered distinct and positional concatenation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import scratch_path


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key. Spark cuts ``row_number() = 1`` to one row per key inside each input
    partition before the shuffle, so a hot key sends a row per task and not all of its rows."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Drop duplicates on the keys and keep the row that comes first.

    "First" needs a stated order: order columns, or for parquet the file and the row in it.
    """
    if order:
        return _first_per_key(df, keys, [F.col(c) for c in order])
    placed = df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    return _first_per_key(placed, keys, [F.col("_file"), F.col("_row")]).drop("_file", "_row")


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    sort: Sequence[str],
    deleted: str | None = None,
    deleted_value: bool = False,
) -> DataFrame:
    """The newest row per key, then only those whose ``deleted`` field has the wanted value."""
    newest = _first_per_key(df, keys, [F.col(c).desc() for c in sort])
    return newest if deleted is None else newest.filter(F.col(deleted) == F.lit(deleted_value))


def ordered_distinct(
    df: DataFrame, keys: Sequence[str], order: str, cap: int | None = None, seen: str | None = None
) -> DataFrame:
    """Distinct keys in the order they were first seen, on request with that place as ``seen``.

    A caller that wants only the first ``cap`` says so; nothing is cut otherwise.
    """
    first = df.groupBy(*keys).agg(F.min(order).alias("_seen")).orderBy("_seen", *keys)
    first = first if cap is None else first.limit(cap)
    return first.withColumnRenamed("_seen", seen) if seen else first.drop("_seen")


def with_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Number the rows 1, 2, … in the given order without putting them into one task.

    The rows are range-partitioned, sorted and written once, so each file holds a stretch of the
    order; a row's number is the count of rows in the files before its own plus its row in the file.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "positions")
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows that tie are told apart by their content, so that one value of the order does not fill one task
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    sliced = df.repartitionByRange(slices, *order, tie).sortWithinPartitions(*order, tie)
    sliced.write.option("maxRecordsPerFile", 0).parquet(path)
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int")
    rows = spark.read.schema(df.schema).parquet(path).withColumns(
        {"_part": part, "_index": F.col("_metadata.row_index")}
    )
    # one file per slice, so there are at most ``slices`` rows here: one task, then a broadcast
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    numbered = rows.join(F.broadcast(starts), "_part")
    return numbered.select(*df.columns, (F.col("_start") + F.col("_index") + 1).alias(name))


def positional_concat(
    left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]
) -> DataFrame:
    """Put two tables side by side by row number; the shorter one is padded with nulls."""
    return with_position(left, left_order).join(with_position(right, right_order), "position", "full")
