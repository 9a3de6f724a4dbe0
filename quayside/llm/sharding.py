"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Groups of equal texts stay together. The packing sees a number of parcels that depends on the number of shards
only: a group that is large against a shard is a parcel of its own (one that is larger than a parcel may be is
split by its ids), all other groups are dealt into parcels by the hash of their text. Each parcel, largest
first, goes where the dot product of its size vector with a shard's residual capacity is highest among the
shards that can still take its bytes. Only the parcels' three sums come to the driver.

Places within a shard come from counts: a parcel begins where the one before it in the shard ends, and inside
a parcel rows are numbered in pieces of bounded size, so no window runs over a whole shard.

Defined results: a null text has no bytes and no tokens (its row still takes the fixed overhead) and is grouped
with the empty text; equal rows are numbered apart; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import scratch_path

OVERHEAD = 8


def pack(sizes: np.ndarray, shards: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Shard of each parcel (rows of ``sizes``: bytes, tokens, rows); the last parcels level the bytes."""
    weights = np.array([1.0, 1.0, 1.0]) if weights is None else weights
    total = sizes.sum(axis=0).astype(float)
    share = np.divide(sizes, total / shards, out=np.zeros(sizes.shape), where=total > 0)
    left = np.ones((shards, sizes.shape[1]))
    place = np.zeros(len(sizes), dtype=np.int32)
    order = np.lexsort((np.arange(len(sizes)), -share[:, 0]))
    for i in order:
        fits = left[:, 0] >= share[i, 0]
        score = (left * (share[i] * weights)).sum(axis=1)
        if not fits.any():
            score = left[:, 0]  # nothing has room: the emptiest by bytes
            fits = np.ones(shards, dtype=bool)
        best = int(np.argmax(np.where(fits, score, -np.inf)))
        place[i] = best
        left[best] -= share[i]
    return place


def shard(
    spark: SparkSession,
    documents: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    parcels_per_shard: int = 256,
    piece_rows: int = 50_000,
) -> DataFrame:
    """Per document row: ``id, size, tokens, text_crc32, shard, slot`` under the law ``bytes``.

    ``parcels_per_shard`` sets how fine the packing is: sizes differ by about a parcel at most, unless a single
    document is larger than that.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.regexp_count(text, F.lit(r"\S+")).cast("bigint").alias("tokens"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
    )
    # the texts are read once; what follows works on a narrow table
    narrow = scratch_path(spark, "shard-rows")
    rows.write.parquet(narrow)
    rows = spark.read.parquet(narrow)
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("size", "tokens")] + [F.count(F.lit(1)).alias("n")]
    total = rows.agg(*sums).first()
    if not total.n:
        return rows.select("id", "size", "tokens", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    parcels = shards * parcels_per_shard
    unit = [max(1, -(-x // parcels)) for x in (total.size, total.tokens, total.n)]
    # at most 3 * parcels groups are this large: their sums cannot exceed the totals
    pieces = F.greatest(*[F.ceil(F.col(c) / F.lit(u)) for c, u in zip(("size", "tokens", "n"), unit)])
    large = rows.groupBy("group").agg(*sums).withColumn("units", pieces).where("units > 1").select("group", "units")
    per_shard = parcels_per_shard // 4
    dealt = rows.join(large, "group", "left").select(
        "id", "size", "tokens", "text_crc32",
        F.when(F.col("units").isNull(), F.concat(F.lit("s"), F.pmod(F.xxhash64("group"), F.lit(parcels))))
        # a group of up to a quarter of a shard stays whole; a larger one is dealt by its ids
        .when(F.col("units") <= per_shard, F.concat(F.lit("g"), F.col("group")))
        .otherwise(F.concat(F.lit("p"), F.col("group"), F.lit("-"), F.pmod(F.xxhash64("id"), F.ceil(F.col("units") / 4))))
        .alias("parcel"),
    )
    table = sorted(dealt.groupBy("parcel").agg(*sums).collect(), key=lambda r: r.parcel)
    place = pack(np.array([[r.size, r.tokens, r.n] for r in table], dtype=float), shards)
    offset, filled = [], [0] * shards
    for r, s in zip(table, place):
        offset.append(filled[s])
        filled[s] += r.n
    homes = spark.createDataFrame(
        [(r.parcel, int(s), o, max(1, -(-r.n // piece_rows))) for r, s, o in zip(table, place, offset)], "parcel string, shard int, begin bigint, pieces int"
    )
    placed = dealt.join(F.broadcast(homes), "parcel").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    before = Window.partitionBy("parcel").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("parcel", "piece").agg(F.count(F.lit(1)).alias("n")).select("parcel", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("parcel", "piece").orderBy("id", "text_crc32", "size")
    return (
        placed.withColumn("at", F.row_number().over(inside))
        .join(starts, ["parcel", "piece"])
        .select("id", "size", "tokens", "text_crc32", "shard", (F.col("begin") + F.col("skip") + F.col("at") - 1).alias("slot"))
    )
