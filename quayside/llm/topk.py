"""Exact top-k by inner product: buckets of like length, pruned by length or by coordinates, then verified.

Vectors are grouped by their length within each task. For a query with a known lower bound of its k-th score, a
bucket has a local cosine threshold: bound / (query length x the bucket's largest length). Over 1, the whole
bucket is passed over (length pruning). A high threshold prunes by coordinates: a partial product over the
query's heaviest coordinates plus the product of the remaining lengths bounds the score from above. A low one
would prune nothing, so only the length product of each vector is compared. Survivors are multiplied out in
whole numbers, which decides.

Lower bounds come first from the globally longest vectors, then from each bucket as it is scanned. Queries go to
the tasks in blocks of bounded size; each task returns k rows a query at most, which a window merges.

Defined results: vectors that are null, or hold null or non-finite components, take no part (nor do empty ones
and those of another dimension than the most common); a query never finds its own row; ties go to the smaller
id; repeated ids are separate candidates, but none of them answers a query of the same id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SCHEMA = "query_id bigint, vec_id bigint, score bigint"


def quantized(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, v`` (whole numbers), ``norm`` of the vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    good = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & good).select(
        F.col(id_col).cast("bigint").alias("id"), F.transform(v, lambda x: F.floor(x * scale).cast("double")).alias("v")
    )
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= bar)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _search(queries, k: int, bucket_rows: int, focus: int, prune_from: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q, q_norm, bound = queries.value
        bound = bound.copy()
        n_q, dim = q.shape
        heavy = np.argsort(-np.abs(q), axis=1)[:, :focus]
        top = [(np.zeros(0), np.zeros(0, np.int64))] * n_q
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def scan(ids: np.ndarray, v: np.ndarray) -> None:
            norm = np.sqrt((v * v).sum(axis=1))
            order = np.argsort(-norm, kind="stable")
            ids, v, norm = ids[order], v[order], norm[order]
            # buckets: neighbours in length, closed where it falls by a tenth or the bucket is full
            at = 0
            while at < len(ids):
                end = int(np.searchsorted(-norm, -0.9 * norm[at], side="right"))
                end = min(max(end, at + 1), at + bucket_rows)
                part, own, length = v[at:end], ids[at:end], norm[at:end]
                with np.errstate(divide="ignore", invalid="ignore"):
                    local = np.where(bound > -np.inf, bound / np.maximum(q_norm * length[0], 1e-300), -np.inf)
                near = np.flatnonzero(local <= 1.0 + 1e-9)
                sharp = near[local[near] >= prune_from]
                blunt = near[local[near] < prune_from]
                for b in range(0, len(blunt), 256):
                    some = blunt[b : b + 256]
                    scores = q[some] @ part.T
                    for i, row in zip(some.tolist(), scores):
                        keep(i, own, row)
                for i in sharp.tolist():
                    axes = heavy[i]
                    seen = part[:, axes]
                    partial = seen @ q[i, axes]
                    rest_q = max(0.0, q_norm[i] ** 2 - float(q[i, axes] @ q[i, axes]))
                    rest = np.maximum(0.0, length**2 - (seen * seen).sum(axis=1))
                    live = np.flatnonzero(partial + np.sqrt(rest * rest_q) * (1 + 1e-9) + 1e-6 >= bound[i])
                    if len(live):
                        keep(i, own[live], part[live] @ q[i])
                at = end

        def keep(i: int, ids: np.ndarray, scores: np.ndarray) -> None:
            ok = (scores >= bound[i]) & (ids != q_ids[i])
            if not ok.any():
                return
            s, d = np.concatenate([top[i][0], scores[ok]]), np.concatenate([top[i][1], ids[ok]])
            best = _best(s, d, k)
            top[i] = (s[best], d[best])
            if len(best) == k:
                bound[i] = max(bound[i], s[best][-1])

        for batch in batches:
            if batch.num_rows:
                held.append((np.asarray(batch.column("id"), dtype=np.int64), _matrix(batch.column("v"), dim)))
            if sum(len(x[0]) for x in held) >= 8 * bucket_rows:
                scan(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
                held = []
        if held:
            scan(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
        n = [len(t[0]) for t in top]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(q_ids, n)),
                pa.array(np.concatenate([t[1] for t in top]) if sum(n) else np.zeros(0, np.int64)),
                pa.array(np.concatenate([t[0] for t in top]).astype(np.int64) if sum(n) else np.zeros(0, np.int64)),
            ],
            names=["query_id", "vec_id", "score"],
        )

    return rows


def top_k(
    spark: SparkSession,
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = 1024,
    query_block: int = 4096,
    bucket_rows: int = 4096,
    focus: int = 24,
    prune_from: float = 0.6,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``is_query`` its k best other rows.

    At most ``query_block`` queries are held by the driver and by a task at once; more make more passes.
    """
    rows = quantized(vectors, id_col, vec_col, scale)
    shape = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if shape is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dim = shape.dim
    rows = rows.where(F.size("v") == dim)
    asked = quantized(vectors.where(is_query), id_col, vec_col, scale).where(F.size("v") == dim)
    blocks = max(1, -(-asked.count() // query_block))
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
    longest = rows.orderBy(F.desc("norm"), "id").limit(8 * max(k, 32)).collect()
    first = np.array([r.v for r in longest]).reshape(-1, dim)
    first_ids = np.array([r.id for r in longest], dtype=np.int64)
    found = None
    for b in range(blocks):
        block = numbered.where(F.col("block") == b).select("id", "v").distinct().orderBy("id").collect()
        if not block:
            continue
        q = np.array([r.v for r in block]).reshape(-1, dim)
        ids = np.array([r.id for r in block], dtype=np.int64)
        bound = np.full(len(block), -np.inf)
        if len(longest) > k:
            scores = np.where(first_ids[None, :] == ids[:, None], -np.inf, q @ first.T)
            bound = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        held = spark.sparkContext.broadcast((ids, q, np.sqrt((q * q).sum(axis=1)), bound))
        part = rows.select("id", "v").mapInArrow(_search(held, k, bucket_rows, focus, prune_from), _SCHEMA)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
