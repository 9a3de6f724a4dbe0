"""Vectors as a few bytes: each part of a vector becomes the number of its nearest codebook entry.

Components become integers, ``floor(scale * x)``, and a vector is cut into consecutive parts with a codebook each. The
entries start as the parts of the smallest ids, and every round assigns all parts to their nearest entry (ties to the
lower number) and moves each entry to the floor of its parts' mean. All of it is integer arithmetic, so the outcome does
not depend on how the rows are spread.

Assignment is ball k-means. Between rounds a row keeps its codes. An entry with the parts it had is a ball, whose radius
is bounded by its farthest part and the way the entry has moved; only entries at most two radii away are its neighbours.
A part at distance r from its own entry can be nearer to another one only if that one is within 2r of it: parts in the
core, with no neighbour that close, stay without another look, and the others are compared with the neighbours up to
their own ring. The test is ``|a - b|**2 <= 4 r**2`` in integers, so no tie is lost. The first round has no balls yet and
compares with all entries.

What moves: sums of each entry's parts, one row per entry from each task, met in partial sums. The driver holds the
codebooks, ``parts * entries`` entries, and tasks get them with their neighbour lists. The rows are written once a round
to the shared folder, the round before is deleted, so a lost executor repeats one round's tasks at most.

Rules. A vector that is null or holds a null or a number that is not finite takes no part. Rows are ordered by id, null
last, then by vector; repeated ids are rows of their own. Fewer rows than entries give smaller codebooks. Unused entries
stay. A length that ``parts`` does not divide is cut as evenly as whole numbers allow. The row of the smallest id says
how long vectors are; others of another length have no code and no error (null). Components beyond 2**26 after scaling
are an error: squared distances would leave 64 bits. No rows give no rows and empty codebooks. Other columns of the
table are not read, so they may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.components import dropped, stored

#: Integers beyond this are refused: a difference, squared and summed over 64 components, stays below 2**60.
LARGEST = 1 << 26
#: So many pairs of a part and an entry are compared at once, which bounds a task's memory.
_PAIRS = 1 << 17


@dataclass(frozen=True)
class Codebooks:
    """``cuts`` bounds the parts in a vector; ``entries[p]`` has the entries of part p as rows."""

    cuts: tuple[int, ...]
    entries: tuple[np.ndarray, ...]

    def sha256(self) -> str:
        """Hash of all components by part, entry and place, as decimal numbers with commas."""
        return hashlib.sha256(",".join(str(x) for book in self.entries for x in book.ravel().tolist()).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, wrong), F.lit(False))


def _whole(rows: np.ndarray, scale: int) -> np.ndarray:
    out = np.floor(scale * rows.astype(np.float64))
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"a scaled component is beyond {LARGEST}")
    return out.astype(np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as rows of a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), width)


def _stored_rows(column: pa.Array, width: int, kind: np.dtype) -> np.ndarray:
    """A binary column of rows of one size as a matrix."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw.view(kind).reshape(len(column), width)


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * size
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and its squared distance, compared with all entries."""
    code, far = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    step = max(1, _PAIRS // max(1, len(book)))
    for at in range(0, len(x), step):
        apart = x[at : at + step, None, :] - book[None, :, :]
        square = np.einsum("ijk,ijk->ij", apart, apart)
        code[at : at + step] = square.argmin(1)  # the first of equals
        far[at : at + step] = square.min(1)
    return code, far


@dataclass(frozen=True)
class Balls:
    """A part's entries, and of each the neighbours by distance: ``order[starts[i]:starts[i + 1]]`` and ``square`` likewise."""

    book: np.ndarray
    starts: np.ndarray
    order: np.ndarray
    square: np.ndarray


def balls(book: np.ndarray, radius: np.ndarray) -> Balls:
    """Neighbours of each entry: those within two radii. ``radius`` bounds the squares of the radii from above."""
    apart = book[:, None, :] - book[None, :, :]
    square = np.einsum("ijk,ijk->ij", apart, apart)
    np.fill_diagonal(square, np.iinfo(np.int64).max)
    order = np.argsort(square, axis=1, kind="stable")
    ranked = np.take_along_axis(square, order, axis=1)
    # radii reach 2**63: halve the distance rather than double the radius
    near = (ranked >> 2 <= radius[:, None]) & (ranked < np.iinfo(np.int64).max)
    counts = near.sum(1)
    return Balls(book, np.concatenate([[0], np.cumsum(counts)]), order[near], ranked[near])


def reassigned(x: np.ndarray, was: np.ndarray, ball: Balls) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each row from its former one, its squared distance, and how many entries were looked at besides."""
    apart = x - ball.book[was]
    far = np.einsum("ij,ij->i", apart, apart)
    code = was.copy()
    # how many neighbours lie within twice the distance: places in one sorted list of (entry, distance)
    reach = np.zeros(len(x), np.int64)
    by = np.argsort(was, kind="stable")
    bounds = np.searchsorted(was[by], np.arange(len(ball.book) + 1))
    for i in np.flatnonzero(np.diff(bounds)):
        rows = by[bounds[i] : bounds[i + 1]]
        reach[rows] = np.searchsorted(ball.square[ball.starts[i] : ball.starts[i + 1]], 4 * far[rows], side="right")
    rings = np.flatnonzero(reach)  # the others are in the core of their ball
    total = np.cumsum(reach[rings])
    at = 0
    while at < len(rings):
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + _PAIRS, side="right")))
        rows, n = rings[at:end], reach[rings[at:end]]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first - ball.starts[was[rows]], n)
        entry = ball.order[place]
        apart = np.repeat(x[rows], n, axis=0) - ball.book[entry]
        square = np.einsum("ij,ij->i", apart, apart)
        least = np.minimum(np.minimum.reduceat(square, first), far[rows])
        # of the entries at the least distance the lowest number, the former one among them
        candidate = np.where(square == np.repeat(least, n), entry, len(ball.book))
        own = np.where(far[rows] == least, was[rows], len(ball.book))
        code[rows], far[rows] = np.minimum(np.minimum.reduceat(candidate, first), own), least
        at = end
    return code, far, int(reach.sum())


def _spans(cuts: tuple[int, ...]) -> list[slice]:
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def _code_type(books: Codebooks) -> np.dtype:
    return np.dtype("u1" if len(books.entries[0]) <= 256 else ">u2")


def _quantised(rows: DataFrame, cuts: tuple[int, ...], scale: int) -> DataFrame:
    """``id, label, vector``: components as 32-bit integers in one binary value."""
    width = cuts[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _whole(_matrix(batch.column("vector"), width), scale).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), _binary(whole)], ["id", "label", "vector"])

    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("vector", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def _assigned(rows: DataFrame, books: Codebooks, around: list[Balls] | None) -> DataFrame:
    """Rows with their ``codes``, one byte or two a part, ``error``, and ``looks``: comparisons besides the own entry."""
    spans, width = _spans(books.cuts), books.cuts[-1]
    kind = _code_type(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            vectors = _stored_rows(batch.column("vector"), width, np.dtype(np.int32)).astype(np.int64)
            found, error, looks = np.zeros((n, len(spans)), kind), np.zeros(n, np.int64), 0
            was = None if around is None else _stored_rows(batch.column("codes"), len(spans), kind).astype(np.int64)
            for p, span in enumerate(spans):
                if was is None:
                    code, far = nearest(vectors[:, span], books.entries[p])
                    more = n * len(books.entries[p])
                else:
                    code, far, more = reassigned(vectors[:, span], was[:, p], around[p])
                found[:, p], error, looks = code, error + far, looks + more
            counted = np.zeros(n, np.int64)
            counted[:1] = looks  # of the whole batch, at its first row
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("vector"), _binary(found), pa.array(error), pa.array(counted)],
                ["id", "label", "vector", "codes", "error", "looks"],
            )

    fields = [rows.schema["id"], rows.schema["label"], rows.schema["vector"], T.StructField("codes", T.BinaryType())]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("error", T.LongType()), T.StructField("looks", T.LongType())]))


def _sums(rows: DataFrame, books: Codebooks) -> dict[tuple[int, int], tuple[int, int, list[int]]]:
    """Of each used entry (part, number): how many parts it has, the square of its ball's radius, and the sums of their components."""
    spans, width, size = _spans(books.cuts), books.cuts[-1], len(books.entries[0])
    widest = max(s.stop - s.start for s in spans)
    kind = _code_type(books)
    names = [f"s{i}" for i in range(widest)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, far = np.zeros((len(spans), size), np.int64), np.zeros((len(spans), size), np.int64)
        total = np.zeros((len(spans), size, widest), np.int64)
        for batch in batches:
            vectors = _stored_rows(batch.column("vector"), width, np.dtype(np.int32)).astype(np.int64)
            codes = _stored_rows(batch.column("codes"), len(spans), kind).astype(np.int64)
            for p, span in enumerate(spans):
                x, own = vectors[:, span], codes[:, p]
                apart = x - books.entries[p][own]
                np.maximum.at(far[p], own, np.einsum("ij,ij->i", apart, apart))
                np.add.at(total[p], (own, slice(0, x.shape[1])), x)
                n[p] += np.bincount(own, minlength=size)
        part, entry = np.nonzero(n)
        columns = [part.astype(np.int32), entry.astype(np.int32), n[part, entry], far[part, entry], *total[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "n", "far", *names])

    schema = "part int, entry int, n long, far long" + "".join(f", {s} long" for s in names)
    met = rows.select("vector", "codes").mapInArrow(run, schema).groupBy("part", "entry")
    # at most parts * entries rows
    found = met.agg(F.sum("n").alias("n"), F.max("far").alias("far"), *[F.sum(s).alias(s) for s in names]).collect()
    return {(r["part"], r["entry"]): (r["n"], r["far"], [r[s] for s in names]) for r in found}


def _updated(books: Codebooks, sums: dict) -> tuple[Codebooks, list[Balls]]:
    """Entries moved to the floor of their parts' mean, with the balls of the new entries."""
    moved, around = [], []
    for p, (book, span) in enumerate(zip(books.entries, _spans(books.cuts))):
        new, radius = book.copy(), np.zeros(len(book), np.int64)
        for e in range(len(book)):
            if (p, e) not in sums:
                continue
            n, far, total = sums[p, e]
            new[e] = [s // n for s in total[: span.stop - span.start]]
            shift = int(((new[e] - book[e]) ** 2).sum())
            # farthest part and way moved, both rounded up
            radius[e] = (math.isqrt(far) + 1 + math.isqrt(shift) + 1) ** 2
        moved.append(new)
        around.append(balls(new, radius))
    return Codebooks(books.cuts, tuple(moved)), around


def compress(
    spark: SparkSession,
    table: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> tuple[DataFrame, Codebooks]:
    """``id, label, codes, error, looks`` of each row that takes part, and the codebooks they refer to.

    ``codes`` has a number for each part; ``error`` is the squared distance to the coded vector; ``looks`` sums up to the
    comparisons of the last assignment besides those with a row's own entries.
    """
    if not 1 <= entries <= 1 << 16:
        raise ValueError("a codebook has 1 to 65,536 entries")
    rows = table.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")).where(usable(F.col("vector")))
    first = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).collect()
    width = len(first[0]["vector"]) if first else 0
    cuts = tuple(p * width // parts for p in range(parts + 1))
    fitting = rows.where(F.size("vector") == width)
    # as many rows as a codebook has entries
    start = [r["vector"] for r in fitting.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()]
    seeds = _whole(np.array(start, np.float64).reshape(len(start), width), scale)
    books = Codebooks(cuts, tuple(seeds[:, s] for s in _spans(cuts)))
    if not start:
        none = rows.select("id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error"), F.lit(0).cast("long").alias("looks"))
        return none.limit(0), books
    state, around = stored(spark, _quantised(fitting, cuts, scale), "vectors"), None
    for _ in range(rounds):
        before, state = state, stored(spark, _assigned(state, books, around), "codes")
        dropped(spark, before)
        books, around = _updated(books, _sums(state, books))
    coded = stored(spark, _assigned(state, books, around).drop("vector"), "coded")
    dropped(spark, state)
    wide = _code_type(books).itemsize
    number = lambda p: F.conv(F.hex(F.substring("codes", p * wide + 1, wide)), 16, 10).cast("int")
    coded = coded.withColumn("codes", F.array(*[number(p) for p in range(parts)]))
    odd = rows.where(F.size("vector") != width)
    odd = odd.select("id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error"), F.lit(0).cast("long").alias("looks"))
    return coded.unionByName(odd), books
