"""Benchmark decontamination: a containment join on the rarest shingle of each benchmark window.

An item is cut into windows of ``window`` consecutive words (a shorter item is one window). For a window to
stand in a document, all its shingles must; so its necessary prefix, with shingles ordered by how often they
occur in the documents, is the single rarest one. Documents look up only those prefix shingles. A match fixes
where the window would begin (positional bound); it must fit between the document's first and last word
(length bound); then the words are compared, by hash and at last byte by byte.

The benchmark goes to the tasks in blocks of at most ``block_windows`` windows, each a bounded broadcast; more
windows make more passes over the documents, not a larger broadcast. Documents are never shuffled.

Defined results: a null or wordless text has no words and no hits; a null or wordless item has no window;
repeated item rows count once per ``item_id``; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import hashing as H

_WORD = H.letters_only()
_SLOTS = 20  # bits of the first, coarse lookup


def _item_windows(window: int, shingle: int):
    """Batches of items to rows (item_id, text of the window, hash, words, shingle length, shingle hashes)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for texts in H.slices(batch.column(1)):
                w = H.words(texts, _WORD)
                raw = H.LOWER[texts.data]
                for d in range(len(texts.bounds) - 1):
                    a, b = int(w.bounds[d]), int(w.bounds[d + 1])
                    m = min(window, b - a)
                    if not m:
                        continue
                    k = min(shingle, m)
                    whole, parts = H.runs(w.value[a:b], m), H.runs(w.value[a:b], k)
                    for i in range(b - a - m + 1):
                        text = b" ".join(raw[s:e].tobytes() for s, e in zip(w.start[a + i : a + i + m], w.end[a + i : a + i + m]))
                        out.append((ids[texts.first + d], text, int(whole[i].view(np.int64)), m, k, parts[i : i + m - k + 1].view(np.int64).tolist()))
            names = ["item_id", "window", "hash", "n", "k", "shingles"]
            kinds = [pa.string(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return rows


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """One row per distinct window with the ids of all items that hold it."""
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).where(F.col(item_col).isNotNull())
    schema = "item_id string, window binary, hash bigint, n int, k int, shingles array<bigint>"
    return (
        rows.mapInArrow(_item_windows(window, shingle), schema)
        .groupBy("window", "hash", "n", "k", "shingles")
        .agg(F.collect_set("item_id").alias("items"))
    )


class _Lookup:
    """A sorted set of hashes with a coarse bitmap before it."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.coarse = np.zeros(1 << _SLOTS, dtype=bool)
        self.coarse[(values >> H.U(64 - _SLOTS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that hold one of the values, and which one."""
        at = np.flatnonzero(self.coarse[(hashes >> H.U(64 - _SLOTS)).astype(np.int64)])
        if not len(at) or not len(self.values):
            return at[:0], at[:0]
        spot = np.minimum(np.searchsorted(self.values, hashes[at]), len(self.values) - 1)
        hit = self.values[spot] == hashes[at]
        return at[hit], spot[hit]


def _count_shingles(lengths: dict[int, np.ndarray]):
    """Count how often each wanted shingle occurs; one row per shingle and task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {k: _Lookup(v) for k, v in lengths.items()}
        counts = {k: np.zeros(len(v), np.int64) for k, v in lengths.items()}
        for batch in batches:
            for texts in H.slices(batch.column(0)):
                w = H.words(texts, _WORD)
                for k, lookup in lookups.items():
                    value = H.runs(w.value, k)
                    at, which = lookup.find(value)
                    if len(at):
                        ok = H.in_one_document(w.bounds, len(value), k)[at]
                        counts[k] += np.bincount(which[ok], minlength=len(lookup.values))
        for k, found in counts.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(lengths[k][at].view(np.int64)), pa.array(found[at])], names=["k", "shingle", "n"]
            )

    return rows


def _prefix_index(block: list, counts: dict[tuple[int, int], int]) -> dict[int, tuple]:
    """For each shingle length: the prefix shingles, and by them the windows and the place of the shingle in each."""
    entries: dict[int, list[tuple[int, int, int]]] = {}
    for w, row in enumerate(block):
        order = [(counts.get((row.k, s), 0), s, i) for i, s in enumerate(row.shingles)]
        frequency, value, place = min(order)
        if frequency:  # a shingle that no document holds rules the window out
            entries.setdefault(row.k, []).append((value & ((1 << 64) - 1), w, place))
    index = {}
    for k, found in entries.items():
        found.sort()
        value = np.array([f[0] for f in found], dtype=np.uint64)
        keys, first = np.unique(value, return_index=True)
        index[k] = (keys, np.append(first, len(value)), np.array([f[1] for f in found], np.int64), np.array([f[2] for f in found], np.int64))
    return index


def _match(block):
    """Add the hit word spans and the items found for one block of windows to what earlier blocks found."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, items, sizes, hashes, index = block.value
        lookups = {k: _Lookup(v[0]) for k, v in index.items()}
        for batch in batches:
            n = batch.num_rows
            n_words = np.zeros(n, np.int64)
            spans = [{(s["first"], s["last"]) for s in x or ()} for x in batch.column("spans").to_pylist()]
            found = [set(x or []) for x in batch.column("items").to_pylist()]
            for texts in H.slices(batch.column("text")):
                w = H.words(texts, _WORD)
                here = np.diff(w.bounds)
                n_words[texts.first : texts.first + len(here)] = here
                doc_of = None
                for k, (_, first, window_of, place_of) in index.items():
                    at, which = lookups[k].find(H.runs(w.value, k))
                    if not len(at):
                        continue
                    doc_of = H.owner(w.bounds) if doc_of is None else doc_of
                    many = first[which + 1] - first[which]
                    at = np.repeat(at, many)
                    entry = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[which], many)
                    window, start = window_of[entry], at - place_of[entry]
                    doc = doc_of[at]
                    ok = (start >= w.bounds[doc]) & (start + sizes[window] <= w.bounds[doc + 1])
                    window, start, doc = window[ok], start[ok], doc[ok]
                    for m in np.unique(sizes[window]):
                        same = np.flatnonzero(sizes[window] == m)
                        value = w.value[start[same]].copy()
                        for i in range(1, m):
                            value *= H._STEP
                            value += w.value[start[same] + i]
                        same = same[H.mixed(value) == hashes[window[same]]]
                        raw = H.LOWER[texts.data] if len(same) else None
                        for d, s, x in zip(doc[same].tolist(), start[same].tolist(), window[same].tolist()):
                            words = b" ".join(raw[a:b].tobytes() for a, b in zip(w.start[s : s + m], w.end[s : s + m]))
                            if words == windows[x]:
                                own = s - int(w.bounds[d])
                                spans[texts.first + d].add((own, own + int(m)))
                                found[texts.first + d].update(items[x])
            merged = [_merged(x) for x in spans]
            out = {
                "id": batch.column("id"),
                "text": batch.column("text"),
                "n_words": pa.array(n_words),
                "spans": pa.array([[{"first": a, "last": b} for a, b in x] for x in merged], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                "items": pa.array([sorted(x) for x in found], pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return rows


def _merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(
    spark: SparkSession,
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    shingle: int = 4,
    block_windows: int = 200_000,
) -> DataFrame:
    """Per document row: ``id, n_words, spans`` (merged runs of hit words, ``first`` to before ``last``), ``items``.

    ``block_windows`` bounds the windows held at once by the driver and by each task.
    """
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    distinct = benchmark_windows(benchmark, item_col, item_text_col, window, shingle)
    blocks = max(1, -(-distinct.count() // block_windows))
    parts = distinct.withColumn("block", F.pmod(F.col("hash"), F.lit(blocks)))
    spans = "array<struct<first:bigint,last:bigint>>"
    result = source.select("id", "text", F.lit(0).cast("bigint").alias("n_words"), F.lit(None).cast(spans).alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    schema = result.schema
    for b in range(blocks):
        block = sorted(parts.where(F.col("block") == b).drop("block").collect(), key=lambda r: (r.hash, bytes(r.window)))
        wanted: dict[int, set[int]] = {}
        for row in block:
            wanted.setdefault(row.k, set()).update(row.shingles)
        lengths = {k: np.sort(np.fromiter(v, np.int64, len(v)).view(np.uint64)) for k, v in wanted.items()}
        tallies = source.select("text").mapInArrow(_count_shingles(lengths), "k int, shingle bigint, n bigint")
        counts = {(r.k, r.shingle): r.n for r in tallies.groupBy("k", "shingle").agg(F.sum("n").alias("n")).collect()}
        index = _prefix_index(block, counts)
        held = spark.sparkContext.broadcast((
            [bytes(r.window) for r in block],
            [list(r["items"]) for r in block],
            np.array([r.n for r in block], np.int64),
            np.array([r.hash for r in block], np.int64).view(np.uint64),
            index,
        ))
        result = result.mapInArrow(_match(held), schema)
    return result.drop("text")


def decontaminate(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_share: float = 0.0, **options) -> DataFrame:
    """The documents of which no more than ``most_share`` of the words are hit; all columns as they were.

    Rows that share an id share its verdict. A null id is kept: it cannot be named in a verdict.
    """
    found = contamination(spark, documents, benchmark, id_col, text_col, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda t, s: t + s["last"] - s["first"])
    bad = found.where(n_hit > most_share * F.col("n_words")).select(F.col("id").alias("__bad")).distinct()
    return documents.join(bad, documents[id_col] == F.col("__bad"), "left_anti").select(*[documents[c] for c in documents.columns])
