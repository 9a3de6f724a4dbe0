"""Exact substring deduplication over whole texts: every byte that a repeated string of ``least`` bytes covers.

A sparse enhanced suffix array decides. Its suffixes start at anchors: content-defined places of which every string
of ``least`` bytes holds one, at the same offset in each copy. Anchors whose ``SEED`` bytes occur once are out.
An anchor reaches ``least - SEED`` bytes to either side; occurrences with one and the same reach are a class. A
class of two or more is repeated all over and needs no closer look. In groups of equal seeds that hold a class of
one, the classes are sorted by the suffix at the anchor; common prefixes of neighbours give, by a scan with a stack,
the tree of common-prefix intervals. Each interval is a right-maximal repeat with all its occurrences; its left
extensions are then compared: if they are not diverse it extends to the full reach, else each occurrence extends as
far left as any other member of the interval agrees. Prefix and extension together are a repeat if they make up
``least`` bytes.

Shuffled are anchors (one in about sixty bytes), reaches of one occurrence per class in groups that need them, and
the texts (twice). Strings that a buffer sees twice go out once, with their count. A group of more classes than
``group_rows`` is not gathered: its windows of ``least`` bytes are counted by hash, which splits over all tasks.

Defined results: a null text is empty; a document shorter than ``least`` loses nothing; repeats inside one document
and overlapping ones count; equal rows are each other's repeats; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import anchors as A
from quayside.llm import hashing as H
from quayside.llm.components import dropped, stored

SEED = 64


def _found(reach: int):
    """Rows ``id, h, size, pos, a, c, n``: anchors with the hashes of seed and reach; without a: a covered span (pos, n its end)."""
    window = reach + 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = np.asarray(batch.column("id").fill_null(-1)), np.asarray(batch.column("h"))
            for texts in H.slices(batch.column("text")):
                total = A.running(texts.data)
                place, seed = A.anchors(texts, total, SEED, window)
                if not len(place):
                    continue
                doc = np.searchsorted(texts.bounds, place, side="right") - 1
                begin, size = texts.bounds[doc], np.diff(texts.bounds)[doc]
                left, right = np.maximum(place - reach, begin), np.minimum(place + SEED + reach, begin + size)
                context = A.substring_hashes(total, left, right) ^ H.mixed((place - left).astype(np.uint64))
                order = np.argsort(context, kind="stable")
                s, c = seed[order], context[order]
                fresh = np.append(True, (c[1:] != c[:-1]) | (s[1:] != s[:-1]))
                group = np.cumsum(fresh) - 1
                many = np.bincount(group)
                once = order[fresh]
                several = order[many[group] > 1]
                several = several[right[several] - left[several] >= SEED + reach]
                docs = np.concatenate([doc[once], doc[several]])
                own = slice(texts.first, texts.first + len(texts.bounds) - 1)
                pos = np.concatenate([place[once] - begin[once], left[several] - begin[several]])
                n = np.concatenate([many, right[several] - begin[several]])
                blank = np.arange(len(docs)) >= len(once)
                zero = np.zeros(len(several), np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[own][docs]), pa.array(hashes[own][docs]), pa.array(np.diff(texts.bounds)[docs]), pa.array(pos),
                        pa.array(np.concatenate([seed[once], zero]).view(np.int64), mask=blank),
                        pa.array(np.concatenate([context[once], zero]).view(np.int64), mask=blank), pa.array(n),
                    ],
                    names=["id", "h", "size", "pos", "a", "c", "n"],
                )

    return rows


def _reaches(reach: int):
    """Rows ``a, n, h, size, pos, left, right``: what stands before an anchor, read backwards, and from it on."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            hashes, sizes = batch.column("h").to_pylist(), batch.column("size").to_pylist()
            for i, wanted in enumerate(batch.column("wanted").to_pylist()):
                data = (batch.column("text")[i].as_py() or "").encode()
                for w in wanted:
                    p = w["pos"]
                    out.append((w["a"], w["n"], hashes[i], sizes[i], p, data[max(0, p - reach) : p][::-1], data[p : p + SEED + reach]))
                if len(out) > 20_000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    return rows


_REACH = [("a", pa.int64()), ("n", pa.int64()), ("h", pa.int64()), ("size", pa.int64()), ("pos", pa.int64()), ("left", pa.binary()), ("right", pa.binary())]
_REACH_SQL = "a bigint, n bigint, h bigint, size bigint, pos bigint, left binary, right binary"
_SPAN_SQL = "h bigint, size bigint, first bigint, last bigint"


def _batch(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), _REACH)], names=[n for n, _ in _REACH])


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = H.buffers(column)
    size = np.diff(bounds)
    out = np.zeros((len(size), width), np.uint8)
    inside = np.arange(width)[None, :] < size[:, None]
    out[inside] = data
    return out, size


def _common(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows, ``most`` at the most."""
    differ = x != y
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
    return np.minimum(first, most)


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (first row, last row, length) of a sorted list; lcp[i] ties row i to row i - 1."""
    stack: list[tuple[int, int]] = []  # (length, first row)
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else 0
        first = i - 1
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            if length >= least:
                yield first, i - 1, length
        if now and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def repeats_of(group: np.ndarray, left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bytes before the anchor, bytes from it on, of each occurrence of a repeat; rows sorted by group and suffix."""
    if len(group) < 2:
        return (np.zeros(0, np.int64),) * 3
    same = group[1:] == group[:-1]
    lcp = np.append(0, np.where(same, _common(right[1:], right[:-1], np.minimum(n_right[1:], n_right[:-1])), 0))
    back = np.append(0, np.where(same, _common(left[1:], left[:-1], np.minimum(n_left[1:], n_left[:-1])), 0))
    reach = left.shape[1]
    row, before, after = [], [], []
    for i, j, length in intervals(lcp.tolist(), SEED):
        if j == i + 1:
            if back[j] + length >= least:
                row += [i, j]
                before += [back[j]] * 2
                after += [length] * 2
            continue
        if (back[i + 1 : j + 1] == reach).all():  # left extensions are not diverse: all of the reach
            extent = np.full(j - i + 1, reach)
            at = np.arange(i, j + 1)
        else:
            own = left[i : j + 1]
            order = np.lexsort(own.T[::-1])
            at = order + i
            near = _common(left[at[1:]], left[at[:-1]], np.minimum(n_left[at[1:]], n_left[at[:-1]]))
            extent = np.maximum(np.append(near, 0), np.append(0, near))
        ok = extent + length >= least
        row += at[ok].tolist()
        before += extent[ok].tolist()
        after += [length] * int(ok.sum())
    return np.array(row, np.int64), np.array(before, np.int64), np.array(after, np.int64)


def _grouped(reach: int):
    """Spans of repeats from rows that come sorted by group and suffix."""

    def spans(table: pa.Table) -> pa.RecordBatch:
        left, n_left = _matrix(table.column("left").combine_chunks(), reach)
        right, n_right = _matrix(table.column("right").combine_chunks(), SEED + reach)
        row, before, after = repeats_of(np.asarray(table.column("a")), left, n_left, right, n_right, SEED + reach)
        pos = np.asarray(table.column("pos"))[row]
        # the widest span of a row holds the others only in part; all go on
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(table.column("h"))[row]), pa.array(np.asarray(table.column("size"))[row]), pa.array(pos - before), pa.array(pos + after)], names=["h", "size", "first", "last"]
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < 20_000:
                continue
            table = pa.Table.from_batches(held)
            group = np.asarray(table.column("a"))
            cut = int(np.flatnonzero(group != group[-1])[-1]) + 1 if group[0] != group[-1] else 0
            if cut:
                yield spans(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield spans(pa.Table.from_batches(held))

    return rows


def _windows(reach: int):
    """Every window of the full length around an anchor: ``a, offset, w`` (its hash), and whose it is."""
    width = SEED + reach

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                left, n_left = _matrix(batch.column("left"), reach)
                right, n_right = _matrix(batch.column("right"), width)
                around = np.concatenate([left[:, ::-1], right], axis=1)
                up, down = H.powers(around.shape[1] + 1)
                total = np.zeros((len(around), around.shape[1] + 1), np.uint64)
                np.cumsum(H.BYTE_VALUES[around] * up[: around.shape[1]], axis=1, out=total[:, 1:])
                offset = np.arange(reach + 1)  # bytes before the anchor
                start = reach - offset
                value = H.mixed((total[:, start + width] - total[:, start]) * down[start])
                ok = (offset[None, :] <= n_left[:, None]) & (width - offset[None, :] <= n_right[:, None])
                i, o = np.nonzero(ok)
                take = lambda c: pa.array(np.asarray(batch.column(c))[i])  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([take("a"), pa.array(o), pa.array(value[i, o].view(np.int64)), take("n"), take("h"), take("size"), take("pos")], names=["a", "o", "w", "n", "h", "size", "pos"])

    return rows


def repeated_spans(spark: SparkSession, texts: DataFrame, least: int = 200, group_rows: int = 20_000) -> DataFrame:
    """For ``texts`` (id, text, h, size): ``h, size`` and ``spans`` (first, last; they may overlap) of every text with a repeat."""
    reach = least - SEED
    found = stored(spark, texts.mapInArrow(_found(reach), "id bigint, h bigint, size bigint, pos bigint, a bigint, c bigint, n bigint"), "anchors")
    each = found.where("a is not null")
    local = found.where("a is null").select("h", "size", F.col("pos").alias("first"), F.col("n").alias("last"))
    twice = each.groupBy("a").agg(F.sum("n").alias("total")).where("total > 1").select("a")
    repeated = stored(spark, each.join(twice, "a"), "repeated")
    classes = repeated.groupBy("a", "c").agg(F.sum("n").alias("n"), F.min(F.struct("id", "h", "size", "pos")).alias("one"))
    classes = stored(spark, classes, "classes")
    whole = repeated.join(classes.where("n > 1").select("a", "c"), ["a", "c"], "left_semi")
    whole = whole.select("h", "size", F.greatest(F.col("pos") - reach, F.lit(0)).alias("first"), F.least(F.col("pos") + least, F.col("size")).alias("last"))
    whole = whole.where(F.col("last") - F.col("first") >= least)
    groups = classes.groupBy("a").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("fewest")).where("m > 1 and fewest = 1").select("a", "m")
    looked = classes.join(groups, "a").select("a", "m", "n", "one.*")
    wanted = looked.groupBy("id", "h", "size").agg(F.collect_list(F.struct("a", "n", "pos")).alias("wanted"))
    around = texts.select(F.coalesce("id", F.lit(-1)).alias("id"), "h", "size", "text").join(wanted, ["id", "h", "size"])
    around = stored(spark, around.select("h", "size", "text", "wanted").mapInArrow(_reaches(reach), _REACH_SQL), "reaches")
    hot = stored(spark, groups.where(F.col("m") > group_rows).select("a"), "hot-groups")
    usual = around.join(hot, "a", "left_anti").repartition("a").sortWithinPartitions("a", "right")
    tree = usual.mapInArrow(_grouped(reach), _SPAN_SQL)
    windows = around.join(hot, "a", "left_semi").mapInArrow(_windows(reach), "a bigint, o bigint, w bigint, n bigint, h bigint, size bigint, pos bigint")
    again = windows.groupBy("a", "o", "w").agg(F.sum("n").alias("total")).where("total > 1").select("a", "o", "w")
    counted = windows.join(again, ["a", "o", "w"]).select("h", "size", (F.col("pos") - F.col("o")).alias("first"), (F.col("pos") - F.col("o") + least).alias("last"))
    spans = local.unionAll(whole).unionAll(tree).unionAll(counted)
    done = stored(spark, spans.groupBy("h", "size").agg(F.collect_set(F.struct("first", "last")).alias("spans")), "spans")
    dropped(spark, found, repeated, classes, around, hot)
    return done


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _cut():
    """Merge the spans of each text and keep the bytes outside them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans").cast(_SPANS)
            ends = np.asarray(spans.value_lengths().fill_null(0)).cumsum()
            flat = spans.flatten()
            first, last = np.asarray(flat.field("first")), np.asarray(flat.field("last"))
            for texts in H.slices(batch.column("text")):
                n = len(texts.bounds) - 1
                own = np.append(ends[texts.first - 1] if texts.first else 0, ends[texts.first : texts.first + n])
                doc = np.repeat(np.arange(n), np.diff(own))
                # one line for all texts, a gap between them
                shift = texts.bounds[:-1] + np.arange(n)
                a, b = first[own[0] : own[-1]] + shift[doc], last[own[0] : own[-1]] + shift[doc]
                order = np.argsort(a, kind="stable")
                a, reach, doc = a[order], np.maximum.accumulate(b[order]), doc[order]
                fresh = np.append(True, a[1:] > reach[:-1]) if len(a) else np.zeros(0, bool)
                begin, doc = a[fresh] - shift[doc[fresh]], doc[fresh]
                end = reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(a) - 1)] - shift[doc] if len(a) else begin
                removed = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], ["first", "last"])
                per_doc = pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
                step = np.zeros(len(texts.data) + 1, np.int32)
                np.add.at(step, texts.bounds[doc] + begin, 1)
                np.add.at(step, texts.bounds[doc] + end, -1)
                keep = np.cumsum(step[:-1]) == 0
                kept = np.append(0, np.cumsum(keep))[texts.bounds]
                data = pa.py_buffer(texts.data[keep].tobytes())
                part = batch.slice(texts.first, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("size"), pa.ListArray.from_arrays(per_doc, removed),
                        pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(kept.astype(np.int64).tobytes()), data]).cast(pa.binary()),
                    ],
                    names=["id", "n_bytes", "removed", "kept"],
                )

    return rows


def deduplicate(spark: SparkSession, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 200, group_rows: int = 20_000) -> DataFrame:
    """Per document row: ``id, n_bytes, removed`` (merged byte runs), ``kept`` (the other bytes, which may part a character)."""
    if least <= SEED:
        raise ValueError(f"strings of more than {SEED} bytes only")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = documents.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"), F.octet_length(text).cast("bigint").alias("size"))
    spans = repeated_spans(spark, texts, least, group_rows)
    return texts.join(spans, ["h", "size"], "left").select("id", "text", "size", "spans").mapInArrow(
        _cut(), "id bigint, n_bytes bigint, removed array<struct<first:bigint,last:bigint>>, kept binary"
    )
