"""Prefix tree of conversations: how many share each beginning, and what sharing it saves.

A turn is its digest and its number of words; texts do not move. Each conversation's rows are put in order, and a running
digest names each prefix of it. A prefix that only one conversation has needs no grouping, and a count-min sketch
finds most of them: each task counts its prefix digests in rows of saturating counters, the counters are added, and where
one of a digest's counters says one, the prefix is that conversation's alone, for certain. Its node is written where its
row lies. Only prefixes that may be shared are shuffled, to be counted exactly; the sketch errs to that side only, so a
small one costs time and not rows.

Sums over subtrees need no walk over depths. A node is carried by its smallest member; what it adds (a leaf, saved
tokens) is put on that conversation's row, summed from the conversation's end to its beginning by a window, and each node
then adds up its members' rows.

What moves: 40 bytes a turn by conversation; of possibly shared prefixes their digests, twice; ids of conversations that
end in such a prefix, in pieces of 4,096 ids. The driver merges nothing but holds the sketch, at most
``hashes * most_cells`` bits. A hot prefix (the root, a common greeting) meets in partial sums. One conversation's
turns are read by one task, in a stream; so are the ids of one node's ends, as their hash needs them in order.

Rules. Rows without a conversation id belong to none and are left out. Null role or text is empty. Turns are in the
order of ``turn``, null first; turns of one number by role, then by the digest of role and text. Repeated rows are turns of
their own. No conversations give no nodes. Other columns are not read, so they may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm import hashing as H
from quayside.llm.components import dropped, stored

#: Ids of one piece of a node's ends are equal but for so many low bits.
_END_BITS = 12
#: Counters of one sketch block; a block is merged by one group.
_BLOCK = 1 << 16


def turns(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, place, t1, t2, words``: each conversation's turns numbered from 1, as digests."""
    rows = conversations.select(
        F.col(id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).where("conv_id is not null")
    # each column's hash is the seed of the next one's, so where role ends and text begins counts
    small = rows.select(
        "conv_id", "turn", "role", F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(1), "role", "text").alias("t2"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "t1", "t2")
    return small.select("conv_id", F.row_number().over(order).alias("place"), "t1", "t2", "words")


def grafted(spark: SparkSession, turns: DataFrame, onto: Column, first: Column, most: int) -> DataFrame:
    """Conversations rebuilt: the first ``first`` turns of conversation ``onto``, then the own ones after the first ``first``.

    ``onto`` and ``first`` are over ``conv_id``; ``first`` is ``most`` at most. A missing ``onto`` gives no turns. Each
    conversation has a row of place 0, so one without turns is not lost.
    """
    numbered = stored(spark, turns, "turns")
    ids = numbered.where("place = 1").select("conv_id", onto.alias("onto"), first.cast("int").alias("first"))
    heads = numbered.where(F.col("place") <= most).withColumnRenamed("conv_id", "onto")
    taken = ids.join(heads, "onto").where("place <= first").select("conv_id", "place", "t1", "t2", "words")
    own = numbered.where(F.col("place") > first)
    none = F.lit(0).cast("bigint")
    roots = ids.select("conv_id", F.lit(0).alias("place"), none.alias("t1"), none.alias("t2"), none.alias("words"))
    return own.unionByName(taken).unionByName(roots)


PREFIX = "conv_id bigint, depth int, d1 bigint, d2 bigint, p1 bigint, p2 bigint, words bigint, last boolean"


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of conversation and place to prefixes: running digests of two lanes, and those of the row before.

    A prefix's digest is the sum of its turns' digests times powers of one odd base, so one running sum over a batch
    gives all of them; the last row of a batch waits for the next one, which tells whether its conversation goes on.
    """
    held, conv, depth = None, None, -1
    sums, parent = [np.uint64(0)] * 2, [np.uint64(0)] * 2
    names = [f.strip().split(" ")[0] for f in PREFIX.split(",")]

    def out(rows: list[np.ndarray], last: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(rows[0]), pa.array(rows[1].astype(np.int32)), *[pa.array(x.view(np.int64)) for x in rows[2:6]], pa.array(rows[6]), pa.array(last)]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        ids = batch.column("conv_id").to_numpy()
        start = np.flatnonzero(np.concatenate([[conv is None or ids[0] != conv], ids[1:] != ids[:-1]]))
        fresh = len(start) > 0 and start[0] == 0
        opened = start if fresh else np.concatenate([[0], start])
        segment = np.repeat(np.arange(len(opened)), np.diff(np.concatenate([opened, [n]])))
        at = np.arange(n) - opened[segment]
        if not fresh:
            at[segment == 0] += depth + 1
        up, _ = H.powers(int(at.max()) + 1)
        digests, parents = [], []
        for lane, name in enumerate(("t1", "t2")):
            value = H.mixed(batch.column(name).to_numpy().view(np.uint64) + H.U(lane + 1)) * up[at]
            value[at == 0] = 0  # the root has no text
            total = np.cumsum(value)
            before = np.concatenate([[H.U(0)], total[:-1]])[opened]
            if not fresh:
                before[0] -= sums[lane]
            run = total - before[segment]
            digest = H.mixed(run + at.astype(np.uint64) * H.U(0x9E3779B97F4A7C15))
            up_one = np.concatenate([[parent[lane]], digest[:-1]])
            up_one[at == 0] = 0
            digests.append(digest)
            parents.append(up_one)
            sums[lane], parent[lane] = run[-1], digest[-1]
        rows = [ids, at, *digests, *parents, batch.column("words").to_numpy()]
        if held is not None:
            rows = [np.concatenate([h, r]) for h, r in zip(held, rows)]
        conv, depth = ids[-1], int(at[-1])
        if len(rows[0]) > 1:
            yield out([r[:-1] for r in rows], rows[0][1:] != rows[0][:-1])
        held = [r[-1:] for r in rows]
    if held is not None:
        yield out(held, np.array([True]))


def prefixes(rows: DataFrame) -> DataFrame:
    """``conv_id, depth, d1, d2, p1, p2, words, last`` of rows as ``grafted`` gives them."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "t1", "t2", "words").mapInArrow(_chained, PREFIX)


def _cells(d1: np.ndarray, d2: np.ndarray, row: int, cells: int) -> np.ndarray:
    """The counter of each digest in one row of the sketch."""
    return (H.mixed(d1 ^ H.mixed(d2 + H.U(row + 1))) & H.U(cells - 1)).astype(np.int64)


def sketch(spark: SparkSession, found: DataFrame, hashes: int = 3, cells_each: int = 8, most_cells: int = 1 << 26, workers: int = 64) -> np.ndarray:
    """Count-min sketch of the digests ``d1, d2``, one array of bits for each row: whether a counter is above one.

    Counters stop at two, as nothing beyond matters, and so are two bits. Their number follows the digests', up to
    ``most_cells`` a row; ``workers`` bounds how many partial sketches are made and added.
    """
    n = found.count()
    cells = 1 << max(10, min(most_cells, cells_each * n).bit_length() - 1)
    block = min(_BLOCK, cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros((hashes, cells), np.uint8)
        for batch in batches:
            d1, d2 = (batch.column(c).to_numpy().view(np.uint64) for c in ("d1", "d2"))
            for row in range(hashes):
                cell, times = np.unique(_cells(d1, d2, row, cells), return_counts=True)
                counters[row, cell] = np.minimum(counters[row, cell] + np.minimum(times, 2), 2)
        for row in range(hashes):
            for at in range(0, cells, block):
                own = counters[row, at : at + block]
                if own.any():
                    bits = [pa.array([np.packbits(own == k).tobytes()], pa.binary()) for k in (1, 2)]
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([at], pa.int64()), *bits], ["row", "at", "once", "more"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, more = np.zeros(block // 8, np.uint8), np.zeros(block // 8, np.uint8)
        for batch in batches:
            for a, b in zip(batch.column("once"), batch.column("more")):
                one = np.frombuffer(a.as_py(), np.uint8)
                more |= np.frombuffer(b.as_py(), np.uint8) | (once & one)
                once |= one
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([more.tobytes()], pa.binary())], ["row", "at", "more"])

    partial = found.select("d1", "d2").coalesce(workers).mapInArrow(count, "row int, at long, once binary, more binary")
    merged = partial.groupBy("row", "at").applyInArrow(add, "row int, at long, more binary")
    out = np.zeros((hashes, cells // 8), np.uint8)
    for r in merged.toLocalIterator():  # hashes * cells bits in all
        out[r["row"], r["at"] // 8 : (r["at"] + block) // 8] = np.frombuffer(r["more"], np.uint8)
    return out


def _screened(spark: SparkSession, found: DataFrame, seen: np.ndarray) -> DataFrame:
    """The prefixes with ``alone`` and ``alone_above``: whether the sketch's estimate is one, of the prefix and of its parent."""
    shared = spark.sparkContext.broadcast(seen)
    cells = seen.shape[1] * 8

    def one(bits: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        alone = np.zeros(len(d1), bool)
        for row in range(len(bits)):
            cell = _cells(d1, d2, row, cells)
            alone |= (bits[row, cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 0
        return alone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            lane = {c: batch.column(c).to_numpy().view(np.uint64) for c in ("d1", "d2", "p1", "p2")}
            above = one(bits, lane["p1"], lane["p2"]) & (batch.column("depth").to_numpy() > 0)
            flags = [pa.array(one(bits, lane["d1"], lane["d2"])), pa.array(above)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], [*batch.schema.names, "alone", "alone_above"])

    return found.mapInArrow(run, PREFIX + ", alone boolean, alone_above boolean")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """``d1, d2, sha`` of ``d1, d2, conv_id``: the hash of each group's ids in order, joined by commas.

    Ids of a group go in pieces of like high bits, each with its ids joined; one stream reads a group's pieces in order.
    """
    piece = F.shiftright("conv_id", _END_BITS).alias("piece")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    pieces = ends.groupBy("d1", "d2", piece).agg(joined.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state, done = None, None, []
        for batch in batches:
            for d1, d2, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids"))):
                if group == (d1, d2):
                    state.update(b",")
                else:
                    if group is not None:
                        done.append((*group, state.hexdigest()))
                    group, state = (d1, d2), hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield told(done)
                done = []
        if group is not None:
            yield told([(*group, state.hexdigest())])

    def told(rows: list[tuple]) -> pa.RecordBatch:
        a, b, c = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c)], ["d1", "d2", "sha"])

    ordered = pieces.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "piece")
    return ordered.select("d1", "d2", "ids").mapInArrow(run, "d1 long, d2 long, sha string")


def prefix_trie(spark: SparkSession, rows: DataFrame, **screen) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``rows`` are as ``grafted`` gives them; ``screen`` goes to ``sketch``.
    """
    found = stored(spark, prefixes(rows), "prefixes")
    checked = stored(spark, _screened(spark, found, sketch(spark, found, **screen)), "screened")
    dropped(spark, found)
    alone, open_ = checked.where("alone"), checked.where("not alone")
    root = checked.where("depth = 0").agg(F.min("conv_id")).first()[0]

    nodes = open_.groupBy("d1", "d2").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.bool_and("last").alias("childless"), F.bool_or("alone_above").alias("alone_above"),
    )
    nodes = stored(spark, nodes, "nodes")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    # what nodes add, on the row of their smallest member; a conversation that ends alone is a leaf of all above it
    adds = nodes.select("conv_id", "depth", none.alias("d1"), none.alias("d2"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.col("childless").cast("bigint").alias("leaf"))
    tails = alone.where("last").select("conv_id", "depth", none.alias("d1"), none.alias("d2"), zero.alias("saved"), F.lit(1).cast("bigint").alias("leaf"))
    paths = open_.select("conv_id", "depth", "d1", "d2", zero.alias("saved"), zero.alias("leaf"))
    below = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = adds.where("saved > 0 or leaf > 0").unionByName(tails).unionByName(paths)
    summed = summed.select("d1", "d2", F.sum("saved").over(below).alias("saved"), F.sum("leaf").over(below).alias("leaves")).where("d1 is not null")
    # children of possibly shared nodes: other such nodes, and first rows of tails
    edges = nodes.where("depth > 0 and not alone_above").select("p1", "p2").unionByName(alone.where("depth > 0 and not alone_above").select("p1", "p2"))
    told = summed.select("d1", "d2", "saved", "leaves", zero.alias("children")).unionByName(
        edges.select(F.col("p1").alias("d1"), F.col("p2").alias("d2"), zero.alias("saved"), zero.alias("leaves"), F.lit(1).cast("bigint").alias("children"))
    )
    told = told.groupBy("d1", "d2").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"), F.sum("children").alias("n_children"))
    ends = _end_hashes(open_.where("last").select("d1", "d2", "conv_id"))
    shared = nodes.join(told, ["d1", "d2"], "left").join(ends, ["d1", "d2"], "left").select(
        "conv_id", "depth", "p1", "p2", "alone_above", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    )
    single = alone.select(
        "conv_id", "depth", "p1", "p2", "alone_above", F.lit(1).cast("bigint").alias("n_convs"), F.when(F.col("last"), 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"), zero.alias("saved_tokens"), F.sha2(F.when(F.col("last"), F.col("conv_id").cast("string")).otherwise(""), 256).alias("ends_sha256"),
    )
    # a parent that is alone has the same conversation, the root is known; the others are looked up
    above = F.when(F.col("alone_above"), F.col("conv_id")).when(F.col("depth") == 1, F.lit(root).cast("bigint"))
    every = shared.unionByName(single)
    known = every.where("depth < 2 or alone_above").withColumn("parent_conv_id", above)
    names = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    asked = every.where("depth >= 2 and not alone_above").join(names, ["p1", "p2"], "left")
    columns = ["conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return known.select(*columns).unionByName(asked.select(*columns))
