"""Near-duplicate documents by the Jaccard similarity of word shingles, filtered under several token orders.

A document is the set of its distinct shingles; documents with equal sets are one set from the start. Sets x and y
are similar when |x & y| >= t |x | y|, which needs |x & y| >= t |x|. So under any order of all shingles the first
|x| - ceil(t |x|) + 1 of both (their prefixes) must share one, and this for every order at once.

Rarest first is the order that decides most. Its head, the shingles that only one set holds, is found by one
shuffle of packed hashes: a set of which more than the prefix is unshared has no partner and leaves here (most
do). The remaining sets' shingles are counted among themselves, and prefixes are taken under three orders: two by
rarity with ties broken by different hashes, one by hash alone; candidates share prefix shingles in all three.

Links are wanted up to reachability, so a group that shares a prefix shingle is not paired off: its most
typical set is compared with all others first; what is then in one component needs no further comparison, and
this is repeated with what is left over; only sets that remain apart are compared with each other, all of them.
Lengths and the places of the shared shingle bound what two sets can share, before any pair is made. Candidates are
counted out exactly.

Defined results: a null text, an empty one and one without words have no shingles and link with nothing; fewer
words than a shingle are one shingle; a null id takes part and has the component of its text; repeated rows are
copies of each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import hashing as H
from quayside.llm.components import components, stored

_WORD = H.unspaced()
_TOKEN_BITS = 48
#: Tokens that a task gathers before it sends them on.
_BUFFER = 400_000
ORDERS = 3
#: Shingles of one range of hashes, about: what a task holds when it looks for those that two sets share.
_RANGE = 1_000_000
#: Shingles a task goes through, a range at a time.
_TASK = 8_000_000
#: Rows of an Arrow batch: a row is a whole text or a pack of shingles, and a batch is held on both sides.
_BATCH_ROWS = 256
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _small_batches(spark: SparkSession):
    """Batches of few rows for what is written inside; the session's own setting comes back after it."""
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, min(_BATCH_ROWS, int(before)) if int(before) > 0 else _BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def _given_back() -> None:
    """Memory that is free in this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def _leaving_nothing(rows: Callable) -> Callable:
    """A task's worker lives on beside those of other stages: what it took is given back at the end of each task."""

    @wraps(rows)
    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            _given_back()

    return ended


def shingle_sets(texts: H.Texts, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a slice's documents as 48-bit hashes, document by document, and their bounds."""
    w = H.words(texts, _WORD)
    n_docs = len(texts.bounds) - 1
    value = H.runs(w.value, length)
    at = np.flatnonzero(H.in_one_document(w.bounds, len(value), length))
    doc = H.owner(w.bounds)[at]
    token = value[at]
    count = np.diff(w.bounds)
    for d in np.flatnonzero((count > 0) & (count < length)).tolist():
        own = H.runs(w.value[w.bounds[d] : w.bounds[d + 1]], int(count[d]))
        doc, token = np.append(doc, d), np.append(token, H.mixed(own + H.U(count[d])))
    key = np.sort((doc.astype(np.uint64) << H.U(_TOKEN_BITS)) | (token >> H.U(64 - _TOKEN_BITS)))
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    doc = (key >> H.U(_TOKEN_BITS)).astype(np.int64)
    return key & H.U((1 << _TOKEN_BITS) - 1), np.searchsorted(doc, np.arange(n_docs + 1))


def signatures(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit value per set; 0 for the empty one."""
    total = np.append(H.U(0), np.cumsum(H.mixed(tokens + H.U(0x5851F42D4C957F2D))))
    value = H.mixed(total[bounds[1:]] - total[bounds[:-1]])
    return np.where(np.diff(bounds) > 0, value | H.U(1), H.U(0))


def _describe(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sig = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.uint64)
            for texts in H.slices(batch.column("text")):
                tokens, bounds = shingle_sets(texts, length)
                own = slice(texts.first, texts.first + len(bounds) - 1)
                n[own], sig[own] = np.diff(bounds), signatures(tokens, bounds)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(sig.view(np.int64))], names=["id", "n", "sig"])

    return rows


def _packed(length: int, ranges: int):
    """Per buffer and range of hashes: the sets, how many of their shingles another set of the buffer shares, the others'
    hashes, and the hashes of the shared ones once (with the mark 65535 for the set)."""

    def packs(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        sig = np.concatenate([s for s, _, _ in held])
        first = np.cumsum([0] + [len(s) for s, _, _ in held])
        token = np.concatenate([t for _, t, _ in held])
        doc = np.concatenate([d + f for (_, _, d), f in zip(held, first)])
        sets, place = np.unique(sig, return_inverse=True)
        key = np.sort((token << H.U(16)) | place[doc].astype(np.uint64))
        key = key[np.append(True, key[1:] != key[:-1])]
        token, doc = key >> H.U(16), (key & H.U(65535)).astype(np.int64)
        same = np.append(False, token[1:] == token[:-1])
        shared = same | np.append(same[1:], False)
        send = ~shared | (shared & ~same)  # a shared shingle goes once
        where = ((token * H.U(ranges)) >> H.U(_TOKEN_BITS)).astype(np.int64)
        cuts = np.searchsorted(where, np.arange(ranges + 1))
        out: list[tuple] = []
        for r in range(ranges):
            part = slice(cuts[r], cuts[r + 1])
            if part.start == part.stop:
                continue
            d, common, go = doc[part], shared[part], send[part]
            size = np.bincount(d, minlength=len(sets))
            used = np.flatnonzero(size)
            spot = np.zeros(len(sets), np.uint16)
            spot[used] = np.arange(len(used), dtype=np.uint16)
            inner = spot[d]
            mark = np.where(common, np.uint16(65535), inner)
            out.append((
                r, sets[used].tobytes(), np.bincount(inner, common, len(used)).astype(np.uint32).tobytes(),
                token[part][go].astype(np.uint32).tobytes(), mark[go].tobytes(),
            ))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()))], names=["range", "sets", "common", "tokens", "marks"]
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, docs = [], 0, 0
        for batch in batches:
            for texts in H.slices(batch.column("text")):
                tokens, bounds = shingle_sets(texts, length)
                if not len(tokens):
                    continue
                if held and (size + len(tokens) > _BUFFER or docs + len(bounds) > 65_000):
                    yield from packs(held)
                    held, size, docs = [], 0, 0
                    _given_back()
                held.append((signatures(tokens, bounds), tokens, H.owner(bounds)))
                size, docs = size + len(tokens), docs + len(bounds) - 1
        if held:
            yield from packs(held)

    return rows


_KINDS = {"sets": np.uint64, "common": np.uint32, "tokens": np.uint32, "marks": np.uint16}
#: Sets whose counts a task adds up before it sends them on.
_SETS = 1_000_000


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For packs in the order of their ranges: per set, how many of its shingles another set has too.

    A task looks at one range at a time, and adds up a set's counts over its ranges, so that more ranges mean
    less memory and not more rows.
    """
    held: dict[str, list[np.ndarray]] = {c: [] for c in _KINDS}
    found: list[tuple[np.ndarray, np.ndarray]] = []
    waiting, now = 0, None

    def added() -> pa.RecordBatch:
        sig, place = np.unique(np.concatenate([s for s, _ in found]), return_inverse=True)
        shared = np.zeros(len(sig), np.int64)
        np.add.at(shared, place, np.concatenate([n for _, n in found]))
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(shared)], names=["sig", "shared"])

    for batch in batches:
        for i, r in enumerate(batch.column("range").to_pylist()):
            if r != now and held["sets"]:
                found.append(_of_range(held))
                _given_back()
                waiting += len(found[-1][0])
                held = {c: [] for c in _KINDS}
                if waiting > _SETS:
                    yield added()
                    waiting = 0
            now = r
            for c, k in _KINDS.items():
                raw = batch.column(c)[i].as_buffer()
                # a copy: a view would keep the whole batch
                held[c].append(np.frombuffer(raw, k).copy() if len(raw) else np.zeros(0, k))
    if held["sets"]:
        found.append(_of_range(held))
    if found:
        yield added()


def _of_range(columns: dict[str, list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sets of one range's packs that share shingles there, and how many."""
    sets = columns["sets"]
    all_sets, place = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.cumsum([0] + [len(s) for s in sets])
    credit = np.zeros(len(all_sets), np.int64)
    key = np.empty(sum(len(x) for x in columns["tokens"]), np.uint64)
    at = 0
    nobody = len(all_sets)  # stands for a shingle that several sets of one buffer hold
    for i, f in enumerate(first[:-1]):
        own = np.append(place[f : first[i + 1]], nobody)
        np.maximum.at(credit, own[:-1], columns["common"][i].astype(np.int64))
        mark = columns["marks"][i]
        doc = own[np.where(mark == 65535, len(own) - 1, mark)].astype(np.uint64)
        key[at : at + len(doc)] = (columns["tokens"][i].astype(np.uint64) << H.U(32)) | doc
        at += len(doc)
    key.sort()
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    half = key.view(np.uint32).reshape(-1, 2)  # little-endian: the set, then the shingle
    same = np.append(False, half[1:, 1] == half[:-1, 1])
    shared = (same | np.append(same[1:], False)) & (half[:, 0] != nobody)
    credit += np.bincount(half[shared, 0], minlength=len(all_sets) + 1)[: len(all_sets)]
    # a set sent from several buffers may have been credited for one shingle twice: too many keeps it, never drops it
    at = np.flatnonzero(credit)
    return all_sets[at], credit[at]


def _tokens(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in H.slices(batch.column("text")):
                tokens, bounds = shingle_sets(texts, length)
                some = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens.view(np.int64)))
                part = batch.slice(texts.first, len(bounds) - 1)
                # an id that stands for several texts brings each of them; only the set that is meant stays
                meant = pa.array(signatures(tokens, bounds).view(np.int64) == np.asarray(part.column("sig")))
                own = pa.RecordBatch.from_arrays([part.column("sig"), part.column("n"), some], names=["sig", "n", "tokens"])
                yield own.filter(meant)

    return rows


def _every_set(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in H.slices(batch.column("text")):
                tokens, bounds = shingle_sets(texts, length)
                some = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens.view(np.int64)))
                sig = pa.array(signatures(tokens, bounds).view(np.int64))
                yield pa.RecordBatch.from_arrays([sig, pa.array(np.diff(bounds).astype(np.int64)), some], names=["sig", "n", "tokens"])

    return rows


_SET = "sig bigint, n bigint, tokens array<bigint>"
_SPOTS = 1 << 25


def _likely(spark: SparkSession, source: DataFrame, live: DataFrame) -> DataFrame:
    """The rows of ``source`` whose id may be in ``live``, so that the others' texts are not shuffled to be dropped.

    A bitmap of a fixed four megabytes, made by a grouped bit_or, is all that comes to the driver and is broadcast.
    The join decides; with more ids than spots the bitmap just lets everything pass.
    """
    spot = F.pmod(F.xxhash64("id"), F.lit(_SPOTS))
    marks = live.select(spot.alias("spot")).selectExpr("shiftright(spot, 6) as word", "shiftleft(1L, cast(spot & 63 as int)) as bit")
    bitmap = np.zeros(_SPOTS // 64, np.int64)
    for row in marks.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        bitmap[row.word] = row.bits
    held = spark.sparkContext.broadcast(bitmap)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held.value
        for batch in batches:
            at = np.asarray(batch.column("spot"))
            keep = (words[at >> 6] >> (at & 63)) & 1 == 1
            yield batch.filter(pa.array(keep)).select(["id", "text"])

    return source.where("id is not null").withColumn("spot", spot).mapInArrow(_leaving_nothing(rows), "id bigint, text string")


def near_duplicates(
    spark: SparkSession, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 5, percent: int = 80, star_rounds: int = 3
) -> DataFrame:
    """Per document row: ``id, n_shingles, component_id`` (the smallest id that links reach, its own included)."""
    source = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    with _small_batches(spark):
        rows, held = _candidates(spark, source, length, percent)
    links = _links(spark, held, percent, star_rounds)
    roots = components(spark, links)
    named = rows.join(roots.select(F.col("node").alias("sig"), "root"), "sig", "left").withColumn("group", F.when(F.col("n") > 0, F.coalesce("root", "sig")))
    lowest = named.where("n > 0").groupBy("group").agg(F.min("id").alias("lowest"))
    return named.join(lowest, "group", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("lowest", "id").alias("component_id"))


def _candidates(spark: SparkSession, source: DataFrame, length: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All rows (``id, n, sig``), and once each the sets (``sig, n, tokens``) of which enough is shared to have a partner."""
    rows = stored(spark, source.mapInArrow(_leaving_nothing(_describe(length)), "id bigint, n bigint, sig bigint"), "set-rows")
    # a range of hashes is what a task holds at a time: as many ranges as the shingles ask for
    total = rows.agg(F.sum("n")).first()[0] or 0
    ranges = min(65_535, max(12, total // _RANGE + 1))
    packs = source.select("text").mapInArrow(_leaving_nothing(_packed(length, ranges)), "range int, sets binary, common binary, tokens binary, marks binary")
    # a set's shingles lie in many tasks, each with a count of its own: no more of them than their work asks for
    tasks = max(12, total // _TASK)
    counts = packs.repartition(tasks, "range").sortWithinPartitions("range").mapInArrow(_leaving_nothing(_shared_counts), "sig bigint, shared bigint")
    counts = counts.groupBy("sig").agg(F.sum("shared").alias("shared"))
    sets = rows.where("n > 0").groupBy("sig").agg(F.first("n").alias("n"), F.min("id").alias("id"))
    live = sets.join(counts, "sig").where(F.col("shared") * 100 >= F.col("n") * percent).select("id", "sig", "n")
    live = stored(spark, live, "live")
    named = live.where("id is not null")
    texts = _likely(spark, source, named).join(named, "id")
    found = texts.mapInArrow(_leaving_nothing(_tokens(length)), _SET)
    # sets that only rows without an id hold are found by themselves
    unnamed = source.where("id is null").mapInArrow(_leaving_nothing(_every_set(length)), _SET).join(live.where("id is null").select("sig"), "sig", "left_semi")
    return rows, stored(spark, found.unionByName(unnamed).dropDuplicates(["sig"]), "live-sets")


def _links(spark: SparkSession, held: DataFrame, percent: int, star_rounds: int) -> DataFrame:
    """Links between sets (``sig, n, tokens``) that join all similar sets, directly or by others: rows (a, b)."""
    each = held.select("sig", "n", F.explode("tokens").alias("token"))
    common = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # per set its shared shingles; the unshared ones come first in every order and fill that much of the prefix
    shared = each.join(common, "token").groupBy("sig", "n").agg(F.collect_list(F.struct("df", "token")).alias("shared"))
    least = F.floor((F.col("n") * percent + 99) / 100)
    room = (F.size("shared") - least + 1).cast("int")
    shared = shared.withColumn("room", room).where("room > 0")

    def prefix(k: int):
        """The shared part of the prefix under the k-th order: by rarity with ties of its own, the last one by hash alone."""
        rarity = lambda s: s["df"] if k < ORDERS - 1 else F.lit(0).cast("bigint")
        ranked = F.transform("shared", lambda s: F.struct(rarity(s).alias("df"), F.xxhash64(s["token"], F.lit(k)).alias("tie"), s["token"].alias("token")))
        return F.transform(F.slice(F.sort_array(ranked), F.lit(1), F.col("room")), lambda s: s["token"]).alias(f"p{k}")

    prefixes = shared.select("sig", "n", "room", F.size("shared").alias("common"), *[prefix(k) for k in range(ORDERS)])
    prefixes = stored(spark, prefixes, "prefixes")
    # ``rest``: shingles from this one on; if it is the first that two sets share, they share no more than the smaller rest
    bucket = prefixes.select("sig", "n", "room", "common", F.posexplode("p0").alias("at", "token"))
    bucket = stored(spark, bucket.select("sig", "n", "room", "token", (F.col("common") - F.col("at")).alias("rest")), "buckets")
    fits = (F.least("n", "m") * 100 >= F.greatest("n", "m") * percent) & (F.least("rest", "rest2") * (100 + percent) >= (F.col("n") + F.col("m")) * percent)
    done = links = root = None
    for _ in range(star_rounds):
        now = bucket if root is None else bucket.join(root, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
        if root is None:
            now = now.withColumn("root", F.col("sig"))
        # the most typical set of a bucket has most of its prefix shared; it stands for the bucket's largest component
        by_root = now.groupBy("token", "root").agg(F.max(F.struct("room", "sig", "n", "rest")).alias("best"), F.count(F.lit(1)).alias("size"))
        centre = by_root.groupBy("token").agg(
            F.max(F.struct("size", "best", "root")).alias("top"), F.min("root").alias("low"), F.max("root").alias("high")
        ).where("low <> high")
        centre = centre.select("token", F.col("top.root").alias("own"), F.col("top.best.sig").alias("a"), F.col("top.best.n").alias("m"), F.col("top.best.rest").alias("rest2"))
        pairs = now.join(centre, "token").where("root <> own").where(fits).select("a", F.col("sig").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        found = _verified(spark, pairs, held, prefixes, percent)
        done = found.select("a", "b") if done is None else done.unionAll(found.select("a", "b"))
        new = found.where("linked").select("a", "b")
        links = new if links is None else links.unionAll(new)
        if not new.limit(1).count():
            break
        root = components(spark, links).select(F.col("node").alias("sig"), "root")
    now = bucket.join(root, "sig", "left").withColumn("root", F.coalesce("root", "sig")) if root is not None else bucket.withColumn("root", F.col("sig"))
    mixed = now.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    left = now.join(mixed, "token", "left_semi")
    right = left.select("token", F.col("sig").alias("b"), F.col("n").alias("m"), F.col("root").alias("other"), F.col("rest").alias("rest2"))
    pairs = left.join(right, "token").where("sig < b and root <> other").where(fits).select(F.col("sig").alias("a"), "b").distinct()
    both = done.unionAll(done.select(F.col("b").alias("a"), F.col("a").alias("b")))
    found = _verified(spark, pairs.join(both, ["a", "b"], "left_anti"), held, prefixes, percent)
    return links.unionAll(found.where("linked").select("a", "b"))


def _verified(spark: SparkSession, pairs: DataFrame, held: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """``a, b, linked`` of all pairs: first they must share a prefix shingle under every other order, then the sets decide."""
    other = [f"p{k}" for k in range(1, ORDERS)]
    thin = pairs.join(prefixes.select(F.col("sig").alias("a"), *[F.col(c).alias(f"a_{c}") for c in other]), "a")
    thin = thin.join(prefixes.select(F.col("sig").alias("b"), *[F.col(c).alias(f"b_{c}") for c in other]), "b")
    passed = F.lit(True)
    for c in other:
        passed = passed & F.arrays_overlap(f"a_{c}", f"b_{c}")
    thin = stored(spark, thin.select("a", "b", passed.alias("passed")), "candidates")
    full = thin.where("passed").join(held.select(F.col("sig").alias("b"), F.col("tokens").alias("tb")), "b")
    full = full.join(held.select(F.col("sig").alias("a"), F.col("tokens").alias("ta")), "a")
    both = F.size(F.array_intersect("ta", "tb"))
    linked = both * 100 >= (F.size("ta") + F.size("tb") - both) * percent
    decided = full.select("a", "b", linked.alias("linked"))
    return stored(spark, decided.unionAll(thin.where("not passed").select("a", "b", F.lit(False).alias("linked"))), "decided")


def keep_one(spark: SparkSession, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without all but one (the smallest id) of each component; rows repeated under that id leave one.

    Rows without an id stay, as no verdict can name them.
    """
    found = near_duplicates(spark, documents, id_col, text_col, **options)
    kept = found.where("id is null or id = component_id").select(F.col("id").alias("__kept")).distinct()
    best = documents.join(kept, documents[id_col].eqNullSafe(F.col("__kept")), "left_semi")
    alone = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())
    return best.withColumn("__alone", alone).dropDuplicates([id_col, "__alone"]).drop("__alone")
