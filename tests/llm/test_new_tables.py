"""Line deduplication, vector codes and the prefix trie next to brute force."""

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import codes, jaccard, lines, markup, quality, trie
from quayside.llm.register import ORACLES, QUERIES
from tests.compare import _rows, connect
from tests.llm.tables import documents, texts

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_conversation_prefix_trie", "op12_line_dedup", "op13_vector_code_compression"])
def test_query_agrees_with_sql(spark, name):
    df = QUERIES[name](spark, SF)
    cursor = connect(SF).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, cursor.fetchall())


# lines


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line).strip(" \t\n\x0b\f\r")


def deduplicated(rows, least, chars):
    held = Counter(k for t in rows for k in {key_of(x) for x in (t or "").split("\n")})
    out = []
    for t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(key_of(x)) < chars or held[key_of(x)] < least]
        out.append(("\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return out


def line_texts():
    rng = random.Random(5)
    stock = ["Alle Rechte", " alle RECHTE\t", "Ä b", "ä B", "", "  ", "x", "mm", "a\x0bb", "\x0bmm\x0c", " mm"] + [f"only {i}" for i in range(40)]
    rows = ["\n".join(rng.choice(stock) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    return texts() + rows + ["mm\n" * 500 + "end", "same\nsame\nown", None, "\n", "\n\n"] + ["copy of one\nmm\nlast"] * 7


@pytest.mark.parametrize("least,chars", [(1, 1), (3, 1), (3, 0), (8, 3), (1000, 1)])
def test_lines(spark, least, chars):
    rows = line_texts()
    got = lines.drop_shared_lines(spark, documents(spark, rows), min_docs=least, min_chars=chars).collect()
    assert {r.id: (r.kept, r.n_lines, r.n_dropped) for r in got} == dict(enumerate(deduplicated(rows, least, chars)))


def test_lines_of_repeated_and_null_ids(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (None, "a\nc"), (None, None)]
    df = spark.createDataFrame([(i, t, 0, 0, "k", "l") for i, t in rows], "doc_id long, text string, h1 long, place int, key string, lines string")
    got = lines.drop_shared_lines(spark, df, min_docs=3).collect()
    assert sorted((str(r.id), r.kept, r.n_dropped) for r in got) == [("1", "b", 1), ("1", "b", 1), ("None", "", 0), ("None", "c", 1)]
    assert lines.drop_shared_lines(spark, df.limit(0)).collect() == []


# vector codes


def coded(rows, parts, entries, rounds):
    kept = sorted(((i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows), key=lambda r: r[0])
    width = len(kept[0][1])
    cuts = [p * width // parts for p in range(parts + 1)]
    cut = lambda v: [v[a:b] for a, b in zip(cuts, cuts[1:])]
    books = [[cut(v)[p] for _, v in kept[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((away(x, c), j) for j, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, v in kept:
                members[near(cut(v)[p], books[p])[1]].append(cut(v)[p])
            for j, own in members.items():
                books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    found = {i: [near(x, books[p]) for p, x in enumerate(cut(v))] for i, v in kept}
    return {i: ([j for _, j in f], sum(d for d, _ in f)) for i, f in found.items()}, books


def vectors(n, width, spread, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, spread, (7, width))
    return [(i, [float(np.float32(x)) for x in middle[i % 7] + rng.normal(0, 0.05, width)]) for i in range(n)]


@pytest.mark.parametrize("width,parts,entries,rounds", [(8, 4, 16, 4), (7, 3, 5, 3), (4, 2, 300, 2), (6, 2, 9, 0)])
def test_codes(spark, width, parts, entries, rounds):
    rows = vectors(320, width, 0.4) + [(400 + i, [0.5] * width) for i in range(20)] + [(500 + i, [0.0] * width) for i in range(9)]
    df = spark.createDataFrame([(i, v, i % 3 if i % 5 else None, "c") for i, v in rows], "vec_id long, embedding array<float>, label int, codes string").repartition(5)
    got, books = codes.compress(spark, df, parts=parts, entries=entries, rounds=rounds)
    want, wanted_books = coded(rows, parts, entries, rounds)
    assert [b.tolist() for b in books.entries] == wanted_books
    assert {r.id: (r.codes, r.error) for r in got.collect()} == want
    assert books.sha256() == hashlib.sha256(",".join(str(x) for b in wanted_books for c in b for x in c).encode()).hexdigest()


def test_cores_and_rings_spare_comparisons(spark):
    rows = vectors(700, 8, 2.0)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")
    got, _ = codes.compress(spark, df, parts=2, entries=64, rounds=3)
    looks = got.agg(F.sum("looks")).first()[0]
    assert 0 < looks < 0.25 * 700 * 2 * 64


def test_reassignment_is_that_of_all_entries():
    rng = np.random.default_rng(4)
    for scale in (1, 3, 50, 4000):  # small scales make ties and equal entries
        x, book = rng.integers(-scale, scale + 1, (500, 3)), rng.integers(-scale, scale + 1, (40, 3))
        was = rng.integers(0, 40, 500)
        radius = np.zeros(40, np.int64)
        np.maximum.at(radius, was, ((x - book[was]) ** 2).sum(1))
        code, far, looks = codes.reassigned(x, was, codes.balls(book, radius))
        wanted, apart = codes.nearest(x, book)
        assert (code == wanted).all() and (far == apart).all() and looks <= 500 * 39


def test_odd_vectors(spark):
    rows = [(3, [1.0, 2.0], 1), (None, [1.0, 2.5], None), (4, None, 1), (5, [1.0, None], 1), (6, [float("nan"), 1.0], 2), (7, [float("inf"), 1.0], 2), (8, [1.0], 2), (3, [0.0, 0.0], 1), (9, [], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got, books = codes.compress(spark, df, parts=2, entries=2, rounds=1)
    assert sorted((str(r.id), r.codes, r.error) for r in got.collect() if r.codes) == [("3", [0, 0], 0), ("3", [1, 1], 256**2), ("None", [1, 1], 256**2)]
    assert [b.tolist() for b in books.entries] == [[[0], [1024]], [[0], [2304]]]
    assert sorted(r.id for r in got.collect() if r.codes is None) == [8, 9]
    assert got.where("id is null").first().codes is not None
    none, books = codes.compress(spark, df.limit(0))
    assert none.collect() == [] and books.sha256() == hashlib.sha256(b"").hexdigest()
    with pytest.raises(Exception, match="beyond"):
        codes.compress(spark, spark.createDataFrame([(1, [1e9], 0)], df.schema))[0].collect()


# prefix trie


def nodes_of(rows):
    """Nodes of the rebuilt conversations, by brute force."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    paths = {c: own.get(c - c % 20, [])[: h[c]] + v[h[c] :] for c, v in own.items()}
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    out = set()
    for node, own_members in members.items():
        below = [u for u in members if u[: len(node)] == node]
        childless = [u for u in below if not any(len(w) == len(u) + 1 and w[: len(u)] == u for w in below)]
        saved = sum((len(members[u]) - 1) * len([w for w in u[-1][1].replace("\x0b", " ").split(" ") if w]) for u in below if u)
        ends = ",".join(str(c) for c in sorted(c for c in own_members if len(paths[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        n_children = sum(len(u) == len(node) + 1 for u in below)
        out.add((min(own_members), len(node), parent, len(own_members), n_children, len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talk(n, seed=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 4 * n), n) + list(range(100000, 100040)):
        kind = rng.random()
        size = 0 if kind < 0.1 else rng.randint(1, 6)
        for t in range(size):
            words = rng.choice(["hi", "hi  there", "", "a\x0bb c", f"own {c} {t}"]) if t < 4 else f"{c}"
            rows.append((c, t if kind < 0.9 or t else None, rng.choice(["user", "user", None]), words if rng.random() < 0.95 else None))
    rows += [(c, t, "user", "hello you") for c in range(8000, 13000, 9) for t in range(4)]  # a hot conversation
    rows += [(77777, t, "x", f"long {t}") for t in range(300)] + [(None, 0, "user", "hi")]
    return rows


TALK = "conv_id long, turn long, role string, text string, words string, depth int"


def built(spark, said, **screen):
    df = spark.createDataFrame([(*r, "w", 1) for r in said], TALK).repartition(7)
    turns = trie.turns(df)
    grafted = trie.grafted(spark, turns, F.col("conv_id") - F.col("conv_id") % 20, F.crc32(F.col("conv_id").cast("string")) % 4, 3)
    got = trie.prefix_trie(spark, grafted, **screen).collect()
    found = {(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(found) == len(got)
    return found


@pytest.mark.parametrize("screen", [{}, {"most_cells": 1024, "hashes": 1}, {"cells_each": 2, "workers": 2}])
def test_trie(spark, screen):
    rows = talk(150)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert built(spark, rows, **screen) == nodes_of(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_small_tries(spark):
    assert built(spark, []) == set()
    for rows in ([(5, None, None, None)], [(0, 0, "a", "x y")], [(0, 0, "a", "x"), (0, 0, "a", "x"), (1, 0, "a", "x")], [(c, 0, "a", "b") for c in (20, 21, 22, 23, 24, 25)]):
        assert built(spark, rows) == nodes_of(rows)


def test_ends_of_many_pieces(spark):
    rows = [(c, 0, "a", "same words") for c in range(0, 60000, 20)]
    assert built(spark, rows) == nodes_of(rows)


def test_sketch_finds_most_singletons(spark):
    df = spark.range(20000).select(F.xxhash64("id").alias("d1"), F.xxhash64(F.lit(1), "id").alias("d2"))
    df = df.unionAll(df.limit(500))
    bits = trie.sketch(spark, df)
    cells = bits.shape[1] * 8
    d = df.dropDuplicates().toPandas()
    above = np.ones(len(d), bool)
    for row in range(len(bits)):
        cell = trie._cells(d.d1.to_numpy().view(np.uint64), d.d2.to_numpy().view(np.uint64), row, cells)
        above &= np.unpackbits(bits[row])[cell] == 1
    assert 500 <= above.sum() <= 500 + 400


# malformed pages


def shown(source):
    return " ".join(t for _, t in markup.parse(source).pieces)


@pytest.mark.parametrize(
    "source, text",
    [
        ("<p>a</p><a href=/x title=thatzzzzzzzzzz's mine>b</a><p>c</p>", "a b c"),
        ('<p title=aaaaaaaaaaaaaaaaaaaa"x y z>a</p>b', "a b"),
        ('<p title="a > b" class=\'c>d\'>e</p>', "e"),
        ('<p title = "never closed>a</p><p>b</p>', "a b"),
        ("<p>a</p><button>Menu<article><p>b</p></article>", "a Menu b"),
        ("<button>Menu<article><p>b</p></article><button>more</button><p>c</p>", "Menu b c"),
        ("<p>a</p><iframe src=x/><p>b</p>", "a b"),
        ("<noscript><p>a</p>", "a"),
        ("<p>a</p><svg/><svg><svg><title>t</title></svg>b", "a b"),
        ("<p>a</p><script>if (a<b) '</p>'", "a"),
        ("<p>a <label for=q>Mail</label> b</p>", "a b"),
        ("<BUTTON >x</Button >y", "y"),
    ],
)
def test_malformed_tags(source, text):
    assert shown(source) == text


@pytest.mark.parametrize("piece", ['<a title=x"', "<a title='", '<a b="', "<button>", "<svg>", "<p a=b'c", '<i x="y', "<!--", "<a ="])
def test_time_of_malformed_pages_is_that_of_their_length(piece):
    for source in (piece + "x " * 10_000, piece * 10_000, (piece + "> some text </p> ") * 5_000):
        began = time.monotonic()
        markup.parse(source)
        assert time.monotonic() - began < 3


# the n-gram join's edges


def test_null_ids_link_and_ranges_do_not_matter(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(words), " ".join(["x"] + words[3:]), " ".join(words[3:] + ["y", "z"])
    df = spark.createDataFrame([(1, a), (None, b), (2, c), (5, "alone here now"), (None, "alone here now")], "doc_id long, text string")
    for width in (2_000_000, 3):
        monkeypatch.setattr(jaccard, "_RANGE", width)
        monkeypatch.setattr(jaccard, "_SETS", 5 if width == 3 else 1_000_000)
        got = jaccard.near_duplicates(spark, df, length=4, percent=85).collect()
        # 1 and 2 share 54 of 60 shingles only by way of the text without an id
        assert sorted((str(r.id), r.component_id) for r in got) == [("1", 1), ("2", 1), ("5", 5), ("None", 1), ("None", 5)]


def test_keep_good_keeps_rows_as_they_were(spark):
    df = spark.createDataFrame([(1, "a", None, 2.0), (2, None, "x", None)], "doc_id long, text string, c0 string, score double")
    assert quality.keep_good(spark, df, 0.5).collect() == df.collect()
    assert quality.keep_good(spark, df, 0.1).collect() == [] and quality.keep_good(spark, df, 0.1).schema.names == df.columns
