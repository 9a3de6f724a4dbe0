"""Similarity joins, passages and repeated strings next to brute force."""

import re

import pytest
from pyspark.sql import functions as F

from quayside.llm import chains, components, jaccard, repeats
from tests.llm.tables import documents, texts


def shingles(text, length):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + length]) for i in range(max(1, len(w) - length + 1))} if w else set()


def lowest(rows, length, percent):
    """Brute force: smallest id reachable by links."""
    sets = [shingles(t, length) for t in rows]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return {i: (len(sets[i]), root[i]) for i in range(len(rows))}


@pytest.mark.parametrize("length,percent", [(4, 85), (5, 80)])
def test_jaccard_components(spark, length, percent):
    rows = texts()
    got = jaccard.near_duplicates(spark, documents(spark, rows), length=length, percent=percent).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == lowest(rows, length, percent)


def test_jaccard_group_of_near_copies(spark):
    """Sets that are similar to the typical one only: links must join them all the same."""
    base = [f"w{i}" for i in range(100)]
    rows = [" ".join(base)] + [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(0, 100, 2)]
    rows += [" ".join(base[:i] + [f"y{i}", f"z{i}"] + base[i + 2 :]) for i in range(1, 90, 7)]
    got = jaccard.near_duplicates(spark, documents(spark, rows), length=4, percent=85).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == lowest(rows, 4, 85)


def test_jaccard_keeps_one_of_each(spark):
    rows = texts()
    df = documents(spark, rows)
    nameless = df.limit(12).withColumn("doc_id", F.lit(None).cast("bigint"))
    kept = jaccard.keep_one(spark, df.unionAll(df.limit(3)).unionAll(nameless), length=5, percent=80)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 12
    assert sorted(i for i in ids if i is not None) == sorted({v[1] for v in lowest(rows, 5, 80).values()})


def test_jaccard_of_nothing(spark):
    assert jaccard.near_duplicates(spark, documents(spark, [])).collect() == []
    assert jaccard.near_duplicates(spark, documents(spark, [None, ""])).count() == 2


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.root for r in components.components(spark, spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(20)}, 200: 200, 300: 200}


def without_repeats(rows, least):
    data = [(t or "").encode() for t in rows]
    seen = {}
    for b in data:
        for s in range(len(b) - least + 1):
            seen[b[s : s + least]] = seen.get(b[s : s + least], 0) + 1
    out = []
    for b in data:
        mark = bytearray(len(b))
        for s in range(len(b) - least + 1):
            if seen[b[s : s + least]] > 1:
                mark[s : s + least] = b"\1" * least
        kept = bytes(x for x, m in zip(b, mark) if not m)
        out.append((len(b), sum(mark), len(re.findall(b"\1+", bytes(mark))), kept))
    return out


@pytest.mark.parametrize("group_rows", [20_000, 1])
@pytest.mark.parametrize("least", [100, 200])
def test_repeated_strings(spark, least, group_rows):
    rows = [t if t is None or len(t) < 50_000 else t[:30_000] for t in texts()]
    got = repeats.deduplicate(spark, documents(spark, rows), least=least, group_rows=group_rows).collect()
    have = {r.id: (r.n_bytes, sum(s["last"] - s["first"] for s in r.removed), len(r.removed), bytes(r.kept)) for r in got}
    assert have == dict(enumerate(without_repeats(rows, least)))


def test_repeated_strings_of_nothing(spark):
    assert repeats.deduplicate(spark, documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        repeats.deduplicate(spark, documents(spark, []), least=64)


def test_common_prefix_intervals():
    # sorted: aab aac ab b ba
    assert sorted(repeats.intervals([0, 2, 1, 0, 1], 1)) == [(0, 1, 2), (0, 2, 1), (3, 4, 1)]


def test_passages_are_found_and_clean_documents_left(spark):
    rows = texts()
    got = chains.passages(spark, documents(spark, rows)).collect()
    w = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for t in rows]
    seen = {}
    for i, own in enumerate(w):
        for s in range(len(own) - 49):
            seen.setdefault(tuple(own[s : s + 50]), set()).add(i)
    sharing = set().union(*(v for v in seen.values() if len(v) > 1))
    named = {r.doc_id for r in got} | {r.partner_id for r in got}
    assert sharing <= named
    assert len(rows) - 1 not in named and not named & {i for i, own in enumerate(w) if len(own) < 50}
    for r in got:
        a, b = w[r.doc_id][r.first : r["last"]], w[r.partner_id][r.partner_first : r.partner_last]
        assert min(len(a), len(b)) >= 50 and 2 * r.matched >= 0.8 * (len(a) + len(b))


def test_passages_of_nothing(spark):
    assert chains.passages(spark, documents(spark, [])).collect() == []


def best_chain(points, k, skip):
    points = sorted(set(points))
    score = []
    for i, (x, y) in enumerate(points):
        own = [score[j] + k - skip * (x - a + y - b) for j, (a, b) in enumerate(points[:i]) if a < x and b < y]
        score.append(max([float(k), *own]))
    return max(score)


def test_chain_has_the_best_score():
    import random

    rng = random.Random(4)
    for _ in range(50):
        points = [(rng.randint(0, 40), rng.randint(0, 40)) for _ in range(rng.randint(2, 25))]
        found = chains.chain(points, 5, 0.05)
        top = max([5.0] + [5 + sum(5 - 0.05 * (x - a + y - b) for (a, b), (x, y) in zip(c, c[1:])) for c in found])
        assert abs(top - best_chain(points, 5, 0.05)) < 1e-9
        assert all(a[0] < b[0] and a[1] < b[1] for c in found for a, b in zip(c, c[1:]))


def spans(rows):
    return {(r.doc_id, r.first, r["last"], r.partner_id, r.partner_first, r.partner_last) for r in rows if r.kind == "passage"}


def words_of(name, n):
    return [f"{name}{i}" for i in range(n)]


def within(found, a, first, last, b, other_first, other_last, slack=15):
    """Whether a passage of a and b holds the bounds given, or misses or passes them by a few words."""
    ends = [(f, e, g, h) if (i, j) == (a, b) else (g, h, f, e) for i, f, e, j, g, h in found if {i, j} == {a, b}]
    return any(f <= first and e >= last and g <= other_first and h >= other_last and e - f <= last - first + slack for f, e, g, h in ends)


@pytest.mark.parametrize("gap", [60, 200])
def test_two_passages_of_one_pair(spark, gap):
    one, two = words_of("p", 60), words_of("q", 60)
    rows = [" ".join(one + words_of(f"g{i}x", gap) + two) for i in range(2)]
    found = spans(chains.passages(spark, documents(spark, rows)).collect())
    assert within(found, 0, 0, 60, 1, 0, 60)
    assert within(found, 0, 60 + gap, 120 + gap, 1, 60 + gap, 120 + gap)


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for i, y in enumerate(b):
            row.append(last[i] + 1 if x == y else max(last[i + 1], row[-1]))
    return row[-1]


@pytest.mark.parametrize("bits", [1 << 24, 50])
def test_common_words_are_a_longest_subsequence(bits, monkeypatch):
    import random

    monkeypatch.setattr(chains, "_TABLE_BITS", bits)
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 30))] for _ in range(2))
        pairs = chains.common_words(a, b)
        assert all(a[x] == b[y] for x, y in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) == common_length(a, b)


def test_passages_go_on_beyond_the_seeds():
    import numpy as np

    a = np.arange(600, dtype=np.uint32)
    b = np.concatenate([a[:150], [9001], a[150:450], a[452:]]).astype(np.uint32)
    for xs, ys in (([300], [301]), ([20], [20]), ([580], [579])):
        x, y, less, more = chains.align(xs, ys, a, b, 5, 0.8)
        assert chains.stretches(x, y, 50, 0.8) == [(0, 600, 0, 599, 598)] and less and more
    # the chain's words and 64 more on either side do not tell: the whole text is asked for
    x, y, less, more = chains.align([64], [301], a[236:369], b, 5, 0.8)
    assert less and more


@pytest.mark.parametrize("percent", [10, 15, 20])
def test_passages_with_replaced_words(spark, percent):
    """Passages of 60 words, so many of them replaced in the second text, at random places but never an end: each must be found."""
    import random

    rng = random.Random(percent)
    rows, want = [], []
    for i in range(60):
        own = words_of(f"p{i}x", 60)
        other = list(own)
        for at in rng.sample(range(1, 59), 60 * percent // 100):
            other[at] = f"r{i}x{at}"
        rows += [" ".join(words_of(f"a{i}x", 30) + own + words_of(f"b{i}x", 30)), " ".join(words_of(f"c{i}x", 50) + other + words_of(f"d{i}x", 10))]
        want.append((2 * i, 30, 90, 2 * i + 1, 50, 110))
    found = spans(chains.passages(spark, documents(spark, rows)).collect())
    assert [x for x in want if not within(found, *x)] == []


def test_passage_whose_words_stand_in_other_texts_too(spark):
    """Two texts hold parts of a passage of two others; whichever comes first by hash, the two are compared."""
    rows, want = [], []
    for i in range(12):
        p = words_of(f"p{i}x", 60)
        rows += [" ".join(words_of(f"{x}{i}x", 30) + own + words_of(f"{x}{i}y", 30)) for x, own in (("a", p[:40]), ("b", p[20:]), ("c", p), ("d", p))]
        want.append((4 * i + 2, 30, 90, 4 * i + 3, 30, 90))
    found = spans(chains.passages(spark, documents(spark, rows)).collect())
    assert [x for x in want if not within(found, *x)] == []


@pytest.mark.parametrize("block", [2048, 16])
def test_passage_of_words_that_many_texts_hold(spark, block):
    """All runs of up to 32 words of a passage of two texts stand in more than 64 other texts, which hold no passage themselves."""
    p = words_of("p", 60)
    rows = [" ".join(words_of(f"a{i}x", 40) + own + words_of(f"b{i}x", 40)) for i in range(70) for own in (p[:49], p[11:])]
    rows += [" ".join(words_of(f"{x}x", 30) + p + words_of(f"{x}y", 30)) for x in "cd"]
    found = spans(chains.passages(spark, documents(spark, rows), block=block).collect())
    assert within(found, 140, 30, 90, 141, 30, 90)


def test_passage_whose_words_lie_in_other_passages_too(spark):
    """Each half of a passage of two texts lies in passages that these have with four others, which share none: the two are compared."""
    rows, want = [], []
    for i in range(24):
        p = words_of(f"p{i}x", 60)
        b, c = ([words_of(f"{x}{i}y", 30), p, words_of(f"{x}{i}z", 30)] for x in "bc")
        rows += [" ".join(words_of(f"{x}{i}v", 20) + sum(own, []) + words_of(f"{x}{i}w", 20)) for x, own in (("b", b), ("c", c))]
        for x, own in (("d", b), ("e", c)):
            rows += [" ".join(words_of(f"{x}{i}s", 20) + own[0] + p[:30]), " ".join(p[30:] + own[2] + words_of(f"{x}{i}t", 20))]
        want.append((6 * i, 50, 110, 6 * i + 1, 50, 110))
    found = spans(chains.passages(spark, documents(spark, rows)).collect())
    # passages of more than two texts may be told by a third one that has both
    assert [x for x in want if not within(found, *x)] == []


def test_copies_with_edits_are_told_by_one_of_them(spark):
    """Of many copies of one text, edited here and there, as many passages as there are texts lead from one to all others, not all pairs."""
    import random

    rng = random.Random(8)
    p = words_of("p", 150)
    rows = [" ".join(f"r{i}x{j}" if rng.random() < 0.04 else w for j, w in enumerate(p)) for i in range(60)]
    found = spans(chains.passages(spark, documents(spark, rows)).collect())
    near = {i: set() for i in range(60)}
    for a, *_, b, _, _ in found:
        near[a].add(b)
        near[b].add(a)
    seen, todo = set(), [0]
    while todo:
        i = todo.pop()
        if i not in seen:
            seen.add(i)
            todo += near[i]
    assert seen == set(range(60)) and len(found) < 6 * 60


def test_every_tie_comes_once(spark):
    import random

    rng = random.Random(6)
    rows = [(s, h, [h + s], rng.random() < 0.5) for s in range(5) for h in rng.sample(range(-40, 40), 8 * s + 2)]
    sizes = {s: sum(r[0] == s for r in rows) for s in range(5)}
    marked = spark.createDataFrame([(s, h, at, sizes[s], o) for s, h, at, o in rows], "seed bigint, h bigint, at array<int>, texts bigint, open boolean")
    want = sorted((h, g, x[0], y[0]) for s, h, x, o in rows for t, g, y, q in rows if s == t and h > g and (o or q))
    for block in (3, 1000):
        assert sorted((r.h, r.other, r.xs[0], r.ys[0]) for r in chains._all_ties(marked, block).collect()) == want


def test_a_line_of_many_texts_ties_no_two_of_them(spark, monkeypatch):
    """A line that stands in many texts leads to no pair that shares nothing else; two texts share it in an edited passage."""
    stored, counts = chains.stored, []

    def counted(spark, df, label):
        table = stored(spark, df, label)
        if label == "chained":
            counts.append(table.count())
        return table

    monkeypatch.setattr(chains, "stored", counted)
    line = words_of("line", 13)
    rows = [" ".join(words_of(f"a{i}x", 60) + line + words_of(f"b{i}x", 5 * (i % 9))) for i in range(120)]
    p = words_of("p", 25) + line + words_of("q", 22)
    edited = [f"r{i}" if i % 5 == 2 and not 25 <= i < 38 else w for i, w in enumerate(p)]
    rows += [" ".join(words_of(f"c{x}y", 30) + own + words_of(f"d{x}y", 30)) for x, own in enumerate((p, edited))]
    found = spans(chains.passages(spark, documents(spark, rows)).collect())
    assert within(found, 120, 30, 90, 121, 30, 90)
    assert sum(counts) < 3 * len(rows)


def test_common_runs_over_and_over_lead_to_all_partners(spark):
    """Two texts share a passage of runs that 40 others have, each in a passage too short; levels of common runs go up until it is found."""
    p = [w for i in range(4) for w in [f"w{i}"] * 15]
    rows = [" ".join(words_of(f"a{i}x", 40) + p[15 * (i % 4) : 15 * (i % 4) + 15] + words_of(f"b{i}x", 40)) for i in range(160)]
    rows += [" ".join(words_of(f"{x}x", 30) + p + words_of(f"{x}y", 30)) for x in "cd"]
    found = spans(chains.passages(spark, documents(spark, rows)).collect())
    assert within(found, 160, 30, 90, 161, 30, 90)
