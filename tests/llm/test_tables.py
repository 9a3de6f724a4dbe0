"""Top-k, sharding and mixing next to brute force; the pipeline's stages next to their operators."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import mixing, sharding, topk
from quayside.llm.register import ORACLES, QUERIES
from tests.compare import _rows, connect
from tests.llm.tables import documents, texts

SF = "/root/testdata/sf0.001"


def nearest(vectors, k, step):
    good = [(i, [np.floor(1024 * x) for x in v]) for i, v in vectors if v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in good:
        if i % step:
            continue
        found = sorted((-int(sum(a * b for a, b in zip(q, v))), j) for j, v in good if j != i)
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])}
    return out


@pytest.mark.parametrize("block,bucket", [(4096, 4096), (3, 7)])
def test_top_k(spark, block, bucket):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, rng.choice([0.1, 1, 5]), 8)]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(40)]  # ties
    rows += [(340, None), (350, [1.0, None] + [0.0] * 6), (360, [float("nan")] * 8), (370, [float("inf")] * 8), (380, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = topk.top_k(spark, df, F.col("vec_id") % 10 == 0, k=5, query_block=block, bucket_rows=bucket, focus=3)
    assert {tuple(r) for r in got.collect()} == nearest(rows, 5, 10)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([(0, [1.0])], "vec_id bigint, embedding array<float>")
    assert topk.top_k(spark, df, F.lit(True)).collect() == []
    assert topk.top_k(spark, df.limit(0), F.lit(True)).collect() == []
    assert topk.top_k(spark, df, F.lit(False)).collect() == []


def test_shards(spark):
    rows = texts()[:-1] * 3 + ["copy " * 30] * 200
    got = sharding.shard(spark, documents(spark, rows), shards=5, parcels_per_shard=16, piece_rows=7).collect()
    assert sorted(r.id for r in got) == list(range(len(rows)))
    by = {}
    for r in got:
        text = (rows[r.id] or "").encode()
        assert (r["size"], r.text_crc32, r.tokens) == (len(text) + 8, zlib.crc32(text), len((rows[r.id] or "").split()))
        by.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by.values())
    # the largest single text bounds what a shard can be off
    sizes = [sum(r["size"] for r in own) for own in by.values()]
    assert max(sizes) - min(sizes) <= max(len((t or "").encode()) for t in rows) + 8
    # equal texts stay together, unless they are large against a shard in one of the three sizes
    home, total = {}, [sum(r[c] for r in got) for c in ("size", "tokens")] + [len(got)]
    for r in got:
        home.setdefault(rows[r.id] or "", []).append(r)
    small = [own for own in home.values() if all(x < 0.15 * t / 5 for x, t in zip([sum(r[c] for r in own) for c in ("size", "tokens")] + [len(own)], total))]
    assert len(small) > 20 and all(len({r.shard for r in own}) == 1 for own in small)


def test_shards_are_level_and_hot_groups_are_split(spark):
    rows = [("w " * (20 + i % 37)) for i in range(2000)] + ["hot " * 25] * 1000
    got = sharding.shard(spark, documents(spark, [f"{i} {t}" if not t.startswith("hot") else t for i, t in enumerate(rows)]), shards=8).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    assert len(sizes) == 8 and max(sizes.values()) <= 1.03 * min(sizes.values())


def test_shards_of_nothing(spark):
    assert sharding.shard(spark, documents(spark, [])).collect() == []


def test_budgets_rise_among_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 1000), ("b", "z", 1000), ("c", "w", 20)], "d string, s string, held bigint")
    got = mixing.budgets(leaves, ["d", "s"], {"d": {"a": 1, "b": 1, "c": 2}}, F.lit(400), 1).collect()
    # c cannot take its half: a and b share what is left; in a, y takes what x cannot
    assert {(r.d, r.s): r.budget for r in got} == {("c", "w"): 20, ("a", "x"): 10, ("a", "y"): 180, ("b", "z"): 190}


@pytest.mark.parametrize("small", [20_000, 0])
def test_mixing_takes_a_prefix_per_epoch(spark, small):
    rows = [t for t in texts() if t is None or len(t) < 50_000]
    df = documents(spark, rows).withColumn("source", F.when(F.col("doc_id") % 3 == 0, None).otherwise("s")).withColumn("mix", F.lit(1))
    levels = {"source": F.col("source")}
    got = mixing.mix(spark, df, levels, {"source": {"s": 3}}, F.floor(F.col("held") * 3 / 2), max_epochs=2, seed=5, piece_rows=4, small_tree=small)
    assert got.columns == df.columns + ["mix_epoch", "mix_tokens"]
    tokens = {i: len((t or "").split()) for i, t in enumerate(rows)}
    taken = Counter((r.doc_id, r.mix_epoch) for r in got.collect())
    assert set(taken.values()) == {1}
    total = sum(tokens.values()) * 3 // 2
    s = [i for i in tokens if i % 3]
    rest = [i for i in tokens if i % 3 == 0]
    caps = {"s": 2 * sum(tokens[i] for i in s), None: 2 * sum(tokens[i] for i in rest)}
    budget = {"s": min(caps["s"], total * 3 // 4), None: min(caps[None], total // 4)}
    if budget["s"] == caps["s"]:
        budget[None] = min(caps[None], total - caps["s"])
    if budget[None] == caps[None]:
        budget["s"] = min(caps["s"], total - caps[None])
    for key, own in (("s", s), (None, rest)):
        have = sum(tokens[i] for (i, _) in taken if i in own)
        assert have <= budget[key]
        held = sum(tokens[i] for i in own)
        assert all((i, e) in taken for i in own for e in range(1, budget[key] // held + 1))
        # the next document in order did not fit
        assert budget[key] - have <= max(tokens[i] for i in own)


def test_mixing_keeps_columns_of_any_name(spark):
    plain = documents(spark, ["a b c", "d", None, "e f"])
    clashing = ["whole", "CUT", "left", "pieces", "budget", "held", "piece", "place", "reached", "before", "rows", "limit", "mix_epoch", "Mix_Tokens"]
    df = plain.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in clashing})
    levels, total = {"source": F.col("source")}, F.col("held") * 2
    kept = [c for c in df.columns if c not in ("mix_epoch", "Mix_Tokens")]
    got = mixing.mix(spark, df, levels, {}, total, max_epochs=2)
    assert got.columns == [*kept, "mix_epoch", "mix_tokens"]
    assert sorted((r.doc_id, r.whole, r.CUT, r.mix_epoch, r.mix_tokens) for r in got.collect()) == [
        (i, f"whole{i}", f"CUT{i}", e, n) for i, n in enumerate((3, 1, 0, 2)) for e in (1, 2)
    ]
    named = mixing.mix(spark, df, levels, {}, total, max_epochs=2, epoch_col="e", tokens_col="t")
    assert named.columns == [*df.columns, "e", "t"] and {r.Mix_Tokens for r in named.collect()} == {f"Mix_Tokens{i}" for i in range(4)}
    staged = corpus_pipeline.mixing_stage(spark, df, "")
    assert staged.columns == df.columns and all(r.mix_epoch == f"mix_epoch{r.doc_id}" for r in staged.collect())


def test_mixing_of_nothing(spark):
    got = mixing.mix(spark, documents(spark, []), {"source": F.col("source")}, {}, F.col("held"))
    assert got.collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = connect(SF)
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram jaccard join", "benchmark decontamination", "mixing sources", "sharding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, before = [], docs
    for name, stage in corpus_pipeline.STAGES:
        after = spark.createDataFrame(stage(spark, before, SF).toPandas())
        seen.append(after.count())
        if name != "sharding":
            assert sorted(after.columns) == sorted(docs.columns)
        before = after.select([F.col(c).cast(t) for c, t in docs.dtypes]) if name != "sharding" else after
    assert docs.count() > seen[0] > seen[1] > seen[2] > seen[3] == seen[4] > 0
    got = corpus_pipeline.run(spark, SF)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in before.select(got.columns).collect()}


def test_pipeline_of_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
