"""This part's registered queries: each operator over its whole table, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import chains, codes, decontam, extraction, jaccard, lines, mixing, quality, repeats, secrets, sharding, topk, trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZERS = "/opt/tokenizers"


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_html_extraction")
def html_extraction(spark, sf_dir):
    found = extraction.extract(spark, table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op2_secret_scans")
def secret_scans(spark, sf_dir):
    import public_tokenizers

    spans = secrets.secret_spans(spark, table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken", public_tokenizers.PATTERN)
    told = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return spans.select(
        F.col("id").alias("doc_id"),
        *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(F.array_join(F.transform(base, told), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", told), ",").alias("spans"),
    )


_OP3 = r"""
with words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
item_words as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null),
windows as (
  select distinct item_id, n, array_to_string(list_slice(w, i + 1, i + n), ' ') as window
  from (select item_id, w, least(10, len(w)) as n, unnest(range(len(w) - least(10, len(w)) + 1)) as i from item_words where len(w) > 0)),
sizes as (select distinct n from windows),
places as (
  select doc_id, n, i, array_to_string(list_slice(w, i + 1, i + n), ' ') as window
  from (select doc_id, w, n, unnest(range(len(w) - n + 1)) as i from words, sizes where len(w) >= n)),
found as (select p.doc_id, p.n, p.i, x.item_id from places p join windows x on p.n = x.n and p.window = x.window),
hits as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from (select distinct doc_id, i, n from found)) group by doc_id),
items as (
  select doc_id, count(*) as n_items, array_to_string(list_sort(list(item_id)), ',') as ids from (select distinct doc_id, item_id from found) group by doc_id)
select w.doc_id, coalesce(len(w.w), 0) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words w left join hits using (doc_id) left join items using (doc_id)
"""


@query("op3_benchmark_decontamination", _OP3)
def benchmark_decontamination(spark, sf_dir):
    found = decontam.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda t, s: t + s["last"] - s["first"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_OP4 = r"""
with recursive
docs as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
grams as (
  select distinct doc_id, gram from (
    select doc_id, array_to_string(list_slice(w, i + 1, i + least(4, len(w))), ' ') as gram
    from (select doc_id, w, unnest(range(len(w) - least(4, len(w)) + 1)) as i from docs where len(w) > 0))),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
common as (select gram from grams group by gram having count(*) > 1),
shared as (select doc_id, gram from grams semi join common using (gram)),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as m from shared a join shared b on a.gram = b.gram and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * m >= 85 * (x.n + y.n - m)),
edges as (select a, b from links union all select b, a from links),
reach as (select a as node, a as far from edges union select r.node, e.b from reach r join edges e on r.far = e.a)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(low, doc_id) as component_id
from docs left join sizes using (doc_id) left join (select node as doc_id, min(far) as low from reach group by node) using (doc_id)
"""


@query("op4_ngram_jaccard_join", _OP4)
def ngram_jaccard_join(spark, sf_dir):
    found = jaccard.near_duplicates(spark, table(spark, sf_dir, "documents"), length=4, percent=85)
    return found.withColumnRenamed("id", "doc_id")


@query("op5_quality_classifier")
def quality_classifier(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    net = quality.train(spark, documents, table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(spark, documents, net).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


_OP6 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id as vec_id, cast(list_dot_product(cast(a.q as double[]), cast(b.q as double[])) as bigint) as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id)
select query_id, cast(rank as int) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 10
"""


@query("op6_exact_top_k", _OP6)
def exact_top_k(spark, sf_dir):
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op7_substring_dedup")
def substring_dedup(spark, sf_dir):
    return chains.passages(spark, table(spark, sf_dir, "documents"))


@query("op8_sharding")
def sharded(spark, sf_dir):
    placed = sharding.shard(spark, table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("bigint"),
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


@query("op9_suffix_array_dedup")
def suffix_array_dedup(spark, sf_dir):
    cut = repeats.deduplicate(spark, table(spark, sf_dir, "documents"))
    n = F.aggregate("removed", F.lit(0).cast("bigint"), lambda t, s: t + s["last"] - s["first"])
    return cut.select(
        F.col("id").alias("doc_id"), "n_bytes", n.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


#: Weights of the trial's tree: sources in four domains, languages in each; all sources of a language weigh the same.
WEIGHTS = {"domain": {"d0": 40, "d1": 30, "d2": 20, "d3": 10}, "lang": {"en": 55, "de": 20, "fr": 15, "es": 10}}


def levels() -> dict:
    number = F.regexp_extract("source", "[0-9]+", 0)
    return {"domain": F.concat(F.lit("d"), number.try_cast("int") % 4), "lang": F.col("lang"), "source": F.col("source")}


def _poured(level: str, above: list[str], parent: str, weight: str) -> str:
    """SQL of one level: the budgets of the children of ``parent``."""
    nodes = ", ".join([*above, level])
    family = f"partition by {', '.join(above)}" if above else ""
    join = f"join {parent} using ({', '.join(above)})" if above else f"cross join {parent}"
    return f"""
  b_{level} as (
    select {nodes}, least(cap, cast(floor(weight * max(reach) over ({family})) as bigint)) as budget
    from (
      select *, cast(budget - coalesce(sum(cap) over ({family} order by cap / weight, {level} rows between unbounded preceding and 1 preceding), 0) as double)
        / cast(sum(weight) over ({family} order by cap / weight, {level} rows between current row and unbounded following) as double) as reach
      from (select {nodes}, cast(sum(cap) as bigint) as cap, {weight} as weight from leaves group by all) {join}))"""


def _case(level: str) -> str:
    return f"case {level} " + " ".join(f"when '{k}' then {v}" for k, v in WEIGHTS[level].items()) + " else 1 end"


_OP10 = f"""
with docs as (
  select doc_id, lang, source, 'd' || (try_cast(regexp_extract(source, '[0-9]+') as int) % 4) as domain,
    len(regexp_extract_all(text, '[^ \t\n\r\f\x0B]+')) as n_tokens
  from documents),
leaves as (select domain, lang, source, cast(sum(n_tokens) as bigint) as held, cast(sum(n_tokens) * 3 as bigint) as cap from docs group by all),
root as (select cast(floor(sum(held) * 8 / 10) as bigint) as budget from leaves),
{_poured("domain", [], "root", _case("domain"))},
{_poured("lang", ["domain"], "b_domain", _case("lang"))},
{_poured("source", ["domain", "lang"], "b_lang", "1")},
plan as (
  select l.*, budget, cast(floor(budget / held) as int) as whole, budget - cast(floor(budget / held) as int) * held as rest
  from leaves l join b_source using (domain, lang, source)),
ordered as (
  select d.*, whole, rest, sum(n_tokens) over (partition by domain, lang, source order by md5(concat_ws('|', 17, whole + 1, doc_id))) as reached
  from docs d join plan using (domain, lang, source))
select doc_id, domain, lang, source, cast(epoch as int) as epoch, n_tokens
from (select *, unnest(range(1, whole + 1 + cast(reached <= rest as int))) as epoch from ordered)
"""


@query("op10_mixing_sources", _OP10)
def mixing_sources(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    mixed = mixing.mix(spark, documents, levels(), WEIGHTS, F.floor(F.col("held") * 8 / 10), max_epochs=3, seed=17)
    return mixed.select("doc_id", levels()["domain"].alias("domain"), "lang", "source", F.col("mix_epoch").alias("epoch"), F.col("mix_tokens").alias("n_tokens"))


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::bigint)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)))"""

_OP11 = rf"""
with own as (
  select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id),
rebuilt as (
  select o.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, h), list_slice(o.turns, h + 1, len(o.turns))) as path
  from (select *, {_CRC32} % 4 as h from own) o left join own b on b.conv_id = o.conv_id - o.conv_id % 20),
nodes as (
  select list_slice(path, 1, d) as path, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
    list(conv_id order by conv_id) filter (len(path) = d) as ends
  from (select *, unnest(range(len(path) + 1)) as d from rebuilt) group by 1, 2),
family as (
  select v.path, v.depth, count(*) filter (u.depth = v.depth + 1) as n_children,
    sum((u.n_convs - 1) * case when u.depth = 0 then 0 else len(regexp_extract_all(u.path[-1].text, '[^\x20\x09-\x0D]+')) end) as saved_tokens
  from nodes v join nodes u on u.depth >= v.depth and list_slice(u.path, 1, v.depth) = v.path group by 1, 2),
leaves as (
  select v.path, v.depth, count(*) as n_leaves
  from nodes v join (select n.* from nodes n join family f using (path, depth) where f.n_children = 0) u
    on u.depth >= v.depth and list_slice(u.path, 1, v.depth) = v.path group by 1, 2)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, f.n_children, l.n_leaves, cast(f.saved_tokens as bigint) as saved_tokens,
  sha256(coalesce(array_to_string(n.ends, ','), '')) as ends_sha256
from nodes n join family f using (path, depth) join leaves l using (path, depth)
  left join nodes p on p.depth = n.depth - 1 and p.path = list_slice(n.path, 1, n.depth - 1)
"""


@query("op11_conversation_prefix_trie", _OP11)
def conversation_prefix_trie(spark, sf_dir):
    turns = trie.turns(table(spark, sf_dir, "conversations"))
    first = F.crc32(F.col("conv_id").cast("string")) % 4
    grafted = trie.grafted(spark, turns, onto=F.col("conv_id") - F.col("conv_id") % 20, first=first, most=3)
    return trie.prefix_trie(spark, grafted)


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP12 = f"""
with docs as (select row_number() over () as row, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
placed as (
  select row, doc_id, i, lines[i] as line, trim(translate(lines[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_SPACES}) as key
  from (select *, unnest(range(1, len(lines) + 1)) as i from docs)),
shared as (select key from (select distinct row, key from placed) where len(key) >= 1 group by key having count(*) >= 10)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(s.key) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (s.key is null), '')) as kept_sha256
from placed p left join shared s using (key) group by row
"""


@query("op12_line_dedup", _OP12)
def line_dedup(spark, sf_dir):
    kept = lines.drop_shared_lines(spark, table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def _assigned(name: str, book: str) -> str:
    """SQL of an assignment: the nearest entry of each part, and its squared distance."""
    return f"""
{name} as materialized (
  select vec_id, part, any_value(x) as x, min(struct_pack(d := d, j := j)) as best
  from (select p.vec_id, p.part, p.x, b.j, list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, b.c) + list_dot_product(b.c, b.c) as d from parts p join {book} b using (part))
  group by vec_id, part)"""


def _moved(name: str, book: str, assigned: str) -> str:
    """SQL of an update: each used entry becomes the floor of its parts' mean."""
    return f"""
{name} as materialized (
  select b.part, b.j, coalesce(m.c, b.c) as c from {book} b left join (
    select part, j, list(floor(s / n) order by i) as c
    from (select part, best.j as j, i, sum(x[i]) as s, count(*) as n from (select *, unnest(range(1, len(x) + 1)) as i from {assigned}) group by all) group by part, j) m using (part, j))"""


_OP13 = f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (select vec_id, part, list_slice(v, part * len(v) // 4 + 1, (part + 1) * len(v) // 4) as x from kept, range(4) t(part)),
first as (select vec_id, row_number() over (order by vec_id) - 1 as j from kept qualify j < 256),
book0 as materialized (select part, j, x as c from parts join first using (vec_id)),
{",".join(_assigned(f"near{i}", f"book{i}") + "," + _moved(f"book{i + 1}", f"book{i}", f"near{i}") for i in range(4))},
{_assigned("near4", "book4")},
coded as (
  select vec_id, array_to_string(list(printf('%02x', best.j) order by part), '') as code, cast(sum(best.d) as bigint) as error from near4 group by vec_id),
book as (select sha256(string_agg(cast(cast(c[i] as bigint) as varchar), ',' order by part, j, i)) as codebooks_sha256 from (select *, unnest(range(1, len(c) + 1)) as i from book4))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded join kept using (vec_id) cross join book
"""


@query("op13_vector_code_compression", _OP13)
def vector_code_compression(spark, sf_dir):
    coded, books = codes.compress(spark, table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
    total = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    told = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("bigint")), 2, "0"))), "")
    return coded.join(total, F.col("label").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias("vec_id"), told.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
