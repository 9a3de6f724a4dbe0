"""Joins, unions and configuration tables. Configuration rows are made of the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from quayside.operators import configs, dedup, filters, lookups, sets, widening
from quayside.queries.filters import _cycles
from quayside.queries.register import query, table
from quayside.session import scratch_path


@query(
    "facts_for_keys",
    """with cycles as (
         select o_orderkey id from orders
         where o_orderkey % 13 <> 0 and o_orderdate::date >= date '2000-07-01' - 47)
       select 'answers' fact, l_orderkey::varchar id, l_partkey as "item", l_quantity as score from lineitem
       where l_returnflag <> 'R' and l_orderkey in (select id from cycles)
       union all
       select 'ratings', l_orderkey::varchar, l_partkey, l_discount from lineitem
       where l_returnflag = 'R' and l_orderkey in (select id from cycles)""",
)
def facts_for_keys(spark, sf_dir):
    cycles = filters.eligible_cycles(_cycles(spark, sf_dir, "o_orderkey"), date(2000, 7, 1), "o_orderkey")
    lines = table(spark, sf_dir, "lineitem").withColumn("id", F.col("l_orderkey").cast("string"))
    returned = F.col("l_returnflag") == "R"
    answers = lines.filter(~returned).select("id", F.col("l_partkey").alias("item"), F.col("l_quantity").alias("score"))
    ratings = lines.filter(returned).select("id", F.col("l_partkey").alias("item"), F.col("l_discount").alias("score"))
    return lookups.facts_of_kinds({"answers": answers, "ratings": ratings}, cycles, "id")


@query(
    "lookup_config",
    """select o_orderkey, c_name, c_mktsegment, c_custkey is not null as matched
       from orders left join (select * from customer where c_mktsegment <> 'MACHINERY') on o_custkey = c_custkey""",
)
def lookup_config(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    known = customers.filter(F.col("c_mktsegment") != "MACHINERY")
    matched, rejected = lookups.lookup(orders, known, ["c_custkey"], strict=False)
    matched = matched.withColumn("matched", F.lit(True))
    rejected = rejected.withColumn("matched", F.lit(False))
    return sets.union_drifting([matched, rejected]).drop("c_custkey")


@query(
    "positional_concat",
    """select position, c_name, c_acctbal, s_name, s_acctbal from
         (select row_number() over (order by c_acctbal desc, c_custkey) as position, c_name, c_acctbal from customer)
         full join
         (select row_number() over (order by s_suppkey) as position, s_name, s_acctbal from supplier)
         using (position)""",
)
def positional_concat(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_name", "c_acctbal", (-F.col("c_acctbal")).alias("_down"), F.col("c_custkey").alias("_key")
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_name", "s_acctbal", F.col("s_suppkey").alias("_skey"))
    side_by_side = dedup.positional_concat(customers, suppliers, ["_down", "_key"], ["_skey"])
    return side_by_side.select(F.col("position"), "c_name", "c_acctbal", "s_name", "s_acctbal")


@query(
    "union_batches",
    """select c_custkey as "key", c_name as name, c_acctbal as balance from customer
       union all select s_suppkey, s_name, s_acctbal from supplier""",
)
def union_batches(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey key", "c_name name", "c_acctbal balance")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_acctbal balance", "s_suppkey key", "s_name name")
    return sets.union_batches([customers, suppliers])


@query(
    "union_drifting",
    """select c_custkey as "key", c_name as name, c_mktsegment as segment, null::integer as nation from customer
       union all select s_suppkey, s_name, null, s_nationkey from supplier""",
)
def union_drifting(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey key", "c_name name", "c_mktsegment segment")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey key", "s_name name", "s_nationkey nation")
    return sets.union_drifting([customers, suppliers])


def _event_batches(spark, sf_dir):
    """Three batches of one collection: a column is a whole number, then text, then a decimal; a record gains and widens fields."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    third = F.col("event_id") % 3
    first = events.filter(third == 0).select("event_id", F.col("user_id").cast("int").alias("who"), F.struct("k").alias("props"), F.array(F.col("k")).alias("ks"))
    second = events.filter(third == 1).select(
        "event_id",
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("who"),
        F.struct(F.col("k").cast("bigint").alias("k"), F.lit("new").alias("kind")).alias("props"),
        F.array(F.col("k").cast("bigint") * 10_000_000_000).alias("ks"),
    )
    third = events.filter(third == 2).select(F.col("user_id").cast("decimal(12,2)").alias("who"), F.col("event_id").cast("int").alias("EVENT_ID"))
    return [first, second, third]


_DRIFTED = """
  select event_id, case event_id % 3 when 0 then user_id::varchar when 1 then 'u' || user_id else user_id::decimal(12,2)::varchar end as who,
         case when event_id % 3 < 2 then json_extract_string(props, '$.k')::bigint end as k, case when event_id % 3 = 1 then 'new' end as kind,
         case event_id % 3 when 0 then json_extract_string(props, '$.k')::bigint when 1 then json_extract_string(props, '$.k')::bigint * 10000000000 end as top
  from events"""


def _opened(df, *more):
    return df.select("event_id", "who", F.col("props.k").alias("k"), F.col("props.kind").alias("kind"), F.get("ks", F.lit(0)).alias("top"), *more)


@query(
    "union_drifting_types",
    f"""with widened(change) as (values ('who 0 int string'), ('who 2 decimal(12,2) string'), ('props.k 0 int bigint'), ('ks[] 0 int bigint'), ('event_id 2 int bigint'))
        select *, null::varchar as change from ({_DRIFTED}) union all select null, null, null, null, null, change from widened""",
)
def union_drifting_types(spark, sf_dir):
    """Batches whose types drift side by side, and each widening."""
    rows, changes = widening.union_widening(_event_batches(spark, sf_dir))
    told = spark.createDataFrame([(f"{c.column} {c.batch} {c.given} {c.became}",) for c in changes], "change string")
    return _opened(rows).unionByName(told, allowMissingColumns=True)


@query("scan_drifting", f"select *, (event_id % 3 + 1)::int as batch from ({_DRIFTED})")
def scan_drifting(spark, sf_dir):
    """The same batches as folders of one landing, which no one schema could read."""
    path = scratch_path(spark, "drifting")
    for i, batch in enumerate(_event_batches(spark, sf_dir)):
        batch.write.parquet(f"{path}/batch={i + 1}")
    return _opened(widening.scan_drifting(spark, path)[0], "batch")


def migration_config(spark, sf_dir):
    """A migration row per customer, a third of them not built yet."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("dbo.t"), key.cast("string")).alias("source_table_name"),
        F.lower("c_name").alias("target_table_name"),
        F.when(key % 2 == 0, "INCREMENTAL").otherwise("FULL").alias("migration_type"),
        F.when(key % 3 == 0, 0).otherwise(1).alias("flag_table_created"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.concat(F.lit("file "), key.cast("string"), F.lit(".xlsx")).alias("source_file_name"),
        F.col("c_mktsegment").alias("sheet_name"),
    )


@query(
    "pending_config",
    """select 'dbo.t' || c_custkey source_table_name, lower(c_name) target_table_name,
              case when c_custkey % 2 = 0 then 'INCREMENTAL' else 'FULL' end migration_type
       from customer where c_custkey % 3 = 0 and c_custkey in (select o_custkey from orders where o_orderstatus = 'P')""",
)
def pending_config(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    names = wanted.select(F.concat(F.lit("dbo.t"), F.col("o_custkey").cast("string")).alias("name"))
    rows = configs.pending_config(migration_config(spark, sf_dir), names)
    return rows.select("source_table_name", "target_table_name", "migration_type")


@query(
    "active_config",
    """select 'file ' || c_custkey || '.xlsx' source_file_name, c_mktsegment sheet_name,
              case when c_custkey % 3 = 0 then 0 else 1 end flag_table_created from customer where c_acctbal > 0""",
)
def active_config(spark, sf_dir):
    rows = configs.active_config(migration_config(spark, sf_dir))
    return rows.select("source_file_name", "sheet_name", "flag_table_created")


@query(
    "mark_processed",
    """select lower(c_name) target_table_name,
              case when c_custkey % 3 <> 0 or c_custkey in (select o_custkey from orders where o_orderstatus = 'P')
                   then 1 else 0 end flag_table_created from customer""",
)
def mark_processed(spark, sf_dir):
    handled = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    done = handled.select(F.format_string("customer#%09d", "o_custkey").alias("target_table_name"))
    marked = configs.mark_processed(migration_config(spark, sf_dir), done)
    return marked.select("target_table_name", "flag_table_created")
