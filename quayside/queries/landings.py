"""Whole landings over the given tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from quayside.plans import landings
from quayside.plans.publish import CSV_OPTIONS, replace_partition
from quayside.queries.nested import products, scanned_products
from quayside.queries.register import RUN_ID, RUN_TS, query, table
from quayside.session import scratch_path
from quayside.sources.tables import external_table

COLLECTIONS = """
    source_table_name string, target_dataset string, target_table_name string, pipeline_type string,
    filter_column string, projection string, mongo_query string, active boolean
"""


@query(
    "collection_run",
    f"""select 'events' collection, event_id::varchar "key", user_id::varchar b, props c, '{RUN_ID}' id_execucao, 'ok' status
        from events where ts >= timestamp '2024-01-14' and ts < timestamp '2024-01-25' and event_type <> 'error'
        union all
        select 'orders', o_custkey::varchar, count(*)::varchar, null, '{RUN_ID}', 'ok' from orders group by o_custkey
        union all
        select 'pages', null, null, null, null, 'failed'""",
)
def collection_run(spark, sf_dir):
    landing, bronze = scratch_path(spark, "collections"), scratch_path(spark, "bronze")
    events = table(spark, sf_dir, "events").withColumn("deleted", F.col("event_type") == "error")
    # the bronze table reaches to the 15th, so the extract starts on the 14th
    known = events.filter(F.col("ts") < F.lit(datetime(2024, 1, 16))).select("event_id", F.to_date("ts").alias("DT"))
    replace_partition(known, f"{bronze}/app/events", "DT")
    free = "select o_custkey, count(*) as n from {collection} group by o_custkey"
    config = spark.createDataFrame(
        [
            ("events", "app", "events", "STANDARD", "ts", '["user_id", "props"]', None, True),
            ("orders", "app", "orders", "FREE", None, None, free, True),
            ("pages", "app", "pages", "OTHER", None, None, None, True),
            ("part", "app", "part", "STANDARD", None, None, None, False),
        ],
        COLLECTIONS,
    )
    source = {"events": events, "orders": table(spark, sf_dir, "orders"), "pages": table(spark, sf_dir, "pages")}
    report = landings.run_collections(
        spark, config, source.__getitem__, landing, bronze, RUN_TS, end="2024-01-25", key="event_id"
    )
    landed_events = external_table(spark, f"{landing}/events").selectExpr(
        "'events' as collection", "event_id as key", "user_id as b", "props as c", "id_execucao"
    )
    landed_orders = external_table(spark, f"{landing}/orders").selectExpr(
        "'orders' as collection", "o_custkey as key", "n as b", "cast(null as string) as c", "id_execucao"
    )
    status = report.select(F.col("source").alias("collection"), "status")
    return status.join(landed_events.unionByName(landed_orders), "collection", "left")


@query(
    "drop_landing",
    f"""select c_custkey::varchar "key", case when c_custkey % 2 = 0 then c_name end c_name,
               case when c_custkey % 2 = 1 then c_mktsegment end c_mktsegment,
               case when c_custkey % 2 = 0 then 'json' else 'csv' end source_file,
               '2025-03-10 01:45:30' dt_ingestao, '{RUN_ID}' id_execucao, '2025-03-10' dt from customer""",
)
def drop_landing(spark, sf_dir):
    drop, target = scratch_path(spark, "transient"), scratch_path(spark, "landing")
    customers = table(spark, sf_dir, "customer").withColumn("key", F.col("c_custkey"))
    even = F.col("c_custkey") % 2 == 0
    customers.filter(even).select("key", "c_name").write.json(f"{drop}/2025-03-10")
    customers.filter(~even).select("c_mktsegment", "key").write.csv(f"{drop}/2025-03-10", header=True, mode="append")
    for _ in range(2):  # a second run of the day replaces the first
        landings.land_drop(spark, drop, date(2025, 3, 10), target, RUN_TS)
    rows = external_table(spark, target)
    # the files' names are made by Spark; what counts is that each row has the one it came from
    json = F.col("source_file").endswith(".json")
    return rows.withColumn("source_file", F.when(json, "json").otherwise(F.regexp_extract("source_file", r"([^.]+)$", 1)))


@query(
    "products_landing",
    """select 'id-' || p_partkey "_id", p_partkey sku, p_name "displayName", 'P' || i pbmspbm,
              p_retailprice + i "ValorMaximo",
              case when (p_partkey + i) % 5 <> 0 then p_retailprice * i end "PMC", '2025-03-09 22:45:30' dt_ingestao
       from part left join generate_series(1, 3) g(i) on i <= p_partkey % 4""",
)
def products_landing(spark, sf_dir):
    path = scratch_path(spark, "products")
    landings.land_products(products(spark, sf_dir), path, RUN_TS)
    schema = """_id string, sku bigint, code string, pbm string, pbmspbm string, displayName string, pbmsdisplayName string,
        ValorBase double, ValorMaximo double, Desconto double, PorcentagemDesconto double, maximumPrice double, PMC double,
        dt_ingestao timestamp_ntz"""
    rows = spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
    return rows.select("_id", "sku", "displayName", "pbmspbm", "ValorMaximo", "PMC", "dt_ingestao")


@query(
    "offers_landing",
    """select o_orderkey::varchar "SKU", case when i = 1 then 'Shop' || o_custkey
                 else replace(upper(o_orderpriority[1]) || lower(o_orderpriority[2:]), '-', '') end raw_name,
              case when i = 1 then '[{"name":"ã","id":' || o_custkey || '}]' else '[]' end "SELLERS",
              o_totalprice "PRICE", '2025-03-09' dt
       from orders join generate_series(1, 2) g(i) on i <= o_orderkey % 3 where o_orderkey % 11 <> 0""",
)
def offers_landing(spark, sf_dir):
    path = scratch_path(spark, "offers")
    scan = F.array(F.struct(*scanned_products(spark, sf_dir).columns))
    body = F.to_json(F.struct(F.struct(scan.alias("scan")).alias("data")))
    landings.land_offers(scanned_products(spark, sf_dir).select(body.alias("body")), path, RUN_TS)
    rows = external_table(spark, path, "csv")
    # the priorities are no names: their words are compared without the case a title gives them
    name = F.col("CONCORRENTE")
    seller = F.concat(F.upper(F.left(name, F.lit(1))), F.lower(F.substr(name, F.lit(2))))
    return rows.select(
        "SKU",
        F.when(F.col("DOMAIN") != "", name).otherwise(seller).alias("raw_name"),
        "SELLERS",
        F.col("PRICE").cast("double").alias("PRICE"),
        F.col("dt").cast("string").alias("dt"),
    )


SURVEY_SCHEMAS = {
    "cycle": "id bigint, cycleEndDate string",
    "answers": "cycle bigint, updatedAt timestamp_ntz, score double, item struct<part: bigint>",
    "deletions": "id bigint",
}


@query(
    "survey_landing",
    """with c as (select o_orderkey from orders where o_orderdate::date >= date '2001-07-01' - 47)
       select 'cycle' entity, o_orderkey "key", null::bigint part, null::double score, null::varchar raw from orders where o_orderkey % 5 <> 0
       union all
       select 'cycle', null, null, null, 'gone' from orders where o_orderkey % 5 = 0
       union all
       select 'answers', l_orderkey, l_partkey, case when l_linenumber <> 5 then l_quantity end,
              case when l_linenumber in (5, 6) then
                '{"cycle":' || l_orderkey || ',"updatedAt":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
                || case when l_linenumber % 2 = 0 then 'Z' else '+00:00' end || '","score":'
                || case when l_linenumber = 5 then '"n/d"' else l_quantity::varchar end || ',"item":{"part":' || l_partkey || '}'
                || case when l_linenumber = 6 then ',"more":{"flag":"' || l_returnflag || '"}' else '' end || '}' end
       from lineitem
       where l_shipdate >= timestamp '2001-06-29' and l_shipdate < timestamp '2001-07-06'
         and l_orderkey in (select o_orderkey from c where o_orderkey % 5 <> 0)
       union all
       select 'deletions', s_suppkey, null, null, null from supplier""",
)
def survey_landing(spark, sf_dir):
    root = scratch_path(spark, "survey")

    def documents(df, *fields):
        record = F.to_json(F.struct(*fields))
        return df.select(F.concat(F.lit('{"payload": ['), record, F.lit("]}")).alias("body"))

    end = F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'").alias("cycleEndDate")
    orders = table(spark, sf_dir, "orders")
    good = F.col("o_orderkey") % 5 != 0
    cycles = documents(orders.filter(good), F.col("o_orderkey").alias("id"), end).unionByName(
        orders.filter(~good).select(F.lit('{"payload": ["gone"]}').alias("body"))
    )
    lines = table(spark, sf_dir, "lineitem")
    moment = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("l_linenumber") % 2 == 0, "Z").otherwise("+00:00"))
    fields = [
        F.col("l_orderkey").alias("cycle"), moment.alias("updatedAt"), F.col("l_quantity").alias("score"),
        F.struct(F.col("l_partkey").alias("part")).alias("item"),
    ]
    # a value of another type in line 5, a field that is not listed in line 6: such records keep their text
    wrong = F.struct(*fields[:2], F.lit("n/d").alias("score"), fields[3])
    wider = F.struct(*fields, F.struct(F.col("l_returnflag").alias("flag")).alias("more"))
    line = F.col("l_linenumber")
    record = F.when(line == 5, F.to_json(wrong)).when(line == 6, F.to_json(wider)).otherwise(F.to_json(F.struct(*fields)))
    answers = lines.select(F.concat(F.lit('{"payload": ['), record, F.lit("]}")).alias("body"))
    deletions = documents(table(spark, sf_dir, "supplier"), F.col("s_suppkey").alias("id"))
    landings.land_survey(
        spark,
        {"cycle": cycles, "answers": answers, "deletions": deletions},
        SURVEY_SCHEMAS,
        root,
        datetime(2001, 7, 1, 6),
        {"answers": "cycle"},
        order="id",
    )

    def landed(entity, key, part, score):
        kept = [F.lit(entity).alias("entity"), F.col(key).alias("key"), part.alias("part"), score.alias("score")]
        return external_table(spark, f"{root}/{entity}").select(*kept, F.col("_raw").alias("raw"))

    none = F.lit(None)
    cycle = landed("cycle", "id", none.cast("bigint"), none.cast("double"))
    answer = landed("answers", "cycle", F.col("item.part"), F.col("score"))
    deletion = landed("deletions", "id", none.cast("bigint"), none.cast("double"))
    return cycle.unionByName(answer).unionByName(deletion)


@query(
    "gz_landing",
    f"""select p_partkey::bigint sku, case when p_partkey % 7 <> 0 then p_retailprice end price, p_brand brand, '2025-03-07' dt, 
              (select count(*) from part where p_partkey % 7 = 0) rejected from part""",
)
def gz_landing(spark, sf_dir):
    """Two gzip layouts of one day, the columns swapped, into the landing zone; the day is three days back."""
    root = scratch_path(spark, "zones")
    price = F.when(F.col("p_partkey") % 7 == 0, "n/d").otherwise(F.col("p_retailprice").cast("string")).alias("price")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sku"), price, F.col("p_brand").alias("brand"))
    text = {"sep": "|", "quote": "", "escape": "", "header": True, "compression": "gzip"}
    folder = f"{root}/transient/prices/dt=2025-03-07"
    parts.filter("sku % 2 = 0").write.csv(folder, **text)
    parts.filter("sku % 2 = 1").select("brand", "sku", "price").write.mode("append").csv(folder, **text)
    _, rejected = landings.land_gz(spark, f"{root}/transient/prices", {"sku": "INTEGER", "price": "FLOAT", "brand": "STRING"}, RUN_TS)
    return external_table(spark, f"{root}/landing/prices").withColumn("rejected", F.lit(rejected).cast("bigint"))


@query(
    "period_landing",
    f"""select s_suppkey::varchar codigo, s_name nome, '2025-03-10 01:45:30' dt_ingestao, '{RUN_ID}' id_execucao, '2025-03-09' dt, 'mensal' period from supplier""",
)
def period_landing(spark, sf_dir):
    """A text file of fixed layout whose name says its period; a second run of the day replaces the first."""
    root = scratch_path(spark, "fixed")
    path = f"{root}/transient/RPE_117_BASE.txt"
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("codigo"), F.col("s_name").alias("nome"))
    rows.write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    for _ in range(2):
        landings.land_period(spark, path, f"{root}/landing", RUN_TS)
    return external_table(spark, f"{root}/landing/mensal").withColumn("period", F.lit("mensal"))
