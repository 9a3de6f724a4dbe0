"""Nested records. The documents are made of the given rows, one at a time: nothing is gathered."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from quayside.operators import nested
from quayside.plans.publish import bounded_files
from quayside.queries.register import query, table
from quayside.session import scratch_path
from quayside.sources.documents import scan_envelope


def upto(n, last_index_sql_type: str = "int"):
    """The array 1..n, empty for n = 0."""
    empty = F.array().cast(f"array<{last_index_sql_type}>")
    return F.when(n > 0, F.sequence(F.lit(1).cast(last_index_sql_type), n.cast(last_index_sql_type))).otherwise(empty)


def products(spark, sf_dir):
    """A product per part, with none to three programmes; some prices are no record."""
    key = F.col("p_partkey")

    def program(i):
        price = F.when(
            (key + i) % 5 != 0,
            F.to_json(F.struct((F.col("p_retailprice") * 2).alias("maximumPrice"), (F.col("p_retailprice") * i).alias("PMC"))),
        ).when((key + i) % 10 == 0, F.lit("unavailable"))
        data = F.struct(
            F.col("p_retailprice").alias("ValorBase"),
            (F.col("p_retailprice") + i).alias("ValorMaximo"),
            i.cast("double").alias("Desconto"),
            (i / 4).alias("PorcentagemDesconto"),
            price.alias("price"),
        )
        return F.struct(
            F.concat(F.lit("P"), i.cast("string")).alias("pbm"),
            F.concat("p_brand", F.lit("/"), i.cast("string")).alias("displayName"),
            data.alias("data"),
        )

    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("id-"), key.cast("string")).alias("_id"),
        key.cast("string").alias("sku"),
        F.col("p_size").cast("string").alias("code"),
        F.lit("pbm").alias("pbm"),
        F.col("p_name").alias("displayName"),
        F.transform(upto(key % 4), program).alias("pbms"),
    )


@query(
    "flatten_programs",
    """select 'id-' || p_partkey "_id", p_partkey::varchar sku, p_size::varchar code, 'pbm' pbm, 'P' || i pbmspbm,
              p_name "displayName", p_brand || '/' || i "pbmsdisplayName",
              case when i is not null then p_retailprice end "ValorBase", p_retailprice + i "ValorMaximo",
              i::double "Desconto", i / 4.0::double "PorcentagemDesconto",
              case when (p_partkey + i) % 5 <> 0 then p_retailprice * 2 end "maximumPrice",
              case when (p_partkey + i) % 5 <> 0 then p_retailprice * i end "PMC"
       from part left join generate_series(1, 3) g(i) on i <= p_partkey % 4""",
)
def flatten_programs(spark, sf_dir):
    return nested.flatten_programs(products(spark, sf_dir))


def scanned_products(spark, sf_dir):
    """A scanned product per order, offered by none to two domains; every eleventh has no scan at all."""
    key = F.col("o_orderkey")

    def offer(i):
        return F.struct(
            F.when(i == 1, F.concat(F.lit(" www.shop"), F.col("o_custkey").cast("string"), F.lit(".com\t"))).alias("domain"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_occurrence"),
            (i == 1).alias("availability"),
            F.col("o_totalprice").alias("price"),
            (F.col("o_totalprice") - i).alias("offer_price"),
            F.col("o_orderpriority").alias("sold_by"),
            F.when(i == 1, F.array(F.struct(F.lit("ã").alias("name"), F.col("o_custkey").alias("id")))).alias("sellers"),
        )

    scan = F.struct(F.transform(upto(key % 3), offer).alias("data"))
    return table(spark, sf_dir, "orders").select(
        key.alias("sku"),
        F.when(key % 2 == 0, F.col("o_orderstatus")).alias("reference_code"),
        F.when(key % 11 != 0, scan).alias("last_scan"),
    )


COLLECTED_AT = datetime(2025, 3, 10, 8, 0, 0)


@query(
    "flatten_offers",
    """select '2025-03-10 08:00:00' data_coleta_preco, o_orderkey "SKU",
              case when o_orderkey % 2 = 0 then o_orderstatus else '' end "REFERENCE_CODE",
              case when i = 1 then 'www.shop' || o_custkey || '.com' else '' end "DOMAIN",
              strftime(o_orderdate, '%Y-%m-%d') "DATE_OCCURRENCE", i = 1 "AVAILABILITY", o_totalprice "PRICE",
              o_totalprice - i "OFFER_PRICE", o_orderpriority "SOLD_BY",
              case when i = 1 then '[{"name":"ã","id":' || o_custkey || '}]' else '[]' end "SELLERS",
              null::varchar pack_price, null::varchar pack_info, null::varchar fator, null::varchar factor_price,
              null::varchar factor_offer_price, null::varchar from_price
       from orders join generate_series(1, 2) g(i) on i <= o_orderkey % 3 where o_orderkey % 11 <> 0""",
)
def flatten_offers(spark, sf_dir):
    return nested.flatten_offers(scanned_products(spark, sf_dir), COLLECTED_AT)


@query(
    "nested_to_json",
    """select event_id, '{"k":' || json_extract_string(props, '$.k') || '}' props,
              case when event_id % 3 = 0 then '[]' else '["' || event_type || '",' || '"é"]' end tags from events""",
)
def nested_to_json(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k int").alias("props"),
        F.when(F.col("event_id") % 3 != 0, F.array("event_type", F.lit("é"))).alias("tags"),
    )
    return nested.json_text(rows, "props").withColumn("tags", nested.json_array_text(F.col("tags")))


@query(
    "normalize_scalars",
    """select 'oid-' || event_id "_id", strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') ts,
              strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') at_hour, ts::date::varchar as "day",
              value, user_id, '{"k":' || json_extract_string(props, '$.k') || '}' props from events""",
)
def normalize_scalars(spark, sf_dir):
    oid = F.struct(F.concat(F.lit("oid-"), F.col("event_id").cast("string")).alias("$oid"))
    rows = table(spark, sf_dir, "events").select(
        oid.alias("_id"),
        "ts",
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("at_hour"),
        F.col("ts").cast("date").alias("day"),
        "value",
        "user_id",
        F.from_json("props", "k int").alias("props"),
    )
    return nested.normalize_scalars(rows)


@query(
    "land_nested",
    """select o_orderkey, o_orderstatus as status, o_totalprice as total, (o_orderkey % 4)::int as n_lines,
              case when o_orderkey % 4 > 0 then o_custkey + 1 end as first_line from orders""",
)
def land_nested(spark, sf_dir):
    path = scratch_path(spark, "nested")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_totalprice").alias("total")).alias("sum")).alias("head"),
        F.transform(
            upto(F.col("o_orderkey") % 4), lambda i: F.struct((F.col("o_custkey") + i).alias("line"))
        ).alias("lines"),
    )
    bounded_files(rows, path)
    first = F.get("lines", F.lit(0))["line"].alias("first_line")
    return spark.read.parquet(path).select(
        "o_orderkey", "head.status", "head.sum.total", F.size("lines").alias("n_lines"), first
    )


@query(
    "raw_fallback",
    """select case when o_orderkey % 3 = 0 then o_orderkey end "order", case when o_orderkey % 3 = 0 then 1 end id,
              case when o_orderkey % 3 = 1 then o_orderpriority when o_orderkey % 3 = 2 then o_custkey::varchar end _raw
       from orders""",
)
def raw_fallback(spark, sf_dir):
    third = F.col("o_orderkey") % 3
    record = F.to_json(F.struct(F.col("o_orderkey").alias("order"), F.lit(1).alias("id")))
    text = F.concat(F.lit('"'), "o_orderpriority", F.lit('"'))
    element = F.when(third == 0, record).when(third == 1, text).otherwise(F.col("o_custkey").cast("string"))
    documents = table(spark, sf_dir, "orders").select(
        F.concat(F.lit('{"payload": ['), element, F.lit("]}")).alias("body")
    )
    return nested.raw_fallback(scan_envelope(documents), "element", "order bigint, id int")


