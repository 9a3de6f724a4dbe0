"""Names, column subsets, audit columns and the landing schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions import names
from quayside.operators import audit, casting
from quayside.plans.hooks import ORDER_COLUMNS, common_chain, custom_transform, keep_first
from quayside.queries.register import RUN_ID, RUN_TS, as_text, query, table
from quayside.sources import columns


@query(
    "normalize_names",
    """select c_custkey "CODIGO_DO_CLIENTE", c_name "NOMERAZAO", c_acctbal "SALDO_R", c_mktsegment "SEGMENTO_1" from customer""",
)
def normalize_names(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return names.normalize_names(rows.toDF(" Código do  Cliente ", "Nome/Razão:", "Saldo (R$)", "segmento_1"))


@query(
    "sanitize_names",
    """select c_custkey "_id__oid", c_name "profile_name", c_acctbal "bal_x", c_mktsegment "seg" from customer""",
)
def sanitize_names(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return names.sanitize_names(rows.toDF("_id.$oid", "profile.name", "bal x", "seg"))


@query(
    "all_string",
    """select o_orderkey::varchar o_orderkey, cast(o_totalprice as decimal(18,2))::varchar o_totalprice,
              o_orderdate::varchar o_orderdate, o_orderpriority,
              '{"k":' || o_custkey || ',"s":["' || o_orderstatus || '"]}' as nested from orders""",
)
def all_string(spark, sf_dir):
    nested = F.struct(F.col("o_custkey").alias("k"), F.array("o_orderstatus").alias("s"))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
        nested.alias("nested"),
    )
    return audit.all_string(rows)


@query(
    "landing_schema",
    f"""select c_name::varchar as a_name, c_custkey::varchar as z_key, c_nationkey::varchar as m_nation,
               '2025-03-10 01:45:30' as dt_ingestao, '{RUN_ID}' as id_execucao from customer""",
)
def landing_schema(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("z_key"), F.col("c_name").alias("a_name"), F.col("c_nationkey").alias("m_nation")
    )
    return audit.landing_schema(rows, RUN_TS)


@query("audit_timestamp", """select o_orderkey, '2025-03-09 22:45:30' as "DT_INGESTAO" from orders""")
def audit_timestamp(spark, sf_dir):
    return audit.with_ingestion_time(table(spark, sf_dir, "orders").select("o_orderkey"), RUN_TS)


@query(
    "audit_run",
    f"select o_orderkey, '2025-03-10 01:45:30' as dt_ingestao, '{RUN_ID}' as id_execucao from orders",
)
def audit_run(spark, sf_dir):
    return audit.with_run_audit(table(spark, sf_dir, "orders").select("o_orderkey"), RUN_TS)


@query("project_fields", "select p_partkey, p_name, p_retailprice from part")
def project_fields(spark, sf_dir):
    return columns.project_fields(table(spark, sf_dir, "part"), ["p_name", "p_retailprice"], key="p_partkey")


@query("use_columns", "select p_name, p_brand, p_type from part")
def use_columns(spark, sf_dir):
    return columns.use_columns(table(spark, sf_dir, "part"), "B:D")


@query(
    "derive_dt",
    "select o_orderdate::date::varchar as \"DT\", o_orderkey, o_orderdate::varchar as o_orderdate from orders",
)
def derive_dt(spark, sf_dir):
    rows = as_text(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    config = {"partition_column": "o_orderkey", "filter_column": "o_orderdate", "incremental_join_clause": "a = b"}
    rows = rows.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))
    return casting.derive_dt(rows, casting.partition_source(config))


@query(
    "project_except_dt",
    "select o_orderdate::date::varchar as \"DT\", o_orderkey, o_orderdate::varchar as o_orderdate from orders",
)
def project_except_dt(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.lit("2000-01-01").alias("dt"))
    return casting.project_except_dt(rows, "o_orderdate")


@query(
    "custom_transform",
    """select doc_id, source, lang, text from
       (select *, row_number() over (partition by source, lang order by doc_id) rn from documents) where rn = 1""",
)
def custom_transform_query(spark, sf_dir):
    # the order columns a file scan gives: here the table is its own file, in order of its key
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", "text", F.lit("documents").alias("_file"), F.col("doc_id").alias("_row")
    )
    hooks = {"one_per_source": keep_first("source", "lang")}
    return custom_transform(rows, "one_per_source", "documents.csv", hooks).drop(*ORDER_COLUMNS)


@query(
    "common_chain",
    """select c_custkey "CODIGO", c_name "NOME", c_acctbal "SALDO", c_acctbal > 0 "POSITIVO",
              '2025-03-09 22:45:30' as "DT_INGESTAO" from customer""",
)
def common_chain_query(spark, sf_dir):
    rows = as_text(table(spark, sf_dir, "customer")).select(
        F.col("c_custkey").alias("código"),
        F.col("c_name").alias("Nome "),
        F.col("c_acctbal").alias("Saldo"),
        (F.col("c_acctbal").cast("double") > 0).cast("string").alias("Positivo?"),
    )
    return common_chain(rows, RUN_TS, "parquet")
