"""Runs driven by configuration, with one row broken on purpose."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from quayside.operators.audit import run_id_of, with_run_audit
from quayside.plans.hooks import keep_first
from quayside.plans.publish import append_run, merge_range, replace_partition
from quayside.plans.runs import REPORT_SCHEMA, build_models, counted, run_all, run_files, run_summary
from quayside.queries.register import RUN_TS, as_text, query, table
from quayside.session import scratch_path
from quayside.sources.tables import external_table

FILE_CONFIG = """
    source_file_name string, file_name string, active boolean, file_path string, file_format string,
    sheet_name string, header int, delimiter string, decimal string, encoding string, usecols string,
    custom_processor string, gcs_folder string, output_file_name string, output_file_format string, write_mode string
"""


def _file_run(spark, sf_dir):
    """Orders and customers as text files and events as parquet, one missing file and one unknown name."""
    drop, out = scratch_path(spark, "drop"), scratch_path(spark, "files")
    as_text(table(spark, sf_dir, "orders")).write.options(header=True, sep=";").csv(f"{drop}/rede/pedidos.csv")
    as_text(table(spark, sf_dir, "customer")).write.options(header=True, sep="|").csv(f"{drop}/rede/clientes.txt")
    table(spark, sf_dir, "events").drop("ts").write.parquet(f"{drop}/rede/eventos.parquet")

    def row(source, kind, sep, usecols, hook, output, out_format, mode, active=True):
        return (source, source, active, "rede", kind, None, 0, sep, None, None, usecols, hook, "arquivos", output, out_format, mode)

    config = [
        row("pedidos.csv", "csv", ";", None, None, "pedidos", "parquet", "partitioned"),
        row("clientes.txt", "txt", "|", "c_custkey,c_name", None, "clientes", "csv", "overwrite"),
        row("eventos.parquet", "parquet", None, None, "one_per_user", "eventos", "parquet", "overwrite"),
        row("perdido.csv", "csv", ",", None, None, "perdido", "csv", "overwrite"),
        row("inativo.csv", "csv", ",", None, None, "inativo", "csv", "overwrite", active=False),
    ]
    hooks = {"one_per_user": keep_first("user_id")}
    names = ["pedidos.csv", "clientes.txt", "eventos.parquet", "perdido.csv", "outro.csv"]
    report = run_files(spark, spark.createDataFrame(config, FILE_CONFIG), drop, out, RUN_TS, names, hooks)
    return report, out


@query(
    "config_run",
    """select 'pedidos.csv' source, 'pedidos' target, 'ok' status, count(*) "rows" from orders
       union all select 'clientes.txt', 'clientes', 'ok', count(*) from customer
       union all select 'eventos.parquet', 'eventos', 'ok', count(distinct user_id) from events
       union all select 'perdido.csv', 'perdido', 'failed', 0
       union all select 'outro.csv', null, 'failed', 0""",
)
def config_run(spark, sf_dir):
    return _file_run(spark, sf_dir)[0].select("source", "target", "status", "rows")


@query(
    "run_summary",
    """select 'customer ' || c_mktsegment source, case when o_orderstatus = 'P' then 'failed' else 'ok' end status,
              count(*) jobs, coalesce(sum(case when o_orderstatus <> 'P' then o_orderkey end), 0)::bigint "rows"
       from orders join customer on o_custkey = c_custkey group by 1, 2""",
)
def run_summary_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    failed = F.col("o_orderstatus") == "P"
    report = orders.select(
        F.concat(F.lit("customer "), "c_mktsegment").alias("source"),
        F.when(failed, "failed").otherwise("ok").alias("status"),
        F.when(~failed, F.col("o_orderkey")).alias("rows"),
    )
    return run_summary(report)


MODEL_CONFIG = """
    source_table_name string, source_file_name string, target_dataset string, target_table_name string,
    migration_type string, partition_column string, filter_column string, incremental_join_clause string,
    flag_table_created int
"""


@query(
    "model_build",
    """select 'vendas.orders' source, 'ok' status, count(*) "rows", count(*) typed,
              sum(o_totalprice::decimal(18,2))::double total, 1 flag from orders
       union all
       select 'dbo.customer', 'ok', count(*), count(*), sum(c_acctbal::decimal(18,2))::double, 1 from customer
       union all
       select 'vendas.missing', 'failed', 0, null, null, 0""",
)
def model_build(spark, sf_dir):
    landing, bronze, versions = (scratch_path(spark, n) for n in ("landing", "bronze", "config"))
    run = datetime(2025, 3, 9, 2)
    orders = as_text(table(spark, sf_dir, "orders"))
    customers = as_text(table(spark, sf_dir, "customer"))
    before = datetime(2025, 3, 8, 2)  # the day before knew no total
    append_run(with_run_audit(orders.drop("o_totalprice"), before), f"{landing}/vendas/orders", before.date(), run_id_of(before))
    append_run(with_run_audit(orders, run), f"{landing}/vendas/orders", run.date(), run_id_of(run))
    append_run(with_run_audit(customers, run), f"{landing}/dbo/customer", run.date(), run_id_of(run))
    config = spark.createDataFrame(
        [
            ("vendas.orders", None, "bronze", "orders", "INCREMENTAL", "o_orderdate", None, None, 0),
            ("customer", None, "bronze", "customer", "FULL", None, None, None, 0),
            ("vendas.missing", None, "bronze", "missing", "FULL", None, None, None, 0),
            ("vendas.done", None, "bronze", "done", "FULL", None, None, None, 1),
        ],
        MODEL_CONFIG,
    )
    catalogues = spark.createDataFrame(
        [
            ("vendas.orders", "O_ORDERKEY", "bigint"),
            ("vendas.orders", "O_TOTALPRICE", "money"),
            ("vendas.orders", "O_ORDERDATE", "date"),
            ("customer", "C_CUSTKEY", "bigint"),
            ("customer", "C_ACCTBAL", "decimal"),
        ],
        "table_name string, column_name string, data_type string",
    )
    report = build_models(
        spark, config, landing, bronze, catalogues, "sqlserver", "1990-01-01", "2030-12-31", config_versions=versions
    )
    built = spark.read.parquet(f"{bronze}/bronze/orders").select(
        F.lit("orders").alias("target"), F.col("O_TOTALPRICE").alias("amount")
    )
    built = built.unionByName(
        spark.read.parquet(f"{bronze}/bronze/customer").select(F.lit("customer").alias("target"), F.col("C_ACCTBAL").alias("amount"))
    )
    sums = built.groupBy("target").agg(F.count("amount").alias("typed"), F.sum("amount").cast("double").alias("total"))
    flags = spark.read.parquet(f"{versions}/v=1").selectExpr("target_table_name as target", "flag_table_created as flag")
    source = F.when(F.col("source") == "customer", "dbo.customer").otherwise(F.col("source"))
    return report.join(sums, "target", "left").join(flags, "target", "left").select(
        source.alias("source"), "status", "rows", "typed", "total", "flag"
    )


@query(
    "model_rejects",
    """select 'lossy' target, 'ok' status, count(*) "rows", sum(case when l_linenumber = 2 then 1 when l_linenumber = 3 then 2 else 0 end)::bigint rejected
       from lineitem
       union all select 'bare', 'failed', 0, null""",
)
def model_rejects(spark, sf_dir):
    """Landed numbers as a source writes them: whole with a point, fractions and words in integer columns."""
    landing, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    number = F.col("l_linenumber")
    whole = F.concat(F.col("l_orderkey").cast("string"), F.lit(".0"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(number == 2, F.concat(F.col("l_orderkey").cast("string"), F.lit(".5"))).when(number == 3, "n/d").otherwise(whole).alias("k"),
        F.when(number == 3, "x").otherwise(F.col("l_partkey").cast("string")).alias("p"),
        F.col("l_returnflag").alias("f"),
    )
    run = datetime(2025, 3, 9, 2)
    for name in ("lossy", "bare"):
        append_run(with_run_audit(lines, run), f"{landing}/dbo/{name}", run.date(), run_id_of(run))
    config = [(f"dbo.{n}", None, "bronze", n, "FULL", None, None, None, 0) for n in ("lossy", "bare")]
    columns = [("dbo.Lossy", "K", "int"), ("dbo.Lossy", "P", "bigint"), ("dbo.Lossy", "F", "char")]
    report = build_models(
        spark, spark.createDataFrame(config, MODEL_CONFIG), landing, bronze,
        spark.createDataFrame(columns, "table_name string, column_name string, data_type string"), "sqlserver", "1990-01-01", "2030-12-31",
    )
    return report.select("target", "status", "rows", "rejected")


@query(
    "empty_merge",
    """select o_orderkey, o_orderdate::date::varchar "DT" from orders
       where o_orderdate::date not between date '1996-01-01' and date '1996-03-31'""",
)
def empty_merge(spark, sf_dir):
    """A snapshot without rows clears the days of its range and is a run that went well."""
    path = scratch_path(spark, "merge")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("DT"))
    replace_partition(rows, path, "DT")
    report = run_all([("orders", "orders", lambda: counted(rows.limit(0), lambda df: merge_range(spark, df, path, "1996-01-01", "1996-03-31")))], 1)
    if report[0][2:4] != ("ok", 0):
        raise AssertionError(report)
    return external_table(spark, path)


@query(
    "limited_run",
    """select 'events' source, 'ok' status, count(*) "rows", null as message from events
       union all select 'endless', 'failed', 0, 'cut off after 8 s' union all select 'orders', 'ok', count(*), null from orders""",
)
def limited_run(spark, sf_dir):
    """A row whose job would run for days is cut off; the rows before and after it end."""
    path = scratch_path(spark, "limited")

    def publish(name):
        return lambda: counted(table(spark, sf_dir, name), lambda df: df.write.parquet(f"{path}/{name}"))

    def endless():
        lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("a"))
        every = lines.crossJoin(lines.toDF("b")).crossJoin(lines.toDF("c")).where("a * b + c = -1")
        return counted(every, lambda df: df.write.parquet(f"{path}/endless"))

    jobs = [("events", "events", publish("events")), ("endless", "endless", endless), ("orders", "orders", publish("orders"))]
    report = spark.createDataFrame(run_all(jobs, 2, spark, limit=8.0), REPORT_SCHEMA)
    return report.select("source", "status", "rows", "message")
