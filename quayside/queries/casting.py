"""Coercing casts, inference and typed projections over landed text."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import casting, kinds
from quayside.operators.audit import with_run_audit
from quayside.queries.register import RUN_ID, RUN_TS, as_text, money, query, table
from quayside.session import scratch_path


def spoiled():
    return F.col("l_orderkey") % 97 == 0


def _spoiled_lines(spark, sf_dir):
    """Line items as text, with values of every 97th order that do not fit their type."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.when(spoiled(), "3.5").otherwise(F.concat(F.col("l_linenumber").cast("string"), F.lit(".0"))).alias("l_linenumber"),
        F.when(spoiled(), "n/d").otherwise(money("l_quantity")).alias("l_quantity"),
        F.when(spoiled(), "yes").when(F.col("l_returnflag") == "R", "TRUE").otherwise("false").alias("returned"),
        F.when(spoiled(), "2020-13-45").otherwise(F.col("l_shipdate").cast("string")).alias("l_shipdate"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("unlisted"),
    )


LINE_TYPES = {
    "l_orderkey": "INTEGER",
    "l_linenumber": "INTEGER",
    "l_quantity": "NUMERIC",
    "returned": "BOOLEAN",
    "l_shipdate": "DATE",
}


@query(
    "cast_to_schema",
    """select l_orderkey, case when l_orderkey % 97 <> 0 then l_linenumber::bigint end l_linenumber,
              case when l_orderkey % 97 <> 0 then l_quantity end l_quantity,
              case when l_orderkey % 97 <> 0 then l_returnflag = 'R' end returned,
              case when l_orderkey % 97 <> 0 then l_shipdate::date::varchar end l_shipdate,
              cast(l_extendedprice as decimal(18,2))::varchar unlisted from lineitem""",
)
def cast_to_schema(spark, sf_dir):
    return casting.cast_to_schema(_spoiled_lines(spark, sf_dir), LINE_TYPES)


@query(
    "cast_rejects",
    """select column_name, case when column_name = 'l_orderkey' then 0 else
              (select count(*) from lineitem where l_orderkey % 97 = 0) end rejected
       from (values ('l_orderkey'), ('l_linenumber'), ('l_quantity'), ('returned'), ('l_shipdate')) t(column_name)""",
)
def cast_rejects(spark, sf_dir):
    return casting.cast_rejects(_spoiled_lines(spark, sf_dir), LINE_TYPES)


@query(
    "infer_types",
    """select l_orderkey, l_quantity::bigint l_quantity, l_extendedprice,
              case when l_orderkey % 97 = 0 then 'n/d' else l_linenumber::varchar end l_linenumber,
              case when l_orderkey % 97 <> 0 then l_discount end l_discount, l_returnflag = 'R' returned,
              '{"flag":"' || l_linestatus || '"}' nested from lineitem""",
)
def infer_types(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return casting.infer_types(
        lines.select(
            F.col("l_orderkey").cast("string").alias("l_orderkey"),
            money("l_quantity").alias("l_quantity"),
            money("l_extendedprice").alias("l_extendedprice"),
            F.when(spoiled(), "n/d").otherwise(F.col("l_linenumber").cast("string")).alias("l_linenumber"),
            F.when(spoiled(), F.lit("NaN").cast("double")).otherwise(F.col("l_discount")).alias("l_discount"),
            (F.col("l_returnflag") == "R").cast("string").alias("returned"),
            F.struct(F.col("l_linestatus").alias("flag")).alias("nested"),
        )
    )


@query(
    "infer_types_by_file",
    """select l_orderkey, l_quantity::bigint l_quantity, case when l_orderkey % 97 = 0 then 'n/d' else l_linenumber::varchar end l_linenumber,
              l_extendedprice, l_returnflag = 'R' returned, case when l_orderkey % 97 = 0 then 2 else 1 end delivery from lineitem""",
)
def infer_types_by_file(spark, sf_dir):
    """Line items as text in two deliveries; the second look opens the second one's files only, and widens one column."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        money("l_quantity").alias("l_quantity"),
        F.when(spoiled(), "n/d").otherwise(F.col("l_linenumber").cast("string")).alias("l_linenumber"),
        money("l_extendedprice").alias("l_extendedprice"),
        (F.col("l_returnflag") == "R").cast("string").alias("returned"),
    )
    folder, book = scratch_path(spark, "deliveries"), scratch_path(spark, "kinds")
    odd = F.col("l_linenumber") == "n/d"
    lines.where(~odd).write.parquet(f"{folder}/delivery=1")
    kinds.folder_types(spark, folder, book)
    lines.where(odd).write.parquet(f"{folder}/delivery=2")
    return kinds.infer_folder(spark, folder, book)


def landed_lines(spark, sf_dir):
    return with_run_audit(as_text(table(spark, sf_dir, "lineitem")), RUN_TS)


def _doubles(df):
    """Decimals as doubles, for the comparison only."""
    return df.select([(F.col(c).cast("double") if t.startswith("decimal") else F.col(c)).alias(c) for c, t in df.dtypes])


_TYPED = f"""
    select {{day}} l_orderkey as "L_ORDERKEY", l_linenumber::bigint as "L_LINENUMBER", l_quantity as "L_QUANTITY",
           l_extendedprice as "L_EXTENDEDPRICE", l_discount as "L_DISCOUNT", l_returnflag as "L_RETURNFLAG",
           l_shipdate::varchar as "L_SHIPDATE", '2025-03-10 01:45:30' as "DT_INGESTAO", '{RUN_ID}' as "ID_EXECUCAO"
    from lineitem
"""
_DAY = 'l_shipdate::date::varchar as "DT",'

SQLSERVER_LINES = [
    ("L_ORDERKEY", "bigint"), ("L_LINENUMBER", "int"), ("L_QUANTITY", "money"), ("L_EXTENDEDPRICE", "decimal"),
    ("L_DISCOUNT", "float"), ("L_RETURNFLAG", "char"), ("L_SHIPDATE", "datetime2"),
]


@query("typed_sqlserver", _TYPED.format(day=_DAY))
def typed_sqlserver(spark, sf_dir):
    return _doubles(casting.typed_projection(landed_lines(spark, sf_dir), SQLSERVER_LINES, "sqlserver", "l_shipdate"))


@query("typed_postgres", _TYPED.format(day=_DAY))
def typed_postgres(spark, sf_dir):
    catalogue = [
        ("L_ORDERKEY", "bigint"), ("L_LINENUMBER", "integer"), ("L_QUANTITY", "numeric"),
        ("L_EXTENDEDPRICE", "double precision"), ("L_DISCOUNT", "numeric"), ("L_RETURNFLAG", "character varying"),
        ("L_SHIPDATE", "timestamp without time zone"), ("DT", "date"),
    ]
    rows = landed_lines(spark, sf_dir).withColumn("dt", F.lit("2000-01-01"))
    listed = spark.createDataFrame(catalogue, "column_name string, data_type string")
    return _doubles(casting.typed_projection(rows, listed, "postgres", "l_shipdate"))


@query("typed_oracle", _TYPED.format(day="").replace("l_linenumber::bigint", "l_linenumber::double"))
def typed_oracle(spark, sf_dir):
    catalogue = [
        ("L_ORDERKEY", "number"), ("L_LINENUMBER", "number"), ("L_QUANTITY", "binary_double"),
        ("L_EXTENDEDPRICE", "number"), ("L_DISCOUNT", "binary_float"), ("L_RETURNFLAG", "varchar2"),
        ("L_SHIPDATE", "date"),
    ]
    typed = _doubles(casting.typed_projection(landed_lines(spark, sf_dir), catalogue, "oracle"))
    return typed.withColumn("L_ORDERKEY", F.col("L_ORDERKEY").cast("bigint"))
