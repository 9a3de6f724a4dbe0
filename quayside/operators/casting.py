"""Casts to a table schema, type inference, typed projections and the derived partition date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.coerce import COERCIONS, NUMBER, PLAIN_WHOLE, to_boolean, to_integer, to_number
from quayside.functions.dates import utc_instant

# Source column types and the warehouse types they are loaded as.
SQLSERVER_TYPES = {
    "varchar": "STRING", "nvarchar": "STRING", "char": "STRING", "text": "STRING", "nchar": "STRING",
    "ntext": "STRING", "xml": "STRING", "uniqueidentifier": "STRING",
    "int": "INT64", "bigint": "INT64", "smallint": "INT64", "tinyint": "INT64",
    "bit": "BOOL", "decimal": "NUMERIC", "numeric": "NUMERIC", "money": "NUMERIC", "smallmoney": "NUMERIC",
    "float": "FLOAT64", "real": "NUMERIC", "date": "DATE", "datetime": "DATETIME", "datetime2": "DATETIME",
    "smalldatetime": "DATETIME", "time": "TIME", "datetimeoffset": "TIMESTAMP",
    "binary": "BYTES", "varbinary": "BYTES", "image": "BYTES", "timestamp": "INT64",
}
POSTGRES_TYPES = {
    "character varying": "STRING", "varchar": "STRING", "text": "STRING",
    "integer": "INT64", "bigint": "INT64", "smallint": "INT64",
    "boolean": "BOOL", "numeric": "NUMERIC", "double precision": "FLOAT64",
    "timestamp without time zone": "DATETIME", "timestamp with time zone": "TIMESTAMP",
    "bytea": "BYTES", "uuid": "STRING", "date": "DATE",
}
ORACLE_TYPES = {
    "varchar2": "STRING", "nvarchar2": "STRING", "char": "STRING", "nchar": "STRING",
    "clob": "STRING", "nclob": "STRING",
    "number": "NUMERIC", "binary_float": "FLOAT64", "binary_double": "FLOAT64",
    "date": "DATETIME", "timestamp": "TIMESTAMP",
    "timestamp with local time zone": "TIMESTAMP", "timestamp with time zone": "TIMESTAMP",
    "blob": "BYTES", "raw": "BYTES", "long raw": "BYTES",
}
DIALECTS = {"sqlserver": SQLSERVER_TYPES, "postgres": POSTGRES_TYPES, "oracle": ORACLE_TYPES}

# Warehouse types as Spark types. TIME has no enabled Spark type and stays text.
WAREHOUSE_TO_SPARK = {
    "INT64": "bigint", "FLOAT64": "double", "NUMERIC": "decimal(38,9)", "BIGNUMERIC": "decimal(38,9)",
    "BOOL": "boolean", "DATE": "date", "DATETIME": "timestamp_ntz", "TIMESTAMP": "timestamp",
    "TIME": "string", "BYTES": "binary", "STRING": "string",
}

AUDIT_COLUMNS = ("DT_INGESTAO", "ID_EXECUCAO")

Catalogue = DataFrame | Sequence[tuple[str, str]]


def _bare(name: str) -> Column:
    return F.col(f"`{name}`")


def _coerced(c: Column, warehouse_type: str | None) -> Column:
    rule = COERCIONS.get((warehouse_type or "STRING").upper())
    return rule(c) if rule else c.cast("string")


def cast_to_schema(df: DataFrame, schema: Mapping[str, str], rejects: Observation | None = None) -> DataFrame:
    """Coerce columns to the target table's types; unknown columns become text.

    Values that do not fit turn to null. With an ``Observation`` their number per column is counted
    in the same pass that writes the rows; ``cast_rejects`` gives the same counts as a DataFrame.
    """
    if rejects is not None:
        counts = [_rejected(c, schema[c]).alias(c) for c in df.columns if c in schema]
        df = df.observe(rejects, *(counts or [F.count(F.lit(1)).alias("rows")]))
    return df.select([_coerced(_bare(c), schema.get(c)).alias(c) for c in df.columns])


def _rejected(name: str, warehouse_type: str) -> Column:
    given = _bare(name).cast("string")
    return F.count_if(given.isNotNull() & _coerced(_bare(name), warehouse_type).isNull())


def cast_rejects(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """How many given values of each column do not fit its type: ``column_name, rejected``."""
    known = [c for c in df.columns if c in schema]
    counts = df.agg(*[_rejected(c, schema[c]).alias(c) for c in known])
    return counts.unpivot([], known, "column_name", "rejected")


def best_types(df: DataFrame) -> dict[str, str]:
    """The narrowest of bigint, double and boolean that every given value of a text column fits.

    A value is a whole number, another number, a boolean or text, one bit each; a column's bits are
    or-ed. So each value is looked at once, and only one row of bits comes to the driver.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return {}
    row = df.agg(*[F.bit_or(value_kind(_bare(name))).alias(f"kinds_{i}") for i, name in enumerate(names)]).first()
    return {name: type_of_kinds(row[f"kinds_{i}"]) for i, name in enumerate(names)}


def type_of_kinds(kinds: int | None) -> str:
    """The narrowest type for values of these kinds; text where no value is given."""
    kinds = kinds or _TEXT
    if kinds == _WHOLE:
        return "bigint"
    if kinds | _WHOLE | _NUMBER == _WHOLE | _NUMBER:
        return "double"
    return "boolean" if kinds == _BOOLEAN else "string"


_WHOLE, _NUMBER, _BOOLEAN, _TEXT = 1, 2, 4, 8


def value_kind(c: Column) -> Column:
    """The bit of a value's kind; null for a missing one."""
    number = c.try_cast("double")
    whole = (number == F.floor(number)) & to_integer(c).isNotNull()
    return (
        F.when(c.isNull() | (F.lower(c) == "nan"), F.lit(None).cast("int"))
        .when(c.rlike(PLAIN_WHOLE), F.lit(_WHOLE))
        .when(c.rlike(NUMBER), F.when(whole, F.lit(_WHOLE)).otherwise(F.lit(_NUMBER)))
        .when(to_boolean(c).isNotNull(), F.lit(_BOOLEAN))
        .otherwise(F.lit(_TEXT))
    )


def infer_types(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Cast text columns to their best type, nested columns to JSON text, and NaN to null.

    Give ``types`` to keep the outcome of an earlier run and skip the counting pass.
    """
    types = best_types(df) if types is None else types
    rules = {"bigint": to_integer, "double": to_number, "boolean": to_boolean}
    columns = []
    for field in df.schema:
        c = _bare(field.name)
        if field.name in types:
            rule = rules.get(types[field.name])
            # the word "nan" is a missing number; in a text column it is a word
            c = rule(c) if rule else c
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(~F.isnan(c), c)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c)
        columns.append(c.alias(field.name))
    return df.select(columns)


def _catalogue_rows(catalogue: Catalogue) -> list[tuple[str, str]]:
    """Column list of one table; a catalogue DataFrame has one row per column, so it is collected."""
    if isinstance(catalogue, DataFrame):
        return [(r[0], r[1]) for r in catalogue.select("column_name", "data_type").collect()]
    return list(catalogue)


def _typed(c: Column, source: T.DataType, warehouse_type: str, strict: bool) -> Column:
    spark_type = WAREHOUSE_TO_SPARK[warehouse_type]
    if spark_type == "boolean" and isinstance(source, T.StringType):
        known = to_boolean(c)
        if not strict:
            return known
        wrong = F.raise_error(F.concat(F.lit("not a boolean: "), c)).cast("boolean")
        return F.when(c.isNull() | known.isNotNull(), known).otherwise(wrong)
    if spark_type == "bigint" and isinstance(source, T.StringType) and not strict:
        return to_integer(c)
    if spark_type == "timestamp" and isinstance(source, T.StringType):
        c = F.coalesce(utc_instant(c), c) if strict else utc_instant(c)
    return c.cast(spark_type) if strict else c.try_cast(spark_type)


def typed_projection(
    df: DataFrame,
    catalogue: Catalogue,
    dialect: str,
    partition_column: str | None = None,
    strict: bool = False,
    rejects: Observation | None = None,
) -> DataFrame:
    """The select list for a source table's catalogue, audit columns last.

    Unmapped types stay text; a precision in the type name, as in ``timestamp(6)``, is ignored. With a
    ``partition_column`` its day comes first as ``DT`` and a source column of that name is left out.
    ``strict`` fails on a value that does not fit, the default gives null; with an ``Observation`` their number is
    counted as ``rejected``, and the rows as ``rows``, in the pass that writes.
    """
    type_map = DIALECTS[dialect]
    fields = {f.name.lower(): f.dataType for f in df.schema}
    columns, lost = [], F.count_if(F.lit(False))
    if partition_column:
        columns.append(partition_day(_bare(partition_column), strict).alias("DT"))
    for name, source_type in _catalogue_rows(catalogue):
        if partition_column and name.upper() == "DT":
            continue
        bare_type = " ".join(source_type.lower().replace("(", " (").split())
        kept = [w for w in bare_type.split() if not (w.startswith("(") or w.endswith(")"))]
        warehouse_type = type_map.get(" ".join(kept), "STRING")
        typed = _typed(_bare(name), fields[name.lower()], warehouse_type, strict)
        columns.append(typed.alias(name.upper()))
        if warehouse_type != "STRING":
            lost = lost + F.count_if(_bare(name).isNotNull() & typed.isNull())
    if rejects is not None:
        df = df.observe(rejects, F.count(F.lit(1)).alias("rows"), lost.alias("rejected"))
    ingested = _bare("DT_INGESTAO")
    if dialect == "sqlserver":
        ingested = ingested.cast("timestamp_ntz")
    return df.select(*columns, ingested.alias("DT_INGESTAO"), _bare("ID_EXECUCAO").alias("ID_EXECUCAO"))


def partition_day(c: Column, strict: bool = False) -> Column:
    return c.cast("date") if strict else c.try_cast("date")


def partition_source(config: Mapping[str, str | None]) -> str | None:
    """Which column gives ``DT``: the filter column of an incremental join, else the partition column."""
    if config.get("incremental_join_clause"):
        return config.get("filter_column") or config.get("partition_column")
    return config.get("partition_column")


def derive_dt(df: DataFrame, column: str, strict: bool = False) -> DataFrame:
    """The partition day as the first column."""
    return df.select(partition_day(_bare(column), strict).alias("DT"), *df.drop("DT").columns)


def project_except_dt(df: DataFrame, partition_column: str | None = None) -> DataFrame:
    """File tables: every column but the folder's ``DT``, a derived ``DT`` first when asked for."""
    if partition_column:
        return derive_dt(df, partition_column)
    return df.drop("DT")
