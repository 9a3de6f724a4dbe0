"""Parquet, partitioned external tables, collections and run folders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import commits
from quayside.operators.filters import incremental_window
from quayside.sources.columns import project_fields


def scan_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet files; ``merge_schema`` when files of one folder may differ in columns."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def external_table(
    spark: SparkSession,
    uri: str,
    file_format: str = "parquet",
    schema: T.StructType | str | None = None,
    header: bool = True,
    merge_schema: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Everything below ``uri`` with the folder partitions as columns; ``dt=…`` comes as a date.

    Give the schema of a CSV table; without one its columns come as text. A CSV file is split over tasks
    unless quoted line breaks (``multi_line``) forbid it. A table written in commits is read as of its last one.
    """
    if file_format == "parquet" and commits.is_committed(spark, uri):
        return commits.read(spark, uri, schema=schema, mergeSchema=merge_schema)
    reader = spark.read.option("basePath", uri)
    if schema is not None:
        reader = reader.schema(schema)
    if file_format == "csv":
        options = {"sep": ",", "multiLine": multi_line, "encoding": "UTF-8", "header": header, "escape": '"'}
        return reader.options(**options).csv(uri)
    if file_format == "parquet":
        return reader.option("mergeSchema", merge_schema).parquet(uri)
    return reader.format(file_format).load(uri)


def run_folder(df: DataFrame, run_date: date, column: str = "dt") -> DataFrame:
    """One run's folder: a literal on the partition column, so other folders are not even listed
    for the scan."""
    kind = df.schema[column].dataType
    wanted = F.lit(run_date.isoformat())
    return df.filter(F.col(column) == (wanted if isinstance(kind, T.StringType) else wanted.cast("date")))


def scan_collection(
    df: DataFrame,
    field: str | None = None,
    start: date | datetime | str | None = None,
    end: date | datetime | str | None = None,
    projection: Sequence[str] | None = None,
    deleted: str | None = "deleted",
    key: str = "_id",
) -> DataFrame:
    """Filter and field list of a collection extract; Catalyst pushes both into the scan."""
    return project_fields(incremental_window(df, field, start, end, deleted), projection, key)


def scan_free_query(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """A query kept in the configuration, in Spark SQL; its tables are written ``{name}``."""
    return spark.sql(text, **tables)
