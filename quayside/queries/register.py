"""The register, and small helpers the queries share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RUN_TS = datetime(2025, 3, 10, 1, 45, 30, tzinfo=timezone.utc)
RUN_ID = "20250310T014530Z"


def query(name: str, oracle: str | None = None):
    """Register a query under its name, with the SQL that must give the same rows."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text: two engines print them alike but type them differently."""
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        [
            F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, moments) else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def money(name: str):
    """A two-decimal double as text that reads the same everywhere."""
    return F.col(name).cast("decimal(18,2)").cast("string")


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text the way a landed file has them."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])
