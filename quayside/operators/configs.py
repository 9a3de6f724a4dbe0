"""Configuration tables: pending and active rows, processed marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Names = DataFrame | Sequence[str] | None


def _named(df: DataFrame, column: str, names: Names) -> DataFrame:
    """Rows whose name is listed; a list that is a DataFrame is joined, not collected."""
    if names is None:
        return df
    if isinstance(names, DataFrame):
        listed = names.select(F.col(names.columns[0]).alias(column)).distinct()
        return df.join(listed, column, "left_semi")
    names = [n.strip() for n in names if n.strip()]
    return df.filter(F.col(column).isin(names)) if names else df


def pending_config(config: DataFrame, names: Names = None, file_source: bool = False) -> DataFrame:
    """Rows not yet built, all of them or those named."""
    name_column = "source_file_name" if file_source else "source_table_name"
    return _named(config.filter(F.col("flag_table_created") == 0), name_column, names)


def active_config(
    config: DataFrame,
    names: Names = None,
    name_column: str = "source_file_name",
    order: Sequence[str] = ("sheet_name", "source_file_name"),
    required: bool = True,
) -> DataFrame:
    """Active rows, all or those named, in config order; none at all is an error when required."""
    rows = _named(config.filter(F.col("active")), name_column, names)
    if required and rows.isEmpty():
        raise ValueError("no active configuration row matches")
    return rows.orderBy(*[c for c in order if c in config.columns])


def mark_processed(config: DataFrame, processed: DataFrame | Sequence[str]) -> DataFrame:
    """The configuration with the handled targets flagged; write it as a new version."""
    name = "target_table_name"
    if isinstance(processed, DataFrame):
        done = processed.select(F.col(processed.columns[0]).alias(name)).distinct()
        done = done.withColumn("_done", F.lit(True))
        hit = F.coalesce("_done", F.lit(False))
        joined = config.join(done, name, "left")
    else:
        hit = F.col(name).isin(list(processed)) if processed else F.lit(False)
        joined = config
    flag = F.when(hit, 1).otherwise(F.col("flag_table_created"))
    return joined.withColumn("flag_table_created", flag).select(config.columns)
