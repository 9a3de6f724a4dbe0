"""Joins against keys and configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.sets import union_drifting


def facts_for_keys(facts: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Facts of the given keys only. Spark sizes the list and picks the join; adaptive execution splits a hot key."""
    return facts.join(keys.select(F.col(key)).distinct(), key, "left_semi")


def facts_of_kinds(kinds: dict[str, DataFrame], keys: DataFrame, key: str) -> DataFrame:
    """Several fact tables (answers, ratings), each cut to the keys, appended under their kind."""
    return union_drifting(
        facts_for_keys(facts, keys, key).withColumn("fact", F.lit(kind))
        for kind, facts in kinds.items()
    )


def lookup(
    rows: DataFrame, table: DataFrame, on: Sequence[str], strict: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows with the columns of their lookup entry, and the rows that have none.

    ``strict`` fails the query at the first row without an entry. No broadcast is forced: Spark
    broadcasts a table below ``autoBroadcastJoinThreshold`` by itself and sort-merges a larger one.
    """
    marked = table.withColumn("_found", F.lit(True))
    joined = rows.join(marked, list(on), "left")
    if strict:
        key = F.concat_ws(", ", *[F.col(c).cast("string") for c in on])
        missing = F.raise_error(F.concat(F.lit("no entry for "), key)).cast("boolean")
        matched = joined.filter(F.coalesce("_found", missing))
    else:
        matched = joined.filter("_found")
    # both come from the one join
    rest = joined.filter(F.col("_found").isNull()).select(rows.columns)
    return matched.drop("_found"), rest
