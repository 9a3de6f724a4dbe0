"""Unions of batches."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame

from quayside.operators.widening import union_widening


def union_batches(batches: Iterable[DataFrame]) -> DataFrame:
    """Append batches of one schema by column name."""
    return reduce(lambda a, b: a.unionByName(b), batches)


def union_drifting(batches: Iterable[DataFrame]) -> DataFrame:
    """Append batches whose columns or types differ: a column a batch lacks is null there, one of several types
    gets the least type that holds them all. ``union_widening`` also tells what was widened."""
    return union_widening(list(batches))[0]
