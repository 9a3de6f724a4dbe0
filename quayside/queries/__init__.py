"""Registered queries: each operator run over the given tables, with its SQL twin."""

from quayside.queries import (  # noqa: F401  (importing registers the queries)
    casting,
    filters,
    joins,
    landings,
    nested,
    projections,
    runs,
    scalars,
    scans,
    sinks,
)
from quayside.queries.register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
