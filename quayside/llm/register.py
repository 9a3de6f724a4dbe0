"""The register of this part's queries, filled by their modules."""

from __future__ import annotations

from quayside.llm import queries  # noqa: F401  (importing registers them)
from quayside.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
