"""Named transforms of a configuration row, and the chain every file goes through."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame

from quayside.functions.names import normalize_names
from quayside.operators.audit import with_ingestion_time
from quayside.operators.casting import infer_types
from quayside.operators.dedup import dedup_keep_first

Hook = Callable[[DataFrame, str | None], DataFrame]

# Where a row stood in its source, kept until the common chain so that hooks can rely on an order.
ORDER_COLUMNS = ("_file", "_split", "_row")


def keep_first(*keys: str) -> Hook:
    """A hook that keeps the first row of each key, in file order."""

    def hook(df: DataFrame, file_name: str | None) -> DataFrame:
        return dedup_keep_first(df, keys, [c for c in ORDER_COLUMNS if c in df.columns])

    return hook


# Fixed value: the one custom transform that ships, by its configured name.
HOOKS: dict[str, Hook] = {"agenda_sugestao_compras": keep_first("GRUPO_COMPRA")}


def custom_transform(
    df: DataFrame, name: str | None, file_name: str | None = None, hooks: Mapping[str, Hook] = HOOKS
) -> DataFrame:
    """The configured transform, or the rows as they are when none is named."""
    if not name:
        return df
    if name not in hooks:
        raise ValueError(f"no custom transform named {name!r}")
    return df.transform(hooks[name], file_name)


def common_chain(df: DataFrame, run_ts: datetime, file_format: str = "csv") -> DataFrame:
    """Names, then types where the output has types, then the ingestion time."""
    named = normalize_names(df.drop(*ORDER_COLUMNS))
    typed = infer_types(named) if file_format == "parquet" else named
    return with_ingestion_time(typed, run_ts)
