"""Audit columns and the landing schema. The run's time and id are parameters, never ``now()``."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.dates import ntz

LOCAL_ZONE = "America/Sao_Paulo"


def wall_clock(run_ts: datetime, zone: str = LOCAL_ZONE) -> datetime:
    """The run's instant as naive local time; a naive ``run_ts`` is taken as UTC."""
    instant = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=timezone.utc)
    return instant.astimezone(ZoneInfo(zone)).replace(tzinfo=None)


def run_id_of(run_ts: datetime) -> str:
    return run_ts.strftime("%Y%m%dT%H%M%SZ")


def random_run_id() -> str:
    return uuid.uuid4().hex


def with_ingestion_time(
    df: DataFrame, run_ts: datetime, zone: str = LOCAL_ZONE, name: str = "DT_INGESTAO"
) -> DataFrame:
    return df.withColumn(name, ntz(wall_clock(run_ts, zone)))


def with_run_audit(df: DataFrame, run_ts: datetime, run_id: str | None = None) -> DataFrame:
    return df.withColumns(
        {"dt_ingestao": ntz(run_ts), "id_execucao": F.lit(run_id or run_id_of(run_ts))}
    )


def _text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def all_string(df: DataFrame, null_token: str | None = None) -> DataFrame:
    """Every column as text, nested ones as JSON. ``null_token`` writes missing values as a word."""
    columns = []
    for field in df.schema:
        text = _text(F.col(f"`{field.name}`"), field.dataType)
        if null_token is not None:
            text = F.coalesce(text, F.lit(null_token))
        columns.append(text.alias(field.name))
    return df.select(columns)


def landing_schema(df: DataFrame, run_ts: datetime, run_id: str | None = None) -> DataFrame:
    """Text columns sorted by name, then the two audit columns."""
    data = [c for c in sorted(df.columns) if c not in ("dt_ingestao", "id_execucao")]
    ordered = all_string(df.select([F.col(f"`{c}`") for c in data]))
    return with_run_audit(ordered, run_ts, run_id)
