"""Whole landings, one per kind of source: each is a chain of operators that ends in one write."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import storage
from quayside.functions.dates import coerce_datetime, iso_text, parse_iso, run_day
from quayside.functions.names import sanitize_names
from quayside.functions.text import BRAND_RULES, with_entity_name
from quayside.operators.casting import cast_to_schema
from quayside.operators.audit import landing_schema, run_id_of, wall_clock, with_ingestion_time
from quayside.operators.configs import Names, active_config
from quayside.operators.filters import eligible_cycles, lookback_window, start_of_extract
from quayside.operators.lookups import facts_for_keys
from quayside.operators.nested import OFFER_PAGE_SCHEMA, flatten_offers, flatten_programs, normalize_scalars, raw_fallback
from quayside.plans.publish import MAX_RECORDS, append_run, period_folder, publish_csv_overwrite, publish_dated, zone_path
from quayside.plans.runs import REPORT_SCHEMA, counted, observed, run_all, settings_of
from quayside.sources.delimited import scan_delimited, scan_gz_pipe
from quayside.sources.documents import page_items, scan_envelope, scan_mixed_folder
from quayside.sources.pipelines import aggregate
from quayside.sources.tables import scan_collection, scan_free_query


def collection_rows(
    spark: SparkSession,
    cfg: Mapping,
    collection: DataFrame,
    bronze_root: str,
    start: date | str | None = None,
    end: date | str | None = None,
    key: str = "_id",
    others: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """What one configuration row extracts: an incremental window with its fields, or a free query.

    A free query is an aggregation pipeline, a JSON list of stages, or Spark SQL. ``others`` are the collections
    that a pipeline's stages may name.
    """
    kind = cfg["pipeline_type"]
    if kind == "FREE" and cfg["mongo_query"].lstrip().startswith("["):
        return aggregate(collection, cfg["mongo_query"], others)
    if kind == "FREE":
        return scan_free_query(spark, cfg["mongo_query"], collection=collection)
    if kind != "STANDARD":
        raise ValueError(f"unknown extract type: {kind}")
    field = cfg.get("filter_column")
    if field and not start:
        start = start_of_extract(spark, f"{bronze_root.rstrip('/')}/{cfg['target_dataset']}/{cfg['target_table_name']}")
    fields = json.loads(cfg["projection"]) if cfg.get("projection") else None
    return scan_collection(collection, field, start, end, fields, key=key)


def land_collection(rows: DataFrame, path: str, run_ts: datetime, max_records: int = 0) -> int:
    """Names, scalars and types made safe, everything as text, below the run's own folder."""
    safe = sanitize_names(rows)
    if "deletedAt" in safe.columns:
        moment = iso_text(coerce_datetime(F.col("deletedAt")))
        safe = safe.withColumn("deletedAt", F.concat(moment, F.lit("+00:00")))
    landed = landing_schema(normalize_scalars(safe), run_ts)
    return counted(landed, lambda df: append_run(df, path, run_ts.date(), run_id_of(run_ts), max_records))


class _ByName(dict):
    """Collections that are read when a pipeline names them."""

    def __init__(self, read: Callable[[str], DataFrame]):
        super().__init__()
        self.read = read

    def __missing__(self, name: str) -> DataFrame:
        return self.read(name)


def run_collections(
    spark: SparkSession,
    config: DataFrame,
    read: Callable[[str], DataFrame],
    landing_root: str,
    bronze_root: str,
    run_ts: datetime,
    names: Names = None,
    start: date | str | None = None,
    end: date | str | None = None,
    key: str = "_id",
    workers: int = 3,
    limit: float | None = None,
) -> DataFrame:
    """Extract every active collection; ``read`` gives a collection by name from whatever holds it."""
    jobs = []
    for cfg in map(settings_of, active_config(config, names, "source_table_name", ["source_table_name"], False).collect()):
        name = cfg["source_table_name"]

        def job(cfg=cfg, name=name) -> int:
            rows = collection_rows(spark, cfg, read(name), bronze_root, start, end, key, _ByName(read))
            return land_collection(rows, f"{landing_root.rstrip('/')}/{name}", run_ts)

        jobs.append((name, cfg["target_table_name"], job))
    return spark.createDataFrame(run_all(jobs, workers, spark, limit), REPORT_SCHEMA)


def land_drop(spark: SparkSession, prefix: str, run_date: date, target: str, run_ts: datetime) -> int:
    """A day's folder of JSON-lines and CSV files as one all-text table; its day is replaced."""
    folder = f"{prefix.rstrip('/')}/{run_date.isoformat()}"
    if not storage.exists(spark, folder):
        return 0
    try:
        rows = scan_mixed_folder(spark, folder)
    except ValueError:  # nothing in it that can be read
        return 0
    landed = landing_schema(rows, run_ts)
    return counted(landed, lambda df: publish_dated(df, target, run_date, "parquet"))


def land_gz(
    spark: SparkSession,
    transient: str,
    schema: Mapping[str, str],
    run_ts: datetime,
    explicit: str | None = None,
    days_back: int = 3,
) -> tuple[int, int]:
    """A day's gzip files of the transient zone, typed, into the same folder of the landing zone.

    The day is the one asked for, else ``days_back`` days before the run. Gives rows and rejected values; a day
    without a folder gives none. The landing folder's earlier content is replaced.
    """
    day, target = spark.range(1).select(
        run_day(explicit, run_ts.date(), days_back), zone_path(F.lit(transient.rstrip("/")))
    ).first()
    folder = f"{transient.rstrip('/')}/dt={day.isoformat()}"
    if not storage.exists(spark, folder):
        return 0, 0
    seen = Observation()
    typed = cast_to_schema(scan_gz_pipe(spark, folder), schema, seen)
    rows = counted(typed, lambda df: publish_dated(df, target, day, "parquet"))
    return rows, sum(n for c, n in observed(seen).items() if c in schema)


def land_period(
    spark: SparkSession,
    path: str,
    target: str,
    run_ts: datetime,
    sep: str = ";",
    encoding: str = "latin1",
    marks: Mapping[str, str] | None = None,
) -> int:
    """A text file of fixed layout into the folder of its period, which the mark in its name tells; its day is replaced."""
    period = spark.range(1).select(period_folder(F.lit(path.rstrip("/").rsplit("/", 1)[-1]), marks)).first()[0]
    if period is None:
        raise ValueError(f"no period in the name {path!r}")
    rows = landing_schema(scan_delimited(spark, path, sep=sep, encoding=encoding), run_ts)
    return counted(rows, lambda df: publish_dated(df, f"{target.rstrip('/')}/{period}", wall_clock(run_ts).date(), "parquet"))


def land_products(products: DataFrame, path: str, run_ts: datetime) -> int:
    """Product programmes, flat, as CSV at a fixed path."""
    rows = with_ingestion_time(flatten_programs(products), run_ts, name="dt_ingestao")
    return counted(rows, lambda df: publish_csv_overwrite(df, path))


def land_offers(
    pages: DataFrame, path: str, run_ts: datetime, brand_rules: Sequence = BRAND_RULES, body: str = "body"
) -> int:
    """Offer pages, one row per product and domain with the competitor's name, in the day's folder."""
    local = wall_clock(run_ts)
    offers = flatten_offers(page_items(pages, OFFER_PAGE_SCHEMA, body), local)
    named = with_entity_name(offers, "CONCORRENTE", F.col("DOMAIN"), F.col("SOLD_BY"), brand_rules=brand_rules)
    rows = with_ingestion_time(named, run_ts, name="dt_ingestao")
    return counted(rows, lambda df: publish_dated(df, path, local.date()))


def land_records(records: DataFrame, path: str, run_ts: datetime, run_id: str | None = None) -> int:
    """Records with their nesting, the audit pair as text, below the run's own folder."""
    stamp = run_ts.strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = records.withColumn("dt_ingestao", F.lit(stamp))
    run_id = run_id or run_id_of(run_ts)
    return counted(rows, lambda df: append_run(df, path, run_ts.date(), run_id, MAX_RECORDS))


def land_survey(
    spark: SparkSession,
    documents: Mapping[str, DataFrame],
    schemas: Mapping[str, str],
    root: str,
    run_ts: datetime,
    facts: Mapping[str, str],
    order: str,
    updated: str = "updatedAt",
    cycle_key: str = "cycleId",
) -> DataFrame:
    """Dimensions whole, facts of the recent cycles only, each entity below its own folder.

    ``documents`` holds API answers (``body``) per entity and ``schemas`` the fields of their records.
    ``facts`` names the fact entities and the field that holds their cycle; they are also cut to the
    look-back period. ``order`` is the cycle field that says which cycle came first. Times are read as text and
    brought to UTC wall clocks, as the API writes them with and without an offset.
    """
    run_date = run_ts.date()

    def opened(entity: str) -> DataFrame:
        fields = T.StructType.fromDDL(schemas[entity])
        moments = [f.name for f in fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
        as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name in moments else f.dataType) for f in fields])
        records = raw_fallback(scan_envelope(documents[entity]), "element", as_text)
        return records.withColumns({name: parse_iso(F.col(f"`{name}`")) for name in moments})

    cycles = eligible_cycles(opened("cycle"), run_date, order).withColumnRenamed("id", cycle_key)
    jobs = []
    for entity in documents:
        records = opened(entity)
        if entity in facts:
            # the moment from a generator, so that the bounds of the window do not parse it anew
            moment = records.select("*", F.explode_outer(F.array(F.col(f"`{updated}`"))).alias("_moment"))
            recent = lookback_window(moment, "_moment", run_date).drop("_moment")
            keyed = recent.withColumn(cycle_key, F.col(facts[entity]).cast("string"))
            records = facts_for_keys(keyed, cycles, cycle_key)
        jobs.append((entity, entity, lambda e=entity, r=records: land_records(r, f"{root.rstrip('/')}/{e}", run_ts)))
    return spark.createDataFrame(run_all(jobs, 3), REPORT_SCHEMA)
