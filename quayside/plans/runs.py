"""Runs driven by configuration tables. Each row becomes one Spark job; a failing row is recorded
and the others go on."""

from __future__ import annotations

import time
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Mapping
from datetime import date, datetime
from queue import Empty, SimpleQueue
from threading import Thread

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from quayside.operators.audit import wall_clock
from quayside.operators.casting import partition_source, project_except_dt, typed_projection
from quayside.operators.configs import active_config, mark_processed, pending_config
from quayside.operators.filters import latest_snapshot, newest_folder
from quayside.plans.hooks import HOOKS, Hook, common_chain, custom_transform
from quayside.plans.publish import (
    full_refresh,
    merge_range,
    publish_append,
    publish_csv_overwrite,
    publish_dated,
    publish_version,
)
from quayside.sources.columns import use_columns
from quayside.sources.delimited import scan_delimited
from quayside.sources.tables import external_table, scan_parquet
from quayside.sources.workbook import sheet_table, workbook_files

REPORT_SCHEMA = "source string, target string, status string, rows long, message string, rejected long"


def settings_of(row: Row) -> dict:
    return {k.lower(): v for k, v in row.asDict().items()}


Job = Callable[[], "int | tuple[int, int]"]


def _attempt(source: str, target: str, job: Job) -> tuple:
    """One report row for one job, whatever happens in it. A job gives its rows, or rows and rejected values."""
    try:
        done = job()
    except Exception as error:  # a bad row must not stop the run
        return (source, target, "failed", 0, f"{type(error).__name__}: {error}", None)
    rows, rejected = done if isinstance(done, tuple) else (done, None)
    return (source, target, "ok", rows, None, rejected)


#: Seconds a job that was cut off has to end by itself before the run goes on without it.
_GRACE = 10.0


def run_all(
    jobs: Iterable[tuple[str, str, Job]],
    workers: int,
    spark: SparkSession | None = None,
    limit: float | None = None,
    pool: str | None = None,
) -> list[tuple]:
    """Submit jobs from a few threads, so that small tables fill the cluster together.

    A job that takes more than ``limit`` seconds is cut off: its Spark jobs are cancelled by its tag, now and as often as
    it begins others, its row is reported as failed and the next one takes its place. Threads have the caller's
    local properties; ``pool`` names the scheduler's pool their jobs share fairly.
    """
    if limit is not None and spark is None:
        raise ValueError("a limit wants the session whose jobs it cuts off")
    waiting, running, report = deque(enumerate(jobs)), {}, {}
    ended: SimpleQueue = SimpleQueue()

    def work(number: int, job: tuple[str, str, Job], tag: str) -> None:
        if spark is not None:
            spark.sparkContext.addJobTag(tag)
            spark.sparkContext.setInterruptOnCancel(True)
            if pool:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        ended.put((number, _attempt(*job)))

    def cut_off(job: tuple[str, str, Job], more: str = "") -> tuple:
        return (job[0], job[1], "failed", 0, f"cut off after {limit:g} s{more}", None)

    while waiting or running:
        while waiting and len(running) < workers:
            number, job = waiting.popleft()
            tag = f"row-{uuid.uuid4().hex}"
            thread = InheritableThread(target=work, args=(number, job, tag), session=spark) if spark else Thread(target=work, args=(number, job, tag))
            thread.daemon = True  # one that never ends must not keep the program
            running[number] = (job, tag, time.monotonic())
            thread.start()
        try:
            number, row = ended.get(timeout=None if limit is None else 0.2)
            if number in running:  # else it was given up before
                job, _, began = running.pop(number)
                late = limit is not None and time.monotonic() - began > limit and row[2] == "failed"
                report[number] = cut_off(job) if late else row
        except Empty:
            pass
        for number, (job, tag, began) in list(running.items()):
            over = -1.0 if limit is None else time.monotonic() - began - limit
            if over > 0:
                spark.sparkContext.cancelJobsWithTag(tag)
            if over > _GRACE:
                report[number] = cut_off(job, ", outside Spark")
                del running[number]
    return [report[number] for number in sorted(report)]


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write and count in one pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return observed(seen).get("rows", 0)


def observed(seen: Observation) -> dict[str, int]:
    """What an action has observed; nothing where it ran over no rows, as Spark then drops the plan that counts."""
    try:
        return dict(seen.get)
    except Exception as error:
        if "metric" in str(error).lower() or "toPyRow" in str(error) or isinstance(error, (KeyError, AssertionError)):
            return {}
        raise


def read_source(spark: SparkSession, cfg: Mapping, root: str) -> DataFrame:
    """The table a configuration row describes, as text, with its order columns."""
    folder = (cfg.get("file_path") or "").strip("/")
    path = "/".join(p for p in (root.rstrip("/"), folder, cfg["source_file_name"]) if p)
    kind = (cfg.get("file_format") or "csv").lower()
    decimal = cfg.get("decimal") or "."
    if kind == "xlsx":
        files = workbook_files(spark, path)
        header_row = int(cfg.get("header_row") or cfg.get("header") or 0)
        table = sheet_table(files, cfg.get("sheet_name"), header_row, cfg.get("usecols"))
        return _point_decimals(table, decimal)
    if kind in ("csv", "txt"):
        header = cfg.get("header")
        table = scan_delimited(
            spark,
            path,
            sep=cfg.get("delimiter") or ",",
            encoding=cfg.get("encoding") or "UTF-8",
            header=0 if header in (None, "") else int(header),
            usecols=cfg.get("usecols"),
        )
        # larger files are read by earlier tasks: the file and its split come before the row
        place = {"_file": F.col("_metadata.file_path"), "_split": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id()}
        return _point_decimals(table.withColumns(place), decimal)
    if kind == "parquet":
        table = scan_parquet(spark, path)
        where = {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
        return use_columns(table, cfg.get("usecols")).withColumns(where)
    raise ValueError(f"unsupported format: {kind}")


def _point_decimals(df: DataFrame, mark: str) -> DataFrame:
    """Columns of numbers written with another decimal mark get a point; a column with other text stays as it is."""
    texts = [c for c, t in df.dtypes if t == "string" and c != "_file"]
    if mark == "." or not texts:
        return df
    number = rf"^\s*[+-]?\d*[{mark}]?\d+\s*$"
    all_numbers = df.agg(*[F.bool_and(F.col(f"`{c}`").rlike(number)).alias(f"c{i}") for i, c in enumerate(texts)]).first()
    numeric = [c for i, c in enumerate(texts) if all_numbers[f"c{i}"]]
    return df.withColumns({c: F.replace(F.col(f"`{c}`"), F.lit(mark), F.lit(".")) for c in numeric})


def _ingest(spark: SparkSession, cfg: Mapping, source_root: str, target: str, run_ts: datetime, hooks) -> int:
    out_format = cfg.get("output_file_format") or "csv"
    rows = read_source(spark, cfg, source_root)
    rows = custom_transform(rows, cfg.get("custom_processor"), cfg.get("file_name"), hooks)
    rows = common_chain(rows, run_ts, out_format)
    mode = cfg.get("write_mode") or "overwrite"
    if mode == "partitioned":
        day = wall_clock(run_ts).date()
        return counted(rows, lambda df: publish_dated(df, target, day, out_format))
    if mode == "append":
        return counted(rows, lambda df: publish_append(df, target, out_format))
    if mode != "overwrite":
        raise ValueError(f"unknown write mode: {mode}")
    overwrite = full_refresh if out_format == "parquet" else publish_csv_overwrite
    return counted(rows, lambda df: overwrite(df, target))


def run_files(
    spark: SparkSession,
    config: DataFrame,
    source_root: str,
    target_root: str,
    run_ts: datetime,
    names: list[str] | None = None,
    hooks: Mapping[str, Hook] = HOOKS,
    workers: int = 4,
    limit: float | None = None,
) -> DataFrame:
    """Ingest every active configuration row; the report has one row each.

    A requested name without a configuration is reported as failed, as is a row whose job fails or takes more
    than ``limit`` seconds.
    """
    rows = active_config(config, names, required=False).collect()
    settings = [settings_of(r) for r in rows]
    known = {cfg["source_file_name"] for cfg in settings}
    jobs = []
    for cfg in settings:
        folder = (cfg.get("gcs_folder") or "").strip("/")
        target = "/".join(p for p in (target_root.rstrip("/"), folder, cfg["output_file_name"]) if p)
        jobs.append(
            (
                cfg["source_file_name"],
                cfg["output_file_name"],
                lambda cfg=cfg, target=target: _ingest(spark, cfg, source_root, target, run_ts, hooks),
            )
        )
    report = run_all(jobs, workers, spark, limit)
    for name in names or []:
        if name.strip() and name.strip() not in known:
            report.append((name.strip(), None, "failed", 0, "no active configuration", None))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def source_uri(root: str, source_table: str, default_schema: str = "dbo") -> str:
    """Landing folder of a source table: schema and table in lower case."""
    schema, _, table = source_table.lower().rpartition(".")
    return f"{root.rstrip('/')}/{schema or default_schema}/{table}"


def build_model(
    spark: SparkSession,
    cfg: Mapping,
    landing_root: str,
    target: str,
    catalogue: list[tuple[str, str]],
    dialect: str,
    start: date | str,
    end: date | str,
    file_source: bool = False,
    strict: bool = False,
    within_latest_dt: bool = False,
) -> tuple[int, int]:
    """Latest snapshot of the landed table, typed, merged or refreshed into its bronze table.

    Gives the rows and the values that did not fit their type. Runs of the landed table may differ in columns.
    """
    if not file_source and not catalogue:
        raise ValueError("no catalogue rows for this table")
    source = cfg.get("source_file_path") if file_source else cfg["source_table_name"]
    uri = f"{landing_root.rstrip('/')}/{source}" if file_source else source_uri(landing_root, source)
    landed = external_table(spark, uri, merge_schema=True)
    snapshot = latest_snapshot(landed, within_latest_dt=within_latest_dt, newest_day=newest_folder(spark, uri))
    seen = Observation()
    day_column = partition_source(cfg)
    if file_source:
        rows = project_except_dt(snapshot.observe(seen, F.count(F.lit(1)).alias("rows")), day_column)
    else:
        rows = typed_projection(snapshot, catalogue, dialect, day_column, strict, seen)
    if (cfg["migration_type"] or "").upper() == "INCREMENTAL":
        merge_range(spark, rows, target, start, end)
    else:
        full_refresh(rows, target)
    found = observed(seen)
    return found.get("rows", 0), found.get("rejected", 0)


def build_models(
    spark: SparkSession,
    config: DataFrame,
    landing_root: str,
    bronze_root: str,
    catalogues: DataFrame,
    dialect: str,
    start: date | str,
    end: date | str,
    names: list[str] | None = None,
    file_source: bool = False,
    config_versions: str | None = None,
    workers: int = 4,
    strict: bool = False,
    limit: float | None = None,
) -> DataFrame:
    """Build every pending model; those that succeed are flagged in a new configuration version.

    ``catalogues`` has ``table_name, column_name, data_type`` with the columns in order.
    """
    columns: dict[str, list[tuple[str, str]]] = {}  # by table name, whatever its case
    for r in catalogues.select("table_name", "column_name", "data_type").collect():
        columns.setdefault(r["table_name"].lower(), []).append((r["column_name"], r["data_type"]))
    jobs = []
    for cfg in map(settings_of, pending_config(config, names, file_source).collect()):
        source = cfg.get("source_table_name") or cfg.get("source_file_name") or ""
        target = cfg["target_table_name"]
        path = f"{bronze_root.rstrip('/')}/{cfg['target_dataset']}/{target}"
        jobs.append(
            (
                source,
                target,
                lambda cfg=cfg, path=path, source=source: build_model(
                    spark, cfg, landing_root, path, columns.get(source.lower(), []), dialect, start, end, file_source, strict
                ),
            )
        )
    report = run_all(jobs, workers, spark, limit)
    if config_versions:
        done = [row[1] for row in report if row[2] == "ok"]
        publish_version(mark_processed(config, done), config_versions)
    return spark.createDataFrame(report, REPORT_SCHEMA)


def run_summary(report: DataFrame) -> DataFrame:
    """Jobs and rows per source and status."""
    return report.groupBy("source", "status").agg(
        F.count(F.lit(1)).alias("jobs"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )
