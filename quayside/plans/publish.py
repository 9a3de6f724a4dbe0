"""Sinks. Folder partitions, bounded files, replacement and range merge without a table format."""

from __future__ import annotations

import uuid
from datetime import date
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import commits, storage
from quayside.functions.dates import wall_time

# Fixed value: rows per file of the bounded writer. The other sinks let the data size decide (0).
MAX_RECORDS = 200_000
CSV_OPTIONS = {
    "header": True,
    "encoding": "UTF-8",
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX",
}


def _writer(df: DataFrame, file_format: str, max_records: int = 0):
    if file_format not in ("csv", "parquet"):
        raise ValueError(f"unsupported format: {file_format}")
    writer = df.write.format(file_format).option("maxRecordsPerFile", max_records)
    return writer.options(**CSV_OPTIONS) if file_format == "csv" else writer.option("compression", "snappy")


def spread_by(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of one partition folder together, so a folder gets few files.

    A rebalance, not a repartition: adaptive execution splits the folder that holds a third of the
    rows over several tasks and joins the small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def even(df: DataFrame) -> DataFrame:
    """Files of like size, whatever the source's splits were: what one gzip file gave is not one file again."""
    return df.hint("rebalance")


def _recovered(spark: SparkSession, base: str) -> None:
    """End what a run that died between the two renames of a swap has begun; drop what is left of others."""
    parent, name = base.rsplit("/", 1)
    beside = storage.child_folders(spark, parent)
    ready = [n for n in beside if n.startswith(f"{name}-next-") and storage.exists(spark, f"{parent}/{n}/_SUCCESS")]
    was = [n for n in beside if n.startswith(f"{name}-was-")]
    if was and not storage.exists(spark, base):
        # the old table had made room already: the new one is whole, else the old one comes back
        storage.rename(spark, f"{parent}/{(ready or was)[0]}", base)
    for n in beside:
        if n.startswith((f"{name}-next-", f"{name}-was-")):
            storage.delete(spark, f"{parent}/{n}")


def _swapped(df: DataFrame, path: str, file_format: str) -> None:
    """Write beside the old table and put it in its place when all is written.

    Two renames; a run that dies between them leaves both tables whole beside the path, and the next run of
    the table puts the new one in place before it begins.
    """
    spark, base, run = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    _recovered(spark, base)
    _writer(even(df), file_format).save(f"{base}-next-{run}")
    if storage.exists(spark, base):
        storage.rename(spark, base, f"{base}-was-{run}")
    storage.rename(spark, f"{base}-next-{run}", base)
    storage.delete(spark, f"{base}-was-{run}")


def publish_csv_overwrite(df: DataFrame, path: str) -> None:
    """The whole table as CSV at a fixed path; a failing job leaves the old one."""
    _swapped(df, path, "csv")


def publish_append(df: DataFrame, path: str, file_format: str = "csv") -> None:
    """More files beside those that are there."""
    _writer(even(df), file_format).mode("append").save(path)


def publish_dated(df: DataFrame, path: str, run_date: date, file_format: str = "csv") -> None:
    """The run's rows in the folder of its day; the day's earlier drop is replaced.

    The folder is the target of the write: with one value there is nothing to sort.
    """
    _writer(even(df), file_format).mode("overwrite").save(f"{path.rstrip('/')}/dt={run_date.isoformat()}")


def replace_partition(df: DataFrame, path: str, *columns: str, file_format: str = "parquet") -> None:
    """Replace the partitions the rows fall in and leave the others alone.

    The rows are one commit of the table: written once, seen by readers at once, nothing moved.
    """
    commits.write(spread_by(df, *columns), path, columns, writer=lambda rows: _writer(rows, file_format))


def bounded_files(df: DataFrame, path: str, max_records: int = MAX_RECORDS) -> None:
    """Snappy parquet in files of at most ``max_records`` rows, nested columns kept."""
    _writer(even(df), "parquet", max(max_records, 0)).mode("overwrite").save(path)


def append_run(df: DataFrame, path: str, run_date: date, run_id: str, max_records: int = 0) -> None:
    """Add one run below ``dt=…/id_execucao=…``; its id moves from the rows into the folder name.

    Only the run's own folder is written, so a retried run does not add its rows twice.
    """
    folder = f"{path.rstrip('/')}/dt={run_date.isoformat()}/id_execucao={run_id}"
    _writer(even(df.drop("id_execucao")), "parquet", max_records).mode("overwrite").save(folder)


def full_refresh(df: DataFrame, path: str) -> None:
    """The whole table anew; a failing job leaves the old one."""
    _swapped(df, path, "parquet")


def merge_range(
    spark: SparkSession,
    snapshot: DataFrame,
    path: str,
    start: date | str,
    end: date | str,
    column: str = "DT",
) -> None:
    """Delete the target's days from ``start`` to ``end``, both included, and add the snapshot.

    ``DT`` is the partition, so no target row is read. The snapshot is evaluated and written once, as a commit
    that takes the place of the range: rows outside it are added to what is there, and days of the range that the
    snapshot lacks are gone. Readers see the old days or the new ones, whenever the run ends or dies.
    """
    low, high = wall_time(start).date(), wall_time(end).date()
    commits.write(spread_by(snapshot, column), path, [column], (column, low, high), lambda rows: _writer(rows, "parquet"))


def publish_version(df: DataFrame, path: str) -> str:
    """Write a small table as the next version below ``path``; the one it came from is not touched."""
    spark = df.sparkSession
    taken = [int(n[2:]) for n in storage.child_folders(spark, path) if n.startswith("v=") and n[2:].isdigit()]
    target = f"{path.rstrip('/')}/v={max(taken, default=0) + 1}"
    df.write.parquet(target)
    return target


def destination_path(file_name: Column, folder: Column, write_mode: Column, extension: Column, run_date: date) -> Column:
    """Where a file's table goes: ``folder/stem.ext``, or a dated folder when partitioned."""
    base = F.regexp_extract(file_name, r"([^/\\]*)$", 1)
    stem = F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")
    name = F.concat(stem, F.lit("."), extension)
    dated = F.concat(folder, stem, F.lit(f"/dt={run_date.isoformat()}/"), name)
    return F.when(write_mode == "partitioned", dated).otherwise(F.concat(folder, name))


# Marks in a file's name and the folder of its period.
PERIOD_FOLDERS = {"FF_107": "semanal", "RPE_117": "mensal"}


def period_folder(file_name: Column, marks: dict[str, str] | None = None) -> Column:
    """Weekly or monthly folder by the mark in the file's name; the mark listed first wins."""
    folder = F.lit(None).cast("string")
    for mark, name in reversed((marks or PERIOD_FOLDERS).items()):
        folder = F.when(file_name.contains(mark), F.lit(name)).otherwise(folder)
    return folder


def zone_path(source: Column) -> Column:
    """Landing path of a transient file: zone renamed, ``.gz`` to ``.parquet``."""
    parquet = F.replace(source, F.lit(".gz"), F.lit(".parquet"))
    return F.replace(parquet, F.lit("transient"), F.lit("landing"))


def output_name(file_name: str, extension: str = "parquet") -> str:
    """A source file's stem with the new extension."""
    return f"{PurePosixPath(file_name).stem}.{extension}"
