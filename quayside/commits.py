"""Partitioned tables written in commits: readers see a whole commit or nothing of it, and nothing is moved.

A commit is one write below a folder of its own, ``commit=00000007/DT=…/part-…``. Tasks put their files in place as they
finish; the job's ``_SUCCESS`` is the moment the commit counts. A small file beside it, written before, says what the
commit takes the place of: its own partitions, or all days of a range, so a day that the rows lack vanishes with
the rest. A reader lists the commits and leaves out the partitions that a later one replaced. They are deleted
afterwards, which changes no result: then the folder below is a plain partitioned table with one more column.

A run that dies before its end leaves the table as it was, and its files are swept by the next one. One that dies after
it leaves the new rows, and old partitions to be swept. One writer at a time.

Partition folders that lie in the table's folder itself, from plain writes, count as its first commit.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from quayside import storage

COLUMN = "commit"
_INFO = "_replaces.json"
_NAME = re.compile(rf"{COLUMN}=(\d+)$")


class Commit:
    """One complete commit: its folder, its partition folders (relative), and what it takes the place of."""

    def __init__(self, folder: str, info: dict, partitions: list[str]):
        self.folder, self.partitions, self.own = folder, partitions, {*partitions, *info.get("partitions", [])}
        self.columns: list[str] = info["columns"]
        self.range: dict | None = info["range"]
        self.schema = T.StructType.fromJson(info["schema"])

    def replaces(self, partition: str) -> bool:
        """Whether an earlier commit's partition is replaced by this one."""
        if self.range is None:
            return partition in self.own
        day = _day(partition, self.range["column"])
        return day is not None and self.range["from"] <= day.isoformat() <= self.range["to"]


def _day(partition: str, column: str) -> date | None:
    for part in partition.split("/"):
        name, _, value = part.partition("=")
        if name.lower() == column.lower():
            try:
                return date.fromisoformat(value)
            except ValueError:
                return None
    return None


def _names(spark: SparkSession, path: str) -> list[str]:
    """Commit folders in the order they were begun."""
    return sorted((n for n in storage.child_folders(spark, path) if _NAME.match(n)), key=lambda n: int(_NAME.match(n)[1]))


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a table of commits."""
    return bool(_names(spark, path.rstrip("/")))


def commits(spark: SparkSession, path: str) -> list[tuple[Commit, list[str]]]:
    """Complete commits, oldest first, each with its partitions that no later one replaced."""
    base = path.rstrip("/")
    whole = []
    for folder in (f"{base}/{n}" for n in _names(spark, base)):
        if storage.exists(spark, f"{folder}/_SUCCESS"):
            info = json.loads(storage.read_text(spark, f"{folder}/{_INFO}"))
            if not whole:
                plain = [p for p in storage.nested_folders(spark, base, len(info["columns"])) if not p.startswith(f"{COLUMN}=")]
                whole += [Commit(base, info | {"range": None, "partitions": []}, plain)] if plain else []
            whole.append(Commit(folder, info, storage.nested_folders(spark, folder, len(info["columns"]))))
    return [(c, [p for p in c.partitions if not any(later.replaces(p) for later in whole[i + 1 :])]) for i, c in enumerate(whole)]


def partition_days(spark: SparkSession, path: str, column: str = "DT") -> list[date]:
    """Days the table holds, from listings."""
    days = {_day(p, column) for _, live in commits(spark, path) for p in live}
    return sorted(d for d in days if d is not None)


def write(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    days: tuple[str, date, date] | None = None,
    writer: Callable[[DataFrame], DataFrameWriter] | None = None,
    partitions: Sequence[str] = (),
) -> None:
    """Add a commit of these rows. It replaces the partitions its rows fall in, or the ``days`` (column, first, last), both included.

    ``partitions`` (``a=1/b=2``) are replaced too, whether or not a row falls in them. ``df`` is evaluated once. ``writer`` makes the writer of a DataFrame; parquet is the default.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    if COLUMN in (c.lower() for c in df.columns):
        raise ValueError(f"a column called {COLUMN} would meet the commits' folders")
    begun = _names(spark, base)
    name = f"{COLUMN}={int(_NAME.match(begun[-1])[1]) + 1 if begun else 1:08d}"
    rest = T.StructType([f for f in df.schema if f.name not in columns] + [f for c in columns for f in df.schema if f.name == c])
    info: dict[str, Any] = {"columns": list(columns), "range": None, "partitions": list(partitions), "schema": rest.jsonValue()}
    if days:
        info["range"] = {"column": days[0], "from": days[1].isoformat(), "to": days[2].isoformat()}
    storage.write_text(spark, f"{base}/{name}/{_INFO}", json.dumps(info))
    out = writer(df) if writer else df.write.format("parquet")
    # tasks commit their files themselves: the job's end renames nothing
    out = out.option("mapreduce.fileoutputcommitter.algorithm.version", "2").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    out.mode("append").partitionBy(*columns).save(f"{base}/{name}")
    sweep(spark, base)


def sweep(spark: SparkSession, path: str) -> None:
    """Delete what no reader looks at: replaced partitions, and commits that were begun before the newest complete one and never ended."""
    base = path.rstrip("/")
    complete = commits(spark, base)
    for commit, live in complete:
        if not live and commit.folder != base and commit is not complete[-1][0]:
            storage.delete(spark, commit.folder)
            continue
        kept = set(live)
        for partition in commit.partitions:
            if partition not in kept:
                storage.delete(spark, f"{commit.folder}/{partition}")
    folders = {c.folder for c, _ in complete}
    newest = complete[-1][0].folder if complete else ""
    for name in _names(spark, base):
        if f"{base}/{name}" not in folders and f"{base}/{name}" < newest:
            storage.delete(spark, f"{base}/{name}")


def read(spark: SparkSession, path: str, file_format: str = "parquet", schema: T.StructType | str | None = None, **options) -> DataFrame:
    """The rows of all complete commits that no later one replaced, without the commits' own column."""
    base = path.rstrip("/")
    found = commits(spark, base)
    if not found:
        raise FileNotFoundError(f"no complete commit below {base}")

    def load(paths: list[str]) -> DataFrame:
        reader = spark.read.option("basePath", base).options(**options)
        return (reader if schema is None else reader.schema(schema)).format(file_format).load(paths)

    plain, paths = [], []
    for commit, live in found:
        own = [f"{commit.folder}/{p}" for p in live]
        if commit.folder == base:
            plain += own
        else:
            # a commit that nothing was taken from is read as a folder, another one by its partitions
            paths += own if len(live) < len(commit.partitions) else [commit.folder] if live else []
    # folders of two depths are two reads
    parts = [load(p) for p in (plain, paths) if p]
    if not parts:
        return spark.createDataFrame([], found[-1][0].schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.drop(COLUMN) for p in parts])
