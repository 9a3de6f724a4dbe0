"""Types of a folder's text columns, looked for only in files that are new.

What type inference needs of a file is one set of bits a column: which kinds of values stand in it. Such sets are merged
by a bitwise or, so they are kept by file in a book beside the folder, and a later run opens only the files that the
book does not know as they are now. The outcome is that of a look at all values: a file that was written again counts
as it is now, and one that is gone counts no longer, so that a column may become narrower again.

The book is a table of entries, one for each run that found new files. An entry counts once it is written whole; a run that
dies before leaves nothing, and files noted twice change nothing. A book of many entries is written anew as one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import storage
from quayside.operators.casting import infer_types, type_of_kinds, value_kind
from quayside.session import scratch_path
from quayside.sources.listing import LOOKS, listing, plain_column

_FILE = ["path", "modified", "length"]
_BOOK = f"{LOOKS}, column string, kinds int"


@dataclass(frozen=True)
class FolderTypes:
    """The type of each text column, and which files were opened to know it."""

    types: dict[str, str]
    opened: list[str]


def _entries(spark: SparkSession, book: str) -> list[str]:
    """Entries that were written whole, oldest first."""
    names = [n for n in storage.child_folders(spark, book) if n.startswith("entry=")]
    whole = [n for n in names if storage.exists(spark, f"{book}/{n}/_SUCCESS")]
    return sorted(whole, key=lambda n: int(n.removeprefix("entry=")))


def _next_entry(spark: SparkSession, book: str) -> str:
    numbers = [int(n.removeprefix("entry=")) for n in storage.child_folders(spark, book) if n.startswith("entry=")]
    return f"{book}/entry={max(numbers, default=0) + 1:08d}"


def _read(spark: SparkSession, book: str, entries: list[str]) -> DataFrame:
    if not entries:
        return spark.createDataFrame([], _BOOK)
    return spark.read.schema(_BOOK).parquet(*[f"{book}/{e}" for e in entries])


def _noted(spark: SparkSession, files: DataFrame, label: str) -> DataFrame:
    """A list of files written down, so that it stays what it was."""
    at = scratch_path(spark, label)
    files.write.parquet(at)
    return spark.read.schema(LOOKS).parquet(at)


def kinds_by_file(df: DataFrame) -> DataFrame:
    """``path, column, kinds`` of the text columns of a scan: one set of bits for each file and column.

    Bits are or-ed within a task before anything is shuffled, so a file of any size sends a row for each of its splits.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return df.sparkSession.createDataFrame([], "path string, column string, kinds int")
    file = plain_column(F.col("_metadata.file_path")).alias("path")
    values = df.select(file, *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)])
    found = values.groupBy("path").agg(*[F.bit_or(value_kind(F.col(f"c{i}"))).alias(f"k{i}") for i in range(len(names))])
    each = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"k{i}").alias("kinds")) for i, n in enumerate(names)])
    return found.select("path", F.inline(each))


def folder_types(
    spark: SparkSession, path: str, book: str, file_format: str = "parquet", most_entries: int = 64, pattern: str | None = None, **options
) -> FolderTypes:
    """The narrowest types of the text columns of all files below ``path``; only files the book does not know are opened.

    ``options`` are the reader's. Columns of partition folders are the reader's to type and are left out. Beyond
    ``most_entries`` entries the book is written as one. Files that change while they are read are read again next time,
    as they are noted with what they looked like before. Delimited files of one folder have one header. A book belongs
    to one folder and has one writer at a time.
    """
    book = book.rstrip("/")
    pattern = pattern or {"parquet": "*.parquet"}.get(file_format, "*")
    # one look at the folder for the whole call: what comes while it runs is the next call's
    present = _noted(spark, listing(spark, path, recursiveFileLookup=True, pathGlobFilter=pattern), "files")
    entries = _entries(spark, book)
    known = _read(spark, book, entries)
    new = _noted(spark, present.join(known.select(*_FILE).distinct(), _FILE, "left_anti"), "new-files")
    opened = sorted(r["path"] for r in new.select("path").collect())  # the reader takes a list of paths
    if opened:
        reader = spark.read.format(file_format).options(**({"mergeSchema": True} if file_format == "parquet" else {}) | options)
        found = kinds_by_file(reader.load(opened))
        # a file without rows or text columns is noted too, so that it is not opened again
        notes = new.join(found, "path", "left").select(*_FILE, "column", "kinds")
        entry = _next_entry(spark, book)
        notes.coalesce(1).write.parquet(entry)
        entries.append(entry.rsplit("/", 1)[-1])
        known = _read(spark, book, entries)
    current = known.join(present, _FILE, "left_semi")
    if len(entries) > most_entries:
        merged = _next_entry(spark, book)
        current.groupBy(*_FILE, "column").agg(F.bit_or("kinds").alias("kinds")).coalesce(1).write.parquet(merged)
        for old in entries:
            storage.delete(spark, f"{book}/{old}")
        current = _read(spark, book, [merged.rsplit("/", 1)[-1]])
    columns = current.where("column is not null").groupBy("column").agg(F.bit_or("kinds").alias("kinds"))
    return FolderTypes({r["column"]: type_of_kinds(r["kinds"]) for r in columns.collect()}, opened)


def infer_folder(spark: SparkSession, path: str, book: str, file_format: str = "parquet", **options) -> DataFrame:
    """A folder with its text columns cast to the types that all its values fit, found by way of the book."""
    found = folder_types(spark, path, book, file_format, **options)
    reader = spark.read.format(file_format).options(**({"mergeSchema": True} if file_format == "parquet" else {}) | options)
    df = reader.load(path)
    # a file that came after the look may have text columns that are not known yet: they stay text
    return infer_types(df, {c: t for c, t in found.types.items() if c in df.columns})
