"""Ingest files as they arrive, and again when they are sent again.

The stream's checkpoint remembers paths, so it takes each path once. A ledger beside it remembers what a path looked like
when it was read, its time and its length; a file that looks otherwise now was sent again, and its rows take the place of
those it gave before. Each file's rows are a partition of the target, so that one file is replaced without a look at others.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from quayside import commits, storage
from quayside.operators.casting import cast_to_schema
from quayside.plans.publish import spread_by
from quayside.plans.runs import observed
from quayside.sources.delimited import pipe_files
from quayside.sources.listing import LOOKS, listing, looks, plain_column, plain_path

RUN, ARRIVAL = "run", "arrival"
_LEDGER = LOOKS
#: Gzip files at any depth.
_FILES = {"pathGlobFilter": "*.gz", "recursiveFileLookup": True}


def arriving_files(
    spark: SparkSession, path: str, max_files: int | None = None, archive: str | None = None
) -> DataFrame:
    """Stream of the ``.gz`` files that are new; their lines are read by layout once a batch says which they are.

    With ``archive`` files of finished batches are moved there by the stream.
    """
    options: dict = dict(_FILES)
    if max_files:
        options["maxFilesPerTrigger"] = max_files
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    schema = "path string, modificationTime timestamp, length long, content binary"
    return looks(spark.readStream.format("binaryFile").schema(schema).options(**options).load(path))


def _run_of(path: str) -> str:
    found = re.search(r"/run=([^/]+)/", path)
    return found[1] if found else ""


def _arrival(path: str) -> str:
    """The name of a file's partition."""
    return hashlib.sha256(path.encode()).hexdigest()[:20]


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """What each path looked like when it was last read."""
    if not storage.child_folders(spark, path):
        return spark.createDataFrame([], _LEDGER)
    notes = spark.read.schema(f"{_LEDGER}, entry long").parquet(path)
    last = notes.groupBy("path").agg(F.max_by(F.struct("modified", "length"), "entry").alias("l"))
    return last.select("path", "l.modified", "l.length")


def _publish(
    spark: SparkSession, files: Sequence[str], target: str, columns: Sequence[str], schema: Mapping[str, str], rejects: str | None
) -> None:
    """Type the rows of these files and put them in the place of the rows the same files gave before."""
    seen = Observation()
    own = plain_column(F.col("file"))
    rows = pipe_files(spark, files, columns).select(
        *columns,
        F.regexp_extract(own, r"/run=([^/]+)/", 1).alias(RUN),
        F.substring(F.sha2(own, 256), 1, 20).alias(ARRIVAL),
    )
    typed = cast_to_schema(rows, {**schema, RUN: "STRING", ARRIVAL: "STRING"}, seen)
    # a file may have lost all its rows: its partition goes all the same
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    places = [f"{RUN}={escaped(_run_of(f)) or '__HIVE_DEFAULT_PARTITION__'}/{ARRIVAL}={_arrival(f)}" for f in map(plain_path, files)]
    commits.write(spread_by(typed, RUN, ARRIVAL), target, [RUN, ARRIVAL], partitions=places)
    if rejects:
        found = [(name, number) for name, number in observed(seen).items() if name not in (RUN, ARRIVAL)]
        spark.createDataFrame(found, "column_name string, rejected long").write.mode("overwrite").parquet(rejects)


def stream_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    columns: Sequence[str],
    schema: Mapping[str, str],
    rejects: str | None = None,
    max_files: int | None = None,
    archive: str | None = None,
) -> None:
    """Type what arrived since the last call, and what was sent again, below ``run=…/arrival=…`` of the target.

    A batch that is tried again after a failure replaces its files' rows, so no row comes twice; so does a file that
    was sent again. The target is a table of commits: ``external_table`` reads it. The values that did not fit are
    counted in the pass that writes and kept per batch in ``rejects``. A file that is rewritten while a call reads it
    is read again by the next one.
    """
    if clash := {RUN, ARRIVAL} & {c.lower() for c in columns}:
        raise ValueError(f"columns with the names of the partitions: {sorted(clash)}")
    book = f"{checkpoint.rstrip('/')}-ledger"

    def ingest(files: list[Row], batch: str) -> None:
        _publish(spark, [f["path"] for f in files], target, columns, schema, f"{rejects.rstrip('/')}/batch={batch}" if rejects else None)
        # what they looked like before they were read: what has changed since differs from it
        entry = len(storage.child_folders(spark, book)) + 1
        spark.createDataFrame(files, _LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{book}/entry={entry}")

    before = ledger(spark, book).select("path", F.struct("modified", "length").alias("was"))
    changed = listing(spark, source, **_FILES).join(before, "path").where(F.struct("modified", "length") != F.col("was")).drop("was")
    if again := changed.orderBy("path").collect():  # one row for each file that is to be read
        # files that came again count down from -1, as batches of the stream count up
        ingest(again, str(-1 - sum(n.startswith("batch=-") for n in storage.child_folders(spark, rejects)) if rejects else -1))

    query = (
        arriving_files(spark, source, max_files, archive)
        .writeStream.foreachBatch(lambda batch, number: ingest(batch.collect(), str(number)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
