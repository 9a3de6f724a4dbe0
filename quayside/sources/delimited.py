"""Delimited text."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import storage
from quayside.functions.coerce import to_number
from quayside.sources.columns import use_columns

# Words that stand for a missing value in a delimited file.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Encoding names as other tools spell them.
ENCODINGS = {"latin1": "ISO-8859-1", "latin-1": "ISO-8859-1", "utf8": "UTF-8", "utf-8-sig": "UTF-8"}


def words_to_null(df: DataFrame, words: Sequence[str]) -> DataFrame:
    if not words:
        return df
    return df.select([F.when(~F.col(f"`{c}`").isin(*words), F.col(f"`{c}`")).alias(c) for c in df.columns])


def decimal_number(c: Column, mark: str = ".") -> Column:
    """Text with the given decimal mark to double."""
    return to_number(c if mark == "." else F.replace(c, F.lit(mark), F.lit(".")))


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    header: int | None = 0,
    decimal: str = ".",
    decimal_columns: Sequence[str] = (),
    usecols: str | None = None,
    null_words: Sequence[str] = NULL_WORDS,
    quote: str | None = '"',
    multi_line: bool = False,
    glob: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Every column as text; ``decimal_columns`` as double under the file's decimal mark.

    ``header`` is the row that holds the names, ``None`` for none. All files of the path share one
    layout. ``columns`` names them without a look at the files. Splits stay parallel unless quoted
    line breaks (``multi_line``) forbid it.
    """
    options = {
        "sep": sep,
        "encoding": ENCODINGS.get(encoding.lower(), encoding),
        "quote": quote or "",
        "escape": quote or "",
        "multiLine": multi_line,
        # names that were not given come from a file: one with others, or in another order, then fails the read
        "enforceSchema": columns is not None,
    }
    if glob:
        options["pathGlobFilter"] = glob
    reader = spark.read.options(**options)
    if header is None or header == 0:
        reader = reader.option("header", header == 0)
        if columns:
            reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        df = reader.csv(path)
    else:
        df = _below_header(spark, options, path, header, columns)
    df = words_to_null(use_columns(df, usecols), null_words)
    return df.withColumns({c: decimal_number(F.col(f"`{c}`"), decimal) for c in decimal_columns})


def _below_header(spark: SparkSession, options: Mapping, path, header: int, columns: Sequence[str] | None) -> DataFrame:
    """Names from row ``header`` of the files, data from the rows below it.

    The rows above are the first of a file's first split, and a task reads a split in order; so the scan itself passes
    over them, whatever the splits are, and no row is shuffled. Blank lines are no rows.
    """
    files = storage.files_read(spark.read.options(**{k: v for k, v in options.items() if k == "pathGlobFilter"}).text(path))
    # a quoted line break may make a row of several lines
    lines = storage.first_lines(spark, files, header + 1 + (100 if options["multiLine"] else 0), options["encoding"])
    heads = {file: next(islice(_records(found, options), header, None), None) for file, found in lines.items()}
    names = next((h for h in heads.values() if h is not None), None)
    if names is None:
        raise ValueError(f"no row {header} to take column names from")
    if columns is None:
        if odd := [f for f, h in heads.items() if h is not None and h != names]:
            raise ValueError(f"{odd[0]} has other columns than the files before it")
        columns = [n if n else f"Unnamed: {i}" for i, n in enumerate(names)]
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))]
    raw = spark.read.options(**options, header=False).schema(T.StructType(fields)).csv(path)
    placed = raw.select("*", F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.file_block_start") == 0).alias("_first"))

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, passed = None, 0
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            if pc.any(batch.column("_first")).as_py():
                runs = pc.run_end_encode(batch.column("_file"))
                start = 0
                for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                    if name != file:
                        file, passed = name, 0
                    if batch.column("_first")[start].as_py():
                        above = min(header + 1 - passed, end - start)
                        keep[start : start + above] = False
                        passed += max(above, 0)
                    start = end
            yield batch.select([f.name for f in fields]).filter(pa.array(keep))

    return placed.mapInArrow(below, T.StructType(fields)).toDF(*columns)


def _records(lines: Sequence[str], options: Mapping) -> Iterator[list[str]]:
    """Lines cut into values by the file's separator and quote."""
    if len(options["sep"]) > 1 or not options["quote"]:
        return (line.split(options["sep"]) for line in lines)
    return csv.reader((f"{line}\n" for line in lines), delimiter=options["sep"], quotechar=options["quote"])


def scan_gz_pipe(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Gzip files of pipe-separated UTF-8 text without quoting; other files are passed over.

    Each file's values go by its own header; files may differ in the order and in the set of columns. A gzip file
    cannot be split: one task reads one file, its rows in order. Writers below rebalance what it yields.
    """
    return pipe_files(spark, storage.files_read(spark.read.option("pathGlobFilter", "*.gz").text(path)), columns).drop("file")


def pipe_files(spark: SparkSession, files: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Values of pipe files by the header of their file, a missing column null; with the ``file`` each row is of.

    Headers come from the files' first blocks; the files of one layout are one scan, which cuts lines by position
    and reads each file once.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file, lines in storage.first_lines(spark, files).items():
        if lines:
            layouts.setdefault(tuple(lines[0].split("|")), []).append(file)
    if columns is None:
        columns = list(dict.fromkeys(name for names in sorted(layouts) for name in names))
    text, parts = T.StringType(), []
    options = {"sep": "|", "quote": "", "escape": "", "header": True, "enforceSchema": True, "encoding": "UTF-8"}
    for names, own in sorted(layouts.items()):
        # a name that comes twice counts where it comes first
        schema = T.StructType([T.StructField(f"c{i}", text) for i in range(len(names))])
        rows = spark.read.options(**options).schema(schema).csv(own)
        values = [F.col(f"c{names.index(c)}") if c in names else F.lit(None).cast(text) for c in columns]
        parts.append(rows.select(F.col("_metadata.file_path").alias("file"), *[v.alias(c) for v, c in zip(values, columns)]))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(c, text) for c in ["file", *columns]]))
    return words_to_null(reduce(DataFrame.unionAll, parts), NULL_WORDS)


def csv_layouts(spark: SparkSession, path: str, glob: str) -> dict[str, list[str]]:
    """Files of a folder by their first line, so that files of different layouts are read apart."""
    layouts: dict[str, list[str]] = {}
    for file, lines in storage.first_lines(spark, storage.files_read(spark.read.option("pathGlobFilter", glob).text(path))).items():
        if lines:
            layouts.setdefault(lines[0], []).append(file)
    return layouts
