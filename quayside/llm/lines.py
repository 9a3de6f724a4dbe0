"""Lines that many documents share: hashes counted over documents, shared lines dropped, the rest put together again.

A line's key is the line without white space at its ends, A-Z in lower case. Each document sends the hash of each of
its keys once, so a hash's count is its number of documents, and partial counts meet before they are shuffled. Only
hashes and places of lines move to find what goes; what is dropped depends on a text alone, so it is kept by the text's
digest, once for all copies, and each text meets it in one join. Nothing is Python and nothing is collected.

Rules. A row is a document, also where ids repeat or are null. A null text is an empty one, which has one empty line.
Keys shorter than ``min_chars`` are never dropped. All lines of a dropped key go, in every document; the first line
break of two lines goes with the line. Of the table only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.components import stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACES = " \t\n\x0b\f\r"


def keys(text: Column) -> Column:
    """The key of each line, in order."""
    lower = F.translate(text, _UPPER, _UPPER.lower())
    return F.transform(F.split(lower, "\n"), lambda line: F.btrim(line, F.lit(_SPACES)))


def digest(name: str, text: Column) -> list[Column]:
    """128 bits of a text in two columns: at any number of lines two keys do not meet by chance."""
    return [F.xxhash64(text).alias(f"{name}1"), F.xxhash64(F.lit(1), text).alias(f"{name}2")]


def shared_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``h1, h2, n_docs``: digests of the keys that stand in ``min_docs`` documents or more."""
    # the keys of a document are made distinct as strings, in its own row
    own = docs.select(F.explode(F.array_distinct(keys(F.coalesce(F.col(text), F.lit(""))))).alias("key"))
    counted = own.where(F.char_length("key") >= min_chars).select(*digest("h", F.col("key"))).groupBy("h1", "h2")
    return counted.agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs)


def drop_shared_lines(
    spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1
) -> DataFrame:
    """``id, kept, n_lines, n_dropped`` of each row: the text without its shared lines, and how many lines it had and lost."""
    shared = stored(spark, shared_lines(docs, text, min_docs, min_chars).select("h1", "h2"), "lines")
    whole = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # a text's digest is made below the explode, once for each text
    placed = whole.select(*digest("d", F.col("text")), keys(F.col("text")).alias("keys")).select("d1", "d2", F.posexplode("keys").alias("place", "key"))
    placed = placed.where(F.char_length("key") >= min_chars).select("d1", "d2", "place", *digest("h", F.col("key")))
    gone = placed.join(shared, ["h1", "h2"], "left_semi").groupBy("d1", "d2").agg(F.collect_set("place").alias("gone"))
    # the lines are cut below the join: taking one by its place above it is then a look, not another cut of the text
    lines = whole.select("id", F.split("text", "\n").alias("lines"), *digest("d", F.col("text")))
    n = F.size("lines")
    left = F.array_except(F.sequence(F.lit(0), n - 1), F.coalesce("gone", F.array().cast("array<int>")))
    return lines.join(gone, ["d1", "d2"], "left").select(
        "id",
        F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n").alias("kept"),
        n.cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
