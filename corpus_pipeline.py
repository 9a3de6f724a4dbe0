"""The training-data pipeline over ``documents``: stages in order, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontam, jaccard, mixing, quality, queries, sharding
from quayside.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives 0.3 or more; it is trained on labelled rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality.train(spark, docs, labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return quality.keep_good(spark, docs, net)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by five-word shingles at 0.8 or more."""
    return jaccard.keep_one(spark, docs, length=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window of ten words stands."""
    return decontam.decontaminate(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens at most, by the weights of domains and languages; no document comes twice."""
    total = F.floor(F.col("held") * 9 / 10)
    # names of their own for the added columns, so that no column of the documents gives way to them
    added = {"epoch_col": "__epoch_taken", "tokens_col": "__tokens_taken"}
    mixed = mixing.mix(spark, docs, queries.levels(), queries.WEIGHTS, total, max_epochs=1, seed=17, **added)
    return mixed.select(*[mixed[c] for c in docs.columns])


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes: shard and place in it."""
    placed = sharding.shard(spark, docs, shards=24)
    return placed.select(F.col("id").alias("doc_id"), "size", "tokens", "text_crc32", F.col("shard").cast("int"), F.col("slot").cast("bigint"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("sharding", sharding_stage),
]

#: A trained network stands first, which SQL cannot express; the tests compare the run with its stages, and operators with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
