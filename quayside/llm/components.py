"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import storage
from quayside.session import scratch_path


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again: what follows does not go back further.

    The shuffle files of earlier steps are not needed then. Spark drops them once the driver has collected its own
    garbage, which is asked for here, so that a long run does not keep the files of all its steps.
    """
    path = scratch_path(spark, label)
    spark.sparkContext._jvm.System.gc()
    df.write.parquet(path)
    return spark.read.parquet(path)


def dropped(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            storage.delete(spark, folder)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b): the smallest node that can be reached.

    Each round every node takes the smallest root among its neighbours' and then that root's own root, so the
    number of rounds grows with the logarithm of a chain's length, about. Links inside a component are dropped as
    they are found; a hub's links meet in partial minima before the shuffle.
    """
    links = stored(spark, edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = stored(spark, both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), "roots")
    while True:
        # links between the roots of their ends
        ends = links.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        ends = ends.join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        open_links = ends.where("ra <> rb").select(F.least("ra", "rb").alias("low"), F.greatest("ra", "rb").alias("high"))
        jump = open_links.groupBy(F.col("high").alias("root")).agg(F.min("low").alias("to"))
        # a root may itself have moved: follow it once more
        nested = roots.select(F.col("node").alias("to"), F.col("root").alias("far"))
        jump = jump.join(nested, "to", "left").select("root", F.least("to", F.coalesce("far", "to")).alias("to"))
        moved = stored(spark, roots.join(jump, "root", "left").select("node", F.col("root").alias("was"), F.coalesce("to", "root").alias("root")), "roots")
        changed = moved.where("was <> root").limit(1).count()
        roots = moved.select("node", "root")
        if not changed:
            return roots
