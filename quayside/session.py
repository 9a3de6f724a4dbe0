"""Session settings for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "quayside", memory: str = "8g") -> SparkSession:
    """A local session with settings that suit tests; a cluster brings its own session."""
    partitions = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # a method over 8000 bytes is never compiled by the JVM; a wide typed select list gets there
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, in the folder all executors share.

    The folder is the cluster's ``spark.checkpoint.dir``, or the context's checkpoint folder. Only a session in
    one process that has neither is given a temporary one; on a cluster the other executors would not see it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="quayside-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
