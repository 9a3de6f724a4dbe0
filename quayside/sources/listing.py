"""Files below a folder as rows, and one spelling of their paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a file looks like without a look into it; a file that was written again looks otherwise.
LOOKS = "path string, modified timestamp_ntz, length long"


def looks(files: DataFrame) -> DataFrame:
    """``path, modified, length`` of a scan of files; their content is not read."""
    # a moment, whatever the session's zone is
    modified = F.timestamp_micros(F.unix_micros("modificationTime")).cast("timestamp_ntz")
    return files.select("path", modified.alias("modified"), "length")


def listing(spark: SparkSession, path: str, **options) -> DataFrame:
    """``path, modified, length`` of the files that are there."""
    return looks(spark.read.format("binaryFile").options(**options).load(path))


def plain_path(path: str) -> str:
    """One spelling of a path, whether it came from a listing or from a row."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def plain_column(file: Column) -> Column:
    """The same for the paths that a scan gives its rows, which are encoded."""
    decoded = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^(\w+):/+", "$1:/")
