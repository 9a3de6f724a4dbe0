"""Column-name rules. Names are metadata, so these run on the driver and cost no job."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DROPPED = re.compile(r"[^A-Za-z0-9_ ]+")


def plain_name(name: str) -> str:
    """Accents off, only ASCII letters, digits and ``_`` kept, blanks to ``_``, upper case.

    After NFD every accent is a character of its own outside the kept set, so one pattern removes
    the accents, the cedilla and the other special characters.
    """
    return "_".join(_DROPPED.sub("", unicodedata.normalize("NFD", name)).split()).upper()


def safe_name(name: str) -> str:
    """Dots, dollar signs and spaces to ``_``."""
    return re.sub(r"[.$ ]", "_", name)


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Apply a name rule to every column; two columns ending up with one name is an error."""
    renamed = [rule(c) for c in df.columns]
    clashes = sorted(n for n, k in Counter(n.lower() for n in renamed).items() if k > 1)
    if clashes:
        raise ValueError(f"columns collide after renaming: {', '.join(clashes)}")
    if "" in renamed:
        raise ValueError("a column name is empty after renaming")
    return df.toDF(*renamed)


def normalize_names(df: DataFrame) -> DataFrame:
    return rename_all(df, plain_name)


def sanitize_names(df: DataFrame) -> DataFrame:
    return rename_all(df, safe_name)


def external_name(target: Column) -> Column:
    """``ext_`` plus the lower-cased target name with double underscores made single."""
    return F.concat(F.lit("ext_"), F.replace(F.lower(target), F.lit("__"), F.lit("_")))
