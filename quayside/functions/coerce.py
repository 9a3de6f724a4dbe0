"""Coercing casts: a value that does not fit becomes null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.dates import coerce_datetime

# Text is matched before it is cast: a failing cast throws and catches an exception inside the JVM,
# which costs a hundred times what the match does. The patterns also keep out what only Java reads as
# a number ('1d', '2f', hexadecimal floats).
_WHOLE = r"^\s*[+-]?\d+\s*$"
_ZERO_FRACTION = r"^\s*[+-]?\d+\.0*\s*$"
_UNUSUAL = r"[eE]|^\s*[+-]?\.0+\s*$"
NUMBER = r"^\s*[+-]?(?:\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


# A whole number that fits a bigint whatever its digits are.
PLAIN_WHOLE = r"^\s*[+-]?\d{1,18}(?:\.0*)?\s*$"


def to_number(c: Column) -> Column:
    """Text to double; NaN counts as missing."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_integer(c: Column) -> Column:
    """Text to bigint. ``1e3`` and ``7.0`` are whole numbers, ``3.5`` is not; long ones stay exact."""
    text = c.cast("string")
    number = to_number(text)
    # the cast would take 2**63 itself, one too many, as the largest bigint
    whole = F.when((number == F.floor(number)) & (number < 2.0**63), number.try_cast("bigint"))
    return (
        F.when(text.rlike(_WHOLE), text.try_cast("bigint"))
        .when(text.rlike(_ZERO_FRACTION), F.substring_index(text, ".", 1).try_cast("bigint"))
        .when(text.rlike(_UNUSUAL), whole)
    )


def to_boolean(c: Column) -> Column:
    """Only ``true`` and ``false``, in any case; ``yes``, ``t`` and ``1`` are not booleans here."""
    text = F.lower(c.cast("string"))
    return F.when(text == "true", True).when(text == "false", False)


def to_datetime(c: Column) -> Column:
    return coerce_datetime(c)


def to_date(c: Column) -> Column:
    return coerce_datetime(c).cast("date")


# Warehouse column types and how text is coerced to them.
COERCIONS = {
    "INTEGER": to_integer,
    "INT64": to_integer,
    "FLOAT": to_number,
    "FLOAT64": to_number,
    "NUMERIC": to_number,
    "BIGNUMERIC": to_number,
    "BOOLEAN": to_boolean,
    "BOOL": to_boolean,
    "DATE": to_date,
    "DATETIME": to_datetime,
    "TIMESTAMP": to_datetime,
}
