"""Date and timestamp expressions. Results are ``timestamp_ntz`` or ``date``, so that no result
depends on the session's time zone."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.text import trim_all

# Shape of the accepted text, and of a text that names its offset from UTC.
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
_DIGITS = r"^\s*[+-]?\d{4}"  # anything else is no date, and a failing cast costs an exception
_ZONED = r":\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})\s*$"


def utc_clock(text: Column) -> Column:
    """Text to UTC wall clock: an offset at the end is applied, text without one is taken as it is."""
    clock = F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})\s*$", "").try_cast("timestamp_ntz")
    zone = F.regexp_replace(F.regexp_extract(text, _ZONED, 2), ":", "")
    minutes = F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, 4, 2).try_cast("int")
    offset = F.when(zone == "Z", 0).when(zone.startswith("-"), -minutes).otherwise(minutes)
    # the offset is worked out only for text that has one
    return F.when(text.rlike(_ZONED), F.timestamp_add("MINUTE", -offset, clock)).when(
        text.rlike(_DIGITS), text.try_cast("timestamp_ntz")
    )


def parse_iso(c: Column) -> Column:
    """Best-effort ISO timestamp as UTC wall clock; other text gives null."""
    text = trim_all(c.cast("string"))
    return F.when(text.rlike(_ISO), utc_clock(text))


def iso_day(c: Column) -> Column:
    """The calendar day written in an ISO timestamp, in its own zone; null when it does not parse."""
    text = trim_all(c.cast("string"))
    clock = F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz")
    return F.when(text.rlike(_ISO), clock.cast("date"))


def coerce_datetime(c: Column) -> Column:
    """UTC datetime of a value of any type; what does not parse becomes null."""
    return utc_clock(c.cast("string"))


def strict_day(c: Column) -> Column:
    """``yyyy-MM-dd`` only; anything else fails the query."""
    return F.to_date(c, "yyyy-MM-dd")


def lenient_day(c: Column, run_date: date) -> Column:
    """``yyyy-MM-dd`` after stripping; blank or bad text gives the run date."""
    text = trim_all(c)
    ok = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    return F.coalesce(F.when(ok, F.try_to_date(text, "yyyy-M-d")), F.lit(run_date.isoformat()).cast("date"))


def utc_instant(text: Column) -> Column:
    """Text as Spark reads an instant: where it names no offset, UTC is added to it.

    Text without a date is left out, as Spark would put today's date before a bare time.
    """
    bare = F.rtrim(text)
    with_zone = F.when(F.length(bare) <= 10, F.concat(bare, F.lit(" 00:00:00Z"))).otherwise(F.concat(bare, F.lit("Z")))
    dated = F.when(text.rlike(_ZONED), text).otherwise(with_zone)
    return F.when(text.rlike(r"^\s*\d{4}-"), dated)


def iso_text(c: Column, dtype: T.DataType | None = None) -> Column:
    """ISO text of a timestamp, in UTC; a fraction, of six digits, only where there is one.

    Through the value's own text and not ``date_format``, which would read a wall clock in the
    session's zone and move the hours that zone skips.
    """
    if isinstance(dtype, T.TimestampType):
        c = F.timestamp_add("MICROSECOND", F.unix_micros(c), ntz(datetime(1970, 1, 1)))
    text = c.cast("string")
    seconds = F.replace(F.left(text, F.lit(19)), F.lit(" "), F.lit("T"))
    fraction = F.substring(text, 21, 6)
    return F.when(fraction == "", seconds).otherwise(F.concat(seconds, F.lit("."), F.rpad(fraction, 6, "0")))


def wall_time(value: date | datetime | str) -> datetime:
    """A window bound as a wall clock time, through its ISO form; a time of day only from a datetime."""
    if isinstance(value, str) and not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
        raise ValueError(f"not a day: {value!r}")
    return datetime.fromisoformat(value if isinstance(value, str) else value.isoformat())


def ntz(value: datetime) -> Column:
    """A wall-clock literal. Through text, so neither the client's nor the session's zone shifts it."""
    return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def bound(value: datetime, dtype: T.DataType) -> Column:
    """A literal of a column's own type, so that a comparison with it reaches the scan. UTC for instants."""
    midnight = value.time() == datetime.min.time()
    if isinstance(dtype, T.TimestampType):
        return F.lit(f"{value.replace(tzinfo=None).isoformat(sep=' ')}Z").cast("timestamp")
    if isinstance(dtype, T.DateType) and midnight:
        return F.lit(value.date().isoformat()).cast("date")
    return ntz(value)


def run_day(explicit: str | None, run_date: date, days_back: int = 0) -> Column:
    """The folder day of a run: the day it was given, else one ``days_back`` before the run.

    Blank text counts as not given; text that is no day gives the day of the run itself.
    """
    given = F.lit(explicit).cast("string")
    earlier = F.lit((run_date - timedelta(days=days_back)).isoformat()).cast("date")
    return F.when(trim_all(given) != "", lenient_day(given, run_date)).otherwise(earlier)
