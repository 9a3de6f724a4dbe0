"""Text expressions, all native so they stay inside whole-stage code generation."""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEPT = set(string.ascii_letters + string.digits + "_ ")

# Marks of text that was UTF-8 but was read as Latin-1.
MOJIBAKE_MARKS = "[Ãâ�]"

# Words that must all occur, and the name they stand for. A caller adds their own.
BRAND_RULES: tuple[tuple[tuple[str, ...], str], ...] = ((("pague", "menos"), "Pague Menos"),)


@cache
def _accent_table() -> tuple[str, str]:
    """Every BMP character whose decomposition holds one kept character, and that character.

    Behind them the common characters that stand for none: ``translate`` drops what has no partner.
    """
    accented, plain = [], []
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        parts = [ch for ch in unicodedata.normalize("NFD", chr(code)) if ch in _KEPT]
        if len(parts) == 1:
            accented.append(chr(code))
            plain.append(parts[0])
    common = (chr(code) for code in (*range(1, 0x370), *range(0x2000, 0x2070)))
    dropped = [ch for ch in common if ch not in _KEPT and ch not in accented]
    return "".join(accented + dropped), "".join(plain)


# Every character that counts as white space, line and no-break kinds included.
_WHITE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def trim_all(c: Column) -> Column:
    """Strip every kind of white space, where ``trim`` by itself strips spaces only."""
    return F.trim(c, F.lit(_WHITE))


def blank_to_null(c: Column) -> Column:
    return F.when(trim_all(c) != "", c)


def strip_accents(c: Column) -> Column:
    """Plain letters for accented ones; what is left outside letters, digits, ``_`` and space goes.

    Spark has no Unicode decomposition; ``translate`` with the table of all decomposable characters
    does the same for every character of the basic plane. The slower pattern only sees text that
    holds something rarer.
    """
    table, plain = _accent_table()
    text = F.translate(c, table, plain)
    rare = "[^A-Za-z0-9_ ]"
    return F.when(text.rlike(rare), F.regexp_replace(text, rare, "")).otherwise(text)


def fix_mojibake(c: Column, strict_reference: bool = False) -> Column:
    """Undo UTF-8 text that was decoded as Latin-1; other text is only stripped.

    ``strict_reference`` strips and repairs nothing, which is what the original rule comes to: its
    guard asks for at least as many non-ASCII characters after the repair as before, and a repair
    always merges some.
    """
    text = trim_all(c)
    if strict_reference:
        return text
    raw = F.encode(text, "ISO-8859-1")
    repaired = F.when(F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8")).otherwise(text)
    suspect = text.rlike(MOJIBAKE_MARKS)
    latin1 = text.rlike(r"^[\x00-\xFF]*$")
    # nested, so that encode never sees a character Latin-1 lacks
    return F.when(suspect, F.when(latin1, repaired).otherwise(text)).otherwise(text)


def title_case(c: Column) -> Column:
    """Upper case after every character that is no letter; ``initcap`` alone does so after blanks."""
    split = F.regexp_replace(c, r"(?<=[^\p{L}\p{M} ])(?=\p{L})", "\u0001 ")
    return F.replace(F.initcap(split), F.lit("\u0001 "), F.lit(""))


def with_entity_name(
    df: DataFrame,
    name: str,
    *candidates: Column,
    brand_rules: Sequence[tuple[Sequence[str], str]] = BRAND_RULES,
    strict_reference: bool = False,
) -> DataFrame:
    """Add one comparable name, taken from the first candidate that is not blank.

    Lower case, brand rules, ``www.`` off, the part before the first dot, letters, digits and blanks
    only, title case. Nothing left gives null. Each step is a projection of its own, so a value that
    the next step uses several times is worked out once.
    """
    s, letters = F.col("_s"), F.col("_letters")
    host = F.substring_index(F.regexp_replace(s, r"^www\.", ""), ".", 1)
    result = F.when(letters != "", title_case(letters))
    for words, brand in reversed(list(brand_rules)):
        found = F.lit(True)
        for word in words:
            found = found & s.contains(word)
        result = F.when(found, F.lit(brand)).otherwise(result)
    return (
        df.withColumn("_s", trim_all(F.coalesce(*[blank_to_null(c) for c in candidates])))
        .withColumn("_s", F.lower(trim_all(fix_mojibake(s, strict_reference))))
        .withColumn("_letters", trim_all(F.regexp_replace(host, r"(?U)[^a-zA-Z0-9\s]", "")))
        .withColumn(name, result)
        .drop("_s", "_letters")
    )


def url_host(c: Column) -> Column:
    """Network location of a URL, or its path when there is none; trailing slashes off."""
    netloc = F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    rest = F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.\-]*:|[?#].*$", "")
    path = F.regexp_replace(rest, r"^//[^/]*", "")
    return F.regexp_replace(F.when(netloc != "", netloc).otherwise(path), "/+$", "")
