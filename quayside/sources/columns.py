"""Column subsets by name, index or spreadsheet letters."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _letters_to_index(letters: str) -> int:
    index = 0
    for letter in letters.upper():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def wanted_columns(spec: str | None, names: Sequence[str]) -> list[str]:
    """``COD,NOME`` are names, ``0,1,3`` indices, ``A:D`` a spreadsheet range; blank means all."""
    if spec is None or not spec.strip():
        return list(names)
    span = re.fullmatch(r"\s*([A-Za-z]{1,3})\s*:\s*([A-Za-z]{1,3})\s*", spec)
    if span and spec.strip() not in names:
        low, high = (_letters_to_index(part) for part in span.groups())
        return list(names[low : high + 1])
    wanted = []
    for item in (part.strip() for part in spec.split(",")):
        if item in names:
            wanted.append(item)
        elif item.isdigit() and int(item) < len(names):
            wanted.append(names[int(item)])
        else:
            raise ValueError(f"no column {item!r}")
    # the source keeps its own column order, whatever the order of the list
    return [n for n in names if n in wanted]


def use_columns(df: DataFrame, spec: str | None) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in wanted_columns(spec, df.columns)])


def project_fields(df: DataFrame, fields: Sequence[str] | None, key: str = "_id") -> DataFrame:
    """The listed fields, and the key the source always returns; no list, all fields."""
    if not fields:
        return df
    names = [key] if key in df.columns and key not in fields else []
    return df.select(*names, *fields)
