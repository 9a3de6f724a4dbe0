"""One schema for batches that differ in columns and in types.

The types form a lattice: int < bigint < decimal < double < text, date < timestamp < text, everything else < text.
Structs meet field by field, arrays and maps by their elements. Folding the batches' schemas over it gives the least
type that holds every batch's values, and a list of what was widened; nothing is read for that but schemas.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import storage

#: Digits of the whole numbers as decimals: fixed values.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_MOST_DIGITS = 38


@dataclass(frozen=True)
class Widening:
    """A column (``a.b`` for a field, ``a[]`` for elements) of one batch that got a wider type."""

    column: str
    batch: int
    given: str
    became: str


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _common_number(a, b)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, common_type(a.valueType, b.valueType))
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times) and T.DateType in (type(a), type(b)):
        return b if isinstance(a, T.DateType) else a
    return T.StringType()


def _common_number(a: T.NumericType, b: T.NumericType) -> T.DataType:
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (a, b))
    digits = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _DIGITS[type(t)] for t in (a, b))
    # what no decimal holds is a double, as the next type up
    return T.DecimalType(digits + scale, scale) if digits + scale <= _MOST_DIGITS else T.DoubleType()


def common_struct(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both, in the order in which they were first seen; names differ in more than their case."""
    fields = {f.name.lower(): f for f in a}
    for f in b:
        known = fields.get(f.name.lower())
        kind = common_type(known.dataType, f.dataType) if known else f.dataType
        fields[f.name.lower()] = T.StructField(known.name if known else f.name, kind)
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


def common_schema(schemas: Sequence[T.StructType]) -> tuple[T.StructType, list[Widening]]:
    """The least schema that holds all of them, and where a batch's own types were narrower."""
    common = reduce(common_struct, schemas)
    widened = []
    for i, schema in enumerate(schemas):
        widened += [Widening(column, i, given, became) for column, given, became in _differences(schema, common, "")]
    return common, widened


def _differences(given: T.DataType, became: T.DataType, name: str) -> Iterable[tuple[str, str, str]]:
    if isinstance(given, T.StructType) and isinstance(became, T.StructType):
        kinds = {f.name.lower(): f for f in became}
        for f in given:
            wide = kinds[f.name.lower()]
            yield from _differences(f.dataType, wide.dataType, f"{name}.{wide.name}" if name else wide.name)
    elif isinstance(given, T.ArrayType) and isinstance(became, T.ArrayType):
        yield from _differences(given.elementType, became.elementType, f"{name}[]")
    elif isinstance(given, T.MapType) and isinstance(became, T.MapType):
        yield from _differences(given.valueType, became.valueType, f"{name}[]")
    elif given.simpleString() != became.simpleString() and not isinstance(given, T.NullType):
        yield name, given.simpleString(), became.simpleString()


def widened_column(c: Column, given: T.DataType, wide: T.DataType) -> Column:
    """A value of one type as one of a wider type; nested values that become text are JSON, bytes base64."""
    if given.simpleString() == wide.simpleString():
        return c
    if isinstance(given, T.StructType) and isinstance(wide, T.StructType):
        kinds = {f.name.lower(): f for f in given}
        values = []
        for f in wide:
            own = kinds.get(f.name.lower())
            value = widened_column(c.getField(own.name), own.dataType, f.dataType) if own else F.lit(None).cast(f.dataType)
            values.append(value.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*values))
    if isinstance(given, T.ArrayType) and isinstance(wide, T.ArrayType):
        return F.transform(c, lambda e: widened_column(e, given.elementType, wide.elementType))
    if isinstance(given, T.MapType) and isinstance(wide, T.MapType):
        return F.transform_values(c, lambda _, v: widened_column(v, given.valueType, wide.valueType))
    if isinstance(wide, T.StringType):
        if isinstance(given, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(c)
        if isinstance(given, T.BinaryType):
            return F.base64(c)
    return c.cast(wide)


def widened(df: DataFrame, wide: T.StructType) -> DataFrame:
    """A batch in the common schema; columns it lacks are null."""
    kinds = {f.name.lower(): f for f in df.schema}
    columns = []
    for f in wide:
        own = kinds.get(f.name.lower())
        value = widened_column(F.col(f"`{own.name}`"), own.dataType, f.dataType) if own else F.lit(None).cast(f.dataType)
        columns.append(value.alias(f.name))
    return df.select(columns)


def union_widening(batches: Sequence[DataFrame]) -> tuple[DataFrame, list[Widening]]:
    """Batches side by side in their common schema, with what was widened for it."""
    common, changes = common_schema([b.schema for b in batches])
    return reduce(DataFrame.unionAll, [widened(b, common) for b in batches]), changes


def scan_drifting(
    spark: SparkSession, path: str, depth: int = 1, file_format: str = "parquet", each_file: bool = False
) -> tuple[DataFrame, list[Widening]]:
    """A folder whose batches, the partition folders ``depth`` levels below it, were each written in a schema of their own.

    One footer of each batch is looked at, or of each file with ``each_file``. Batches of one schema are one scan, so the
    plan grows with the number of schemas and filters and fields reach every scan. The widenings count schemas in the
    order of the folders that brought them.
    """
    base = path.rstrip("/")
    batches = [f"{base}/{f}" for f in storage.nested_folders(spark, base, depth)]
    if each_file:
        batches = [f"{b}/{n}" for b in batches for n in storage.child_files(spark, b)]
    batches = [b for b in batches if each_file or storage.child_files(spark, b)]
    if not batches:
        raise FileNotFoundError(f"no batches below {path}")
    footers = storage.in_threads(lambda b: spark.read.format(file_format).load(b).schema, batches)
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for batch, schema in zip(batches, footers):
        groups.setdefault(schema.json(), (schema, []))[1].append(batch)
    reader = lambda schema: spark.read.format(file_format).option("basePath", base).schema(schema)
    return union_widening([reader(schema).load(own) for schema, own in groups.values()])
