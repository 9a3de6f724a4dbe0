"""Aggregation pipelines kept in a configuration, as JSON, compiled to DataFrame steps.

A pipeline is a list of stages, ``{"$match": …}``, ``{"$group": …}`` and so on. Each stage becomes one DataFrame
operation and each expression one Column, so Catalyst sees the whole: a leading ``$match`` on plain fields reaches the
scan, and fields that no later stage names are not read. Nothing runs until the caller asks for rows.

Fields are written as in the documents: ``a.b`` is field ``b`` of struct ``a``, and of each element where ``a`` is an
array of structs. What a document store decides by value is decided here by type: a field that the schema lacks is
missing in every row, so it is null, equals null and does not exist. Values of unlike types do not compare: that is an
error when the pipeline is compiled, as are unknown stages, operators and options.

A missing value and null are one here. ``{"f": null}`` finds both, as it does in the store; ``$exists`` means not null;
``$push`` and ``$addToSet`` leave null out. In expressions null is the least value, in ``$match`` it compares with nothing
but itself, as in the store. Rows have an order only after ``$sort``; ``$first``, ``$last`` and ``$push`` follow it, without
one they follow the order of reading.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class PipelineError(ValueError):
    """A pipeline that cannot be compiled, with the place in it."""


def _single(document: Any, place: str) -> tuple[str, Any]:
    if not isinstance(document, Mapping) or len(document) != 1:
        raise PipelineError(f"{place}: one name with its argument is wanted, not {json.dumps(document, default=str)}")
    return next(iter(document.items()))


def _name(text: Any, place: str) -> str:
    if not isinstance(text, str) or not text or text.startswith("$") or "" in text.split("."):
        raise PipelineError(f"{place}: not a field: {text!r}")
    return text


# values

#: Extended forms of values that JSON has no notation for.
_TYPED = ("$date", "$oid", "$numberLong", "$numberInt", "$numberDouble", "$numberDecimal")


def _moment(text: Any, place: str) -> datetime:
    if isinstance(text, Mapping) and set(text) == {"$numberLong"}:
        text = int(text["$numberLong"])
    if isinstance(text, int) and not isinstance(text, bool):
        return datetime.fromtimestamp(text / 1000, timezone.utc).replace(tzinfo=None)
    try:
        moment = datetime.fromisoformat(str(text).replace("Z", "+00:00"))
    except ValueError:
        raise PipelineError(f"{place}: not a date: {text!r}") from None
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def _is_value(x: Any) -> bool:
    """Whether x is a plain value, or the extended form of one."""
    return not isinstance(x, (Mapping, list)) or (isinstance(x, Mapping) and len(x) == 1 and next(iter(x)) in _TYPED)


def _value(x: Any, place: str) -> Any:
    """The Python value of a JSON value or of an extended form; ids are text."""
    if not isinstance(x, Mapping):
        return x
    kind, inner = _single(x, place)
    if kind == "$date":
        return _moment(inner, place)
    if kind in ("$numberLong", "$numberInt"):
        return int(inner)
    if kind == "$numberDouble":
        return float(inner)
    if kind == "$numberDecimal":
        from decimal import Decimal

        return Decimal(inner)
    return str(inner)


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    return kind.typeName()


def _value_family(x: Any) -> str:
    if isinstance(x, bool):
        return "boolean"
    if isinstance(x, datetime):
        return "time"
    return "text" if isinstance(x, str) else "number"


def _literal(x: Any, kind: T.DataType | None, place: str) -> Column:
    """A value as a literal of the type it is compared with, so that the comparison stays on the stored column."""
    if x is None or kind is None or isinstance(kind, T.NullType):
        return _plain_literal(x)
    if _family(kind) != _value_family(x):
        raise PipelineError(f"{place}: {x!r} does not compare with {kind.simpleString()}")
    if isinstance(kind, T.TimestampType):
        return F.lit(f"{x.isoformat(' ')}+00:00").cast("timestamp")
    if isinstance(kind, T.DateType) and x.time() == datetime.min.time():
        return F.lit(x.date().isoformat()).cast("date")  # the start of a day is that day
    return _plain_literal(x)


def _plain_literal(x: Any) -> Column:
    return F.lit(x.isoformat(" ")).cast("timestamp_ntz") if isinstance(x, datetime) else F.lit(x)


# fields


class Scope:
    """Fields of one table as columns with their types, and the variables that ``$map``, ``$filter`` and ``$let`` bind."""

    def __init__(self, fields: Mapping[str, tuple[Column, T.DataType]], df: DataFrame, variables: Mapping[str, tuple] | None = None):
        self.fields, self.df, self.variables = fields, df, dict(variables or {})

    @classmethod
    def of(cls, df: DataFrame) -> Scope:
        return cls({f.name: (F.col(f"`{f.name}`"), f.dataType) for f in df.schema}, df)

    def element(self, c: Column, kind: T.StructType) -> Scope:
        """The fields of one struct, for conditions on an array's elements."""
        return Scope({f.name: (c.getField(f.name), f.dataType) for f in kind}, self.df, self.variables)

    def binding(self, **more: tuple) -> Scope:
        return Scope(self.fields, self.df, {**self.variables, **more})

    def field(self, path: str) -> tuple[Column, T.DataType | None]:
        """Column and type of a field; a missing one is null."""
        names = path.split(".")
        # a stored name may itself hold dots: the longest one that is there
        for n in range(len(names), 0, -1):
            if ".".join(names[:n]) in self.fields:
                return _inside(*self.fields[".".join(names[:n])], names[n:])
        return F.lit(None), T.NullType()

    def variable(self, path: str, place: str) -> tuple[Column, T.DataType | None]:
        first, *rest = path.split(".")
        if first in ("ROOT", "CURRENT"):
            return self.field(".".join(rest)) if rest else (F.struct(*[c.alias(n) for n, (c, _) in self.fields.items()]), None)
        if first not in self.variables:
            raise PipelineError(f"{place}: unknown variable $${first}")
        return _inside(*self.variables[first], rest)

    def kind(self, c: Column, known: T.DataType | None) -> T.DataType | None:
        """The type of an expression, from the analyser where it is not known; None inside a lambda."""
        if known is not None:
            return known
        try:
            return self.df.select(c.alias("c")).schema["c"].dataType
        except AnalysisException:
            return None


def _inside(c: Column, kind: T.DataType | None, path: Sequence[str]) -> tuple[Column, T.DataType | None]:
    """A field within a struct, or within each struct of an array."""
    for i, name in enumerate(path):
        if kind is None:
            c = c.getField(name)
        elif isinstance(kind, T.StructType) and name in kind.names:
            c, kind = c.getField(name), kind[name].dataType
        elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            c, kind = c.getItem(name), kind.valueType
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)):
            rest, of = path[i:], kind.elementType
            inner = _inside(F.lit(None), of, rest)[1]
            if isinstance(inner, T.NullType):
                break
            return F.transform(c, lambda e: _inside(e, of, rest)[0]), T.ArrayType(inner)  # noqa: B023
        else:
            break
    else:
        return c, kind
    return F.lit(None), T.NullType()


# expressions

Typed = tuple[Column, "T.DataType | None"]
_BOOLEAN, _LONG, _DOUBLE, _TEXT = T.BooleanType(), T.LongType(), T.DoubleType(), T.StringType()


def expression(x: Any, scope: Scope, place: str = "$expr") -> Column:
    """One expression of a pipeline as a Column."""
    return _typed(x, scope, place)[0]


def _typed(x: Any, scope: Scope, place: str) -> Typed:
    if isinstance(x, str) and x.startswith("$$"):
        return scope.variable(x[2:], place)
    if isinstance(x, str) and x.startswith("$"):
        return scope.field(_name(x[1:], place))
    if _is_value(x):
        value = _value(x, place)
        return _plain_literal(value), None if value is not None else T.NullType()
    if isinstance(x, list):
        return F.array(*[expression(e, scope, place) for e in x]), None
    names = [n for n in x if n.startswith("$")]
    if not names:
        return F.struct(*[expression(e, scope, f"{place}.{n}").alias(n) for n, e in x.items()]), None
    name, argument = _single(x, place)
    place = f"{place}.{name}"
    if name == "$literal":
        return (_plain_literal(_value(argument, place)) if _is_value(argument) else F.lit(argument)), None
    if name not in _OPERATORS:
        raise PipelineError(f"{place}: unknown operator")
    return _OPERATORS[name](argument, scope, place)


def _arguments(x: Any, place: str, least: int, most: int | None = None) -> list:
    """The arguments of an operator, of which one may stand without its list."""
    given = x if isinstance(x, list) else [x]
    if not least <= len(given) <= (least if most is None else most):
        raise PipelineError(f"{place}: {len(given)} arguments")
    return given


def _named(x: Any, place: str, wanted: str, optional: str = "") -> list:
    """The named arguments of an operator in the order of ``wanted`` and ``optional``, the latter None where missing."""
    names, more = wanted.split(), optional.split()
    if not isinstance(x, Mapping) or not set(names) <= set(x) <= set(names + more):
        raise PipelineError(f"{place}: takes {wanted}{' and ' + optional if optional else ''}")
    return [x.get(n) for n in names + more]


def _truth(x: Any, scope: Scope, place: str) -> Column:
    """Whether a value counts as true: neither null nor false nor zero."""
    c, kind = _typed(x, scope, place)
    kind = scope.kind(c, kind)
    if isinstance(kind, T.NumericType):
        return F.coalesce(c != 0, F.lit(False))
    return F.coalesce(c, F.lit(False)) if kind is None or isinstance(kind, T.BooleanType) else c.isNotNull()


def _pair(x: Any, scope: Scope, place: str) -> tuple[Column, Column]:
    """Two operands; a plain value takes the type of the other one."""
    given = _arguments(x, place, 2)
    (a, ka), (b, kb) = (_typed(e, scope, place) for e in given)
    plain = [_is_value(e) and not (isinstance(e, str) and e.startswith("$")) for e in given]
    if plain[1] and not plain[0]:
        b = _literal(_value(given[1], place), scope.kind(a, ka), place)
    elif plain[0] and not plain[1]:
        a = _literal(_value(given[0], place), scope.kind(b, kb), place)
    return a, b


def _less(a: Column, b: Column) -> Column:
    return F.coalesce(a < b, a.isNull() & b.isNotNull())


#: Comparisons of expressions: null is the least of all values, and equal to itself.
_COMPARED: dict[str, Callable[[Column, Column], Column]] = {
    "$eq": lambda a, b: a.eqNullSafe(b),
    "$ne": lambda a, b: ~a.eqNullSafe(b),
    "$lt": _less,
    "$gt": lambda a, b: _less(b, a),
    "$lte": lambda a, b: ~_less(b, a),
    "$gte": lambda a, b: ~_less(a, b),
    "$cmp": lambda a, b: F.when(_less(a, b), -1).when(_less(b, a), 1).otherwise(0),
}

#: Functions of one value.
_UNARY: dict[str, tuple[Callable[[Column], Column], T.DataType | None]] = {
    "$abs": (F.abs, None),
    "$ceil": (F.ceil, _LONG),
    "$floor": (F.floor, _LONG),
    "$sqrt": (F.sqrt, _DOUBLE),
    "$toLower": (lambda c: F.lower(F.coalesce(c, F.lit(""))), _TEXT),
    "$toUpper": (lambda c: F.upper(F.coalesce(c, F.lit(""))), _TEXT),
    "$strLenCP": (F.char_length, T.IntegerType()),
    "$size": (lambda c: F.when(c.isNotNull(), F.size(c)), T.IntegerType()),
    "$reverseArray": (F.reverse, None),
    "$year": (F.year, T.IntegerType()),
    "$month": (F.month, T.IntegerType()),
    "$dayOfMonth": (F.dayofmonth, T.IntegerType()),
    "$dayOfWeek": (F.dayofweek, T.IntegerType()),
    "$dayOfYear": (F.dayofyear, T.IntegerType()),
    "$hour": (F.hour, T.IntegerType()),
    "$minute": (F.minute, T.IntegerType()),
    "$second": (F.second, T.IntegerType()),
    "$toString": (lambda c: c.cast("string"), _TEXT),
    "$toInt": (lambda c: c.cast("int"), T.IntegerType()),
    "$toLong": (lambda c: c.cast("bigint"), _LONG),
    "$toDouble": (lambda c: c.cast("double"), _DOUBLE),
    "$toDecimal": (lambda c: c.cast("decimal(38,9)"), T.DecimalType(38, 9)),
    "$toBool": (lambda c: c.cast("boolean"), _BOOLEAN),
    "$toDate": (lambda c: c.cast("timestamp_ntz"), T.TimestampNTZType()),
}

#: Parts of a date's text and the letters Spark has for them: fixed values.
_DATE_PARTS = {"Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "L": "SSS", "j": "DDD", "%": "'%'"}


def _date_text(x: Any, scope: Scope, place: str) -> Typed:
    date, form, zone, on_null = _named(x, place, "date", "format timezone onNull")
    if zone not in (None, "UTC", "GMT", "+00:00"):
        raise PipelineError(f"{place}: times are UTC, not {zone}")
    form = form or "%Y-%m-%dT%H:%M:%S.%LZ"
    pattern = ""
    for literal, part in re.findall(r"([^%]+)|%(.?)", form):
        if not literal and part not in _DATE_PARTS or "'" in literal:
            raise PipelineError(f"{place}: unknown part of {form!r}")
        pattern += _DATE_PARTS[part] if not literal else f"'{literal}'"
    # two quotes in a row would be a quote
    told = F.date_format(expression(date, scope, place), pattern.replace("''", ""))
    return (told if on_null is None else F.coalesce(told, expression(on_null, scope, place))), _TEXT


def _date_trunc(x: Any, scope: Scope, place: str) -> Typed:
    date, unit = _named(x, place, "date unit")
    if unit not in ("year", "quarter", "month", "day", "hour", "minute", "second"):
        raise PipelineError(f"{place}: unknown unit {unit}")
    return F.date_trunc(unit, expression(date, scope, place)).cast("timestamp_ntz"), T.TimestampNTZType()


def _summed(operate: Callable[[Column, Column], Column]) -> Callable[..., Typed]:
    def build(x: Any, scope: Scope, place: str) -> Typed:
        first, *rest = [expression(e, scope, place) for e in _arguments(x, place, 1, 999)]
        for e in rest:
            first = operate(first, e)
        return first, None

    return build


def _subtracted(x: Any, scope: Scope, place: str) -> Typed:
    (a, ka), (b, kb) = (_typed(e, scope, place) for e in _arguments(x, place, 2))
    if all(k is not None and _family(k) == "time" for k in (scope.kind(a, ka), scope.kind(b, kb))):
        return F.timestamp_diff("MILLISECOND", b.cast("timestamp_ntz"), a.cast("timestamp_ntz")), _LONG
    return a - b, None


def _rounded(x: Any, scope: Scope, place: str) -> Typed:
    value, *digits = _arguments(x, place, 1, 2)
    # halves go to the even neighbour
    return F.bround(expression(value, scope, place), digits[0] if digits else 0), None


def _conditional(x: Any, scope: Scope, place: str) -> Typed:
    test, yes, no = _named(x, place, "if then else") if isinstance(x, Mapping) else _arguments(x, place, 3)
    return F.when(_truth(test, scope, place), expression(yes, scope, place)).otherwise(expression(no, scope, place)), None


def _switched(x: Any, scope: Scope, place: str) -> Typed:
    branches, default = _named(x, place, "branches", "default")
    out = F.raise_error(F.lit(f"{place}: no branch fits")) if "default" not in x else expression(default, scope, place)
    for branch in reversed(branches):
        case, then = _named(branch, place, "case then")
        out = F.when(_truth(case, scope, place), expression(then, scope, place)).otherwise(out)
    return out, None


def _of_array(x: Any, scope: Scope, place: str) -> tuple[Column, T.DataType | None]:
    """An array and the type of its elements."""
    c, kind = _typed(x, scope, place)
    kind = scope.kind(c, kind)
    if kind is not None and not isinstance(kind, (T.ArrayType, T.NullType)):
        raise PipelineError(f"{place}: not an array: {kind.simpleString()}")
    return c, kind.elementType if isinstance(kind, T.ArrayType) else None


def _element_at(x: Any, scope: Scope, place: str) -> Typed:
    array, index = _arguments(x, place, 2)
    c, of = _of_array(array, scope, place)
    i = expression(index, scope, place).cast("int")
    return F.get(c, F.when(i < 0, F.size(c) + i).otherwise(i)), of


def _sliced(x: Any, scope: Scope, place: str) -> Typed:
    array, *numbers = _arguments(x, place, 2, 3)
    if not all(isinstance(n, int) for n in numbers) or (len(numbers) == 2 and numbers[1] < 0):
        raise PipelineError(f"{place}: whole numbers are wanted")
    c, of = _of_array(array, scope, place)
    size, kind = F.size(c), None if of is None else T.ArrayType(of)
    start, count = numbers if len(numbers) == 2 else (min(numbers[0], 0), abs(numbers[0]))
    # a start before the array is its first element
    first = F.lit(start + 1) if start >= 0 else F.greatest(size + start, F.lit(0)) + 1
    return F.slice(c, first, F.lit(count)), kind


def _filtered(x: Any, scope: Scope, place: str) -> Typed:
    array, cond, name = _named(x, place, "input cond", "as")
    c, of = _of_array(array, scope, place)
    return F.filter(c, lambda e: _truth(cond, scope.binding(**{name or "this": (e, of)}), place)), None if of is None else T.ArrayType(of)


def _mapped(x: Any, scope: Scope, place: str) -> Typed:
    array, each, name = _named(x, place, "input in", "as")
    c, of = _of_array(array, scope, place)
    return F.transform(c, lambda e: expression(each, scope.binding(**{name or "this": (e, of)}), place)), None


def _bound(x: Any, scope: Scope, place: str) -> Typed:
    variables, body = _named(x, place, "vars in")
    return _typed(body, scope.binding(**{n: _typed(e, scope, place) for n, e in variables.items()}), place)


def _total(x: Any, scope: Scope, place: str) -> Typed:
    """The sum of several values, or of an array's; null counts as nothing."""
    if isinstance(x, list) and len(x) != 1:
        return _summed(lambda a, b: a + b)([{"$ifNull": [e, 0]} for e in x], scope, place)
    c, of = _of_array(_arguments(x, place, 1)[0], scope, place)
    whole = isinstance(of, T.IntegralType)
    kind = _LONG if whole else _DOUBLE
    return F.coalesce(F.aggregate(c, F.lit(0).cast(kind), lambda t, e: t + F.coalesce(e.cast(kind), F.lit(0).cast(kind))), F.lit(0).cast(kind)), kind


def _mean(x: Any, scope: Scope, place: str) -> Typed:
    c, _ = _of_array(_arguments(x, place, 1)[0], scope, place)
    held = F.filter(c, lambda e: e.isNotNull())
    return F.when(F.size(held) > 0, F.aggregate(held, F.lit(0.0), lambda t, e: t + e.cast("double")) / F.size(held)), _DOUBLE


def _extreme(of_array: Callable[[Column], Column], of_values: Callable[..., Column]) -> Callable[..., Typed]:
    def build(x: Any, scope: Scope, place: str) -> Typed:
        if isinstance(x, list) and len(x) != 1:
            return of_values(*[expression(e, scope, place) for e in x]), None
        c, of = _of_array(_arguments(x, place, 1)[0], scope, place)
        return of_array(c), of

    return build


def _member(x: Any, scope: Scope, place: str) -> Typed:
    value, array = _arguments(x, place, 2)
    c = expression(value, scope, place)
    if isinstance(array, list):
        kind = scope.kind(c, _typed(value, scope, place)[1])
        return F.coalesce(c.isin(*[_literal(_value(v, place), kind, place) if _is_value(v) else expression(v, scope, place) for v in array]), F.lit(False)), _BOOLEAN
    return F.coalesce(F.exists(_of_array(array, scope, place)[0], lambda e: e.eqNullSafe(c)), F.lit(False)), _BOOLEAN


def _pattern(regex: Any, options: Any, place: str) -> str:
    """A pattern with its options in front."""
    if isinstance(regex, Mapping):
        inner = regex.get("$regularExpression", regex)
        regex, options = inner.get("pattern"), inner.get("options") or options
    if not isinstance(regex, str) or set(options or "") - set("imsx"):
        raise PipelineError(f"{place}: not a pattern: {regex!r} with {options!r}")
    return f"(?{options}){regex}" if options else regex


def _regex_match(x: Any, scope: Scope, place: str) -> Typed:
    text, regex, options = _named(x, place, "input regex", "options")
    return F.coalesce(expression(text, scope, place).rlike(_pattern(regex, options, place)), F.lit(False)), _BOOLEAN


def _part_of_text(x: Any, scope: Scope, place: str) -> Typed:
    text, start, count = _arguments(x, place, 3)
    c = F.coalesce(expression(text, scope, place).cast("string"), F.lit(""))
    n = expression(count, scope, place)
    return F.substring(c, expression(start, scope, place) + 1, F.when(n < 0, F.char_length(c)).otherwise(n)), _TEXT


def _trimmed(both: Callable, place_of: str) -> Callable[..., Typed]:
    def build(x: Any, scope: Scope, place: str) -> Typed:
        text, chars = _named(x, place, "input", "chars")
        c = expression(text, scope, place)
        if chars is not None:
            return both(c, F.lit(chars)), _TEXT
        ends = {"$trim": r"^[\s\x00]+|[\s\x00]+$", "$ltrim": r"^[\s\x00]+", "$rtrim": r"[\s\x00]+$"}
        return F.regexp_replace(c, ends[place_of], ""), _TEXT

    return build


def _merged_objects(x: Any, scope: Scope, place: str) -> Typed:
    """Fields of several structs in one; of a name the last one counts that is in a struct which is there."""
    fields: dict[str, Column] = {}
    for e in _arguments(x, place, 1, 999):
        c, kind = _typed(e, scope, place)
        kind = scope.kind(c, kind)
        if not isinstance(kind, T.StructType):
            raise PipelineError(f"{place}: not a document: {e!r}")
        for f in kind.names:
            fields[f] = F.when(c.isNotNull(), c.getField(f)).otherwise(fields[f]) if f in fields else c.getField(f)
    return F.struct(*[c.alias(n) for n, c in fields.items()]), None


def _plain(build: Callable[..., Column], least: int, most: int, kind: T.DataType | None) -> Callable[..., Typed]:
    return lambda x, scope, place: (build(*[expression(e, scope, place) for e in _arguments(x, place, least, most)]), kind)


def _compared(build: Callable) -> Callable[..., Typed]:
    return lambda x, scope, place: (build(*_pair(x, scope, place)), _BOOLEAN)


def _logical(join: Callable[[Column, Column], Column], start: bool) -> Callable[..., Typed]:
    def build(x: Any, scope: Scope, place: str) -> Typed:
        out = F.lit(start)
        for i, e in enumerate(_arguments(x, place, 0, 999)):
            out = join(out, _truth(e, scope, place)) if i else _truth(e, scope, place)
        return out, _BOOLEAN

    return build


_OPERATORS: dict[str, Callable[[Any, Scope, str], Typed]] = {
    **{name: _compared(build) for name, build in _COMPARED.items()},
    **{name: _plain(build, 1, 1, kind) for name, (build, kind) in _UNARY.items()},
    "$and": _logical(lambda a, b: a & b, True),
    "$or": _logical(lambda a, b: a | b, False),
    "$not": lambda x, scope, place: (~_truth(_arguments(x, place, 1)[0], scope, place), _BOOLEAN),
    "$add": _summed(lambda a, b: a + b),
    "$multiply": _summed(lambda a, b: a * b),
    "$subtract": _subtracted,
    "$divide": _plain(lambda a, b: a / b, 2, 2, None),
    "$mod": _plain(lambda a, b: a % b, 2, 2, None),
    "$pow": _plain(F.pow, 2, 2, _DOUBLE),
    "$round": _rounded,
    "$concat": _plain(F.concat, 1, 999, _TEXT),
    "$split": _plain(lambda text, mark: F.split(text, F.concat(F.lit("\\Q"), mark, F.lit("\\E"))), 2, 2, T.ArrayType(_TEXT)),
    "$substrCP": _part_of_text,
    "$substr": _part_of_text,
    "$trim": _trimmed(F.btrim, "$trim"),
    "$ltrim": _trimmed(F.ltrim, "$ltrim"),
    "$rtrim": _trimmed(F.rtrim, "$rtrim"),
    "$replaceAll": lambda x, scope, place: (F.replace(*[expression(e, scope, place) for e in _named(x, place, "input find replacement")]), _TEXT),
    "$regexMatch": _regex_match,
    "$cond": _conditional,
    "$ifNull": _plain(F.coalesce, 2, 999, None),
    "$switch": _switched,
    "$let": _bound,
    "$in": _member,
    "$isArray": lambda x, scope, place: (F.lit(isinstance(scope.kind(*_typed(_arguments(x, place, 1)[0], scope, place)), T.ArrayType)), _BOOLEAN),
    "$arrayElemAt": _element_at,
    "$first": lambda x, scope, place: _element_at([_arguments(x, place, 1)[0], 0], scope, place),
    "$last": lambda x, scope, place: _element_at([_arguments(x, place, 1)[0], -1], scope, place),
    "$slice": _sliced,
    "$filter": _filtered,
    "$map": _mapped,
    "$concatArrays": _plain(F.concat, 1, 999, None),
    "$setUnion": _plain(lambda a, b: F.array_union(a, b), 2, 2, None),
    "$setIntersection": _plain(lambda a, b: F.array_intersect(a, b), 2, 2, None),
    "$setDifference": _plain(lambda a, b: F.array_except(a, b), 2, 2, None),
    "$sum": _total,
    "$avg": _mean,
    "$min": _extreme(F.array_min, F.least),
    "$max": _extreme(F.array_max, F.greatest),
    "$mergeObjects": _merged_objects,
    "$dateToString": _date_text,
    "$dateTrunc": _date_trunc,
}


# conditions of $match


def condition(x: Any, scope: Scope, place: str = "$match") -> Column:
    """A query document as a condition; plain comparisons stay on the stored columns, so that they reach the scan."""
    if not isinstance(x, Mapping):
        raise PipelineError(f"{place}: a document is wanted")
    out = None
    for name, wanted in x.items():
        at = f"{place}.{name}"
        if name in ("$and", "$or", "$nor"):
            if not isinstance(wanted, list) or not wanted:
                raise PipelineError(f"{at}: a list is wanted")
            parts = [condition(e, scope, at) for e in wanted]
            test = parts[0]
            for part in parts[1:]:
                test = test & part if name == "$and" else test | part
            test = _never_null(~_never_null(test)) if name == "$nor" else test
        elif name == "$expr":
            test = _truth(wanted, scope, at)
        elif name == "$comment":
            continue
        elif name.startswith("$"):
            raise PipelineError(f"{at}: unknown operator")
        else:
            test = _field_test(*scope.field(name), wanted, scope, at)
        out = test if out is None else out & test
    return F.lit(True) if out is None else out


def _never_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _field_test(c: Column, kind: T.DataType | None, wanted: Any, scope: Scope, place: str) -> Column:
    """What one field must be: a value, or all of several tests."""
    if not isinstance(wanted, Mapping) or _is_value(wanted) or "$regularExpression" in wanted or not any(n.startswith("$") for n in wanted):
        return _equal(c, kind, wanted, place)
    out = None
    for name, argument in wanted.items():
        at = f"{place}.{name}"
        if name == "$options":
            continue
        if name == "$elemMatch":
            test = _element_match(c, kind, argument, scope, at)
        elif name == "$not":
            test = ~_never_null(_field_test(c, kind, argument if isinstance(argument, Mapping) else {"$eq": argument}, scope, at))
        elif name in ("$ne", "$nin"):
            test = ~_never_null(_field_test(c, kind, {"$eq" if name == "$ne" else "$in": argument}, scope, at))
        elif name == "$eq":
            test = _equal(c, kind, argument, at)
        elif name == "$exists":
            test = c.isNotNull() if argument else c.isNull()
        elif name == "$size":
            test = F.size(c) == int(argument)
        elif name == "$all":
            tests = [_equal(c, kind, e, at) for e in argument]
            test = tests[0] if tests else F.lit(False)
            for more in tests[1:]:
                test = test & more
        elif name == "$in":
            test = _one_of(c, kind, argument, at)
        elif name in ("$lt", "$lte", "$gt", "$gte"):
            compare = {"$lt": "__lt__", "$lte": "__le__", "$gt": "__gt__", "$gte": "__ge__"}[name]
            test = _any_element(c, kind, lambda e, k: getattr(e, compare)(_literal(_value(argument, at), k, at)))  # noqa: B023
        elif name == "$regex":
            pattern = _pattern(argument, wanted.get("$options"), at)
            test = _any_element(c, kind, lambda e, k: e.rlike(pattern))  # noqa: B023
        elif name == "$mod":
            divisor, rest = _arguments(argument, at, 2)
            test = _any_element(c, kind, lambda e, k: e % divisor == rest)  # noqa: B023
        else:
            raise PipelineError(f"{at}: unknown operator")
        out = test if out is None else out & test
    return F.lit(True) if out is None else out


def _any_element(c: Column, kind: T.DataType | None, test: Callable[[Column, T.DataType | None], Column]) -> Column:
    """A test of a value, or of any element where the field is an array."""
    if isinstance(kind, T.NullType):
        return F.lit(False)  # no row has the field
    if isinstance(kind, T.ArrayType):
        return F.exists(c, lambda e: test(e, kind.elementType))
    return test(c, kind)


def _equal(c: Column, kind: T.DataType | None, wanted: Any, place: str) -> Column:
    if wanted is None:
        return c.isNull()
    if isinstance(wanted, Mapping) and "$regularExpression" in wanted:
        return _any_element(c, kind, lambda e, k: e.rlike(_pattern(wanted, None, place)))
    if isinstance(wanted, list):
        if not isinstance(kind, T.ArrayType):
            return F.lit(False)
        return c == F.array(*[_literal(_value(e, place), kind.elementType, place) for e in wanted]).cast(kind)
    if not _is_value(wanted):
        if not isinstance(kind, T.StructType) or list(wanted) != kind.names:
            return F.lit(False)
        tests = [_equal(c.getField(n), kind[n].dataType, e, place) for n, e in wanted.items()]
        return F.forall(F.array(*tests), lambda e: e)
    return _any_element(c, kind, lambda e, k: e == _literal(_value(wanted, place), k, place))


def _one_of(c: Column, kind: T.DataType | None, wanted: Any, place: str) -> Column:
    if not isinstance(wanted, list):
        raise PipelineError(f"{place}: a list is wanted")
    plain = [e for e in wanted if e is not None and _is_value(e) and not (isinstance(e, Mapping) and "$regularExpression" in e)]
    test = _any_element(c, kind, lambda e, k: e.isin(*[_literal(_value(v, place), k, place) for v in plain])) if plain else F.lit(False)
    for e in wanted:
        if e is None or not any(e is p for p in plain):
            test = test | _equal(c, kind, e, place)
    return test


def _element_match(c: Column, kind: T.DataType | None, wanted: Any, scope: Scope, place: str) -> Column:
    if not isinstance(kind, T.ArrayType):
        return F.lit(False)
    of = kind.elementType
    if any(n.startswith("$") and n not in ("$and", "$or", "$nor", "$expr") for n in wanted):
        return F.exists(c, lambda e: _field_test(e, of, wanted, scope, place))
    if not isinstance(of, T.StructType):
        return F.lit(False)
    return F.exists(c, lambda e: condition(wanted, scope.element(e, of), place))


# shapes of $project, $addFields and $unset


class _Nested(dict):
    """Fields within a field, as told from the argument of an operator."""


def _tree(document: Mapping, place: str) -> _Nested:
    """Dotted names as nested documents."""
    out = _Nested()
    for name, x in document.items():
        if name.startswith("$"):
            raise PipelineError(f"{place}: not a field: {name}")
        *above, last = name.split(".")
        node = out
        for part in above:
            node = node.setdefault(part, _Nested())
            if not isinstance(node, _Nested):
                raise PipelineError(f"{place}: {name} is given twice")
        if isinstance(x, Mapping) and not _is_value(x) and x and not any(n.startswith("$") for n in x):
            x = _tree(x, f"{place}.{name}")
        if last in node:
            raise PipelineError(f"{place}: {name} is given twice")
        node[last] = x
    return out


def _is_flag(x: Any) -> bool:
    return isinstance(x, (bool, int, float))


def _leaves(tree: Mapping) -> list:
    return [leaf for x in tree.values() for leaf in (_leaves(x) if isinstance(x, _Nested) else [x])]


def _chosen(tree: Mapping, fields: Mapping[str, Typed], scope: Scope, place: str) -> dict[str, Column]:
    """The fields of an inclusion, and the computed ones."""
    out: dict[str, Column] = {}
    for name, x in tree.items():
        at = f"{place}.{name}"
        c, kind = fields.get(name, (None, None))
        if _is_flag(x):
            if c is not None:
                out[name] = c
        elif not isinstance(x, _Nested):
            out[name] = expression(x, scope, at)
        elif isinstance(kind, T.StructType):
            out[name] = F.when(c.isNotNull(), _chosen_struct(x, c, kind, scope, at))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            out[name] = F.transform(c, lambda e: _chosen_struct(x, e, kind.elementType, scope, at))  # noqa: B023
        elif not all(_is_flag(leaf) for leaf in _leaves(x)):
            out[name] = _chosen_struct(x, None, T.StructType(), scope, at)
    return out


def _chosen_struct(tree: Mapping, c: Column | None, kind: T.StructType, scope: Scope, place: str) -> Column:
    inner = _chosen(tree, {f.name: (c.getField(f.name), f.dataType) for f in kind}, scope, place)
    return F.struct(*[v.alias(n) for n, v in inner.items()])


def _without(tree: Mapping, c: Column, kind: T.DataType) -> Column:
    """A struct, or the structs of an array, without some of their fields."""
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda e: _without(tree, e, kind.elementType))
    if not isinstance(kind, T.StructType):
        return c
    for name, x in tree.items():
        if name not in kind.names:
            continue
        c = c.withField(name, _without(x, c.getField(name), kind[name].dataType)) if isinstance(x, _Nested) else c.dropFields(name)
    return c


def _set(tree: Mapping, c: Column | None, kind: T.DataType | None, scope: Scope, place: str) -> Column:
    """A struct with some fields added or replaced; what was no struct becomes one."""
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda e: _set(tree, e, kind.elementType, scope, place))
    values = {n: _set(x, *(_inside(c, kind, [n]) if c is not None else (None, None)), scope, f"{place}.{n}") if isinstance(x, _Nested) else expression(x, scope, f"{place}.{n}") for n, x in tree.items()}
    old = kind.names if isinstance(kind, T.StructType) else []
    return F.struct(*[values.get(n, c.getField(n) if n in old else None).alias(n) for n in [*old, *[n for n in values if n not in old]]])


# stages


#: The column that numbers rows where an accumulator asks for their order.
_ORDER = "__order"


def _ordered(df: DataFrame) -> DataFrame:
    """Rows with their place: ids rise with the partitions, which a sort puts in order."""
    return df.withColumn(_ORDER, F.monotonically_increasing_id())


def _match(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    return df.filter(condition(x, Scope.of(df), place))


def _project(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    if not isinstance(x, Mapping) or not x:
        raise PipelineError(f"{place}: a document is wanted")
    tree, scope = _tree(x, place), Scope.of(df)
    key = tree.get("_id")
    rest = {n: e for n, e in tree.items() if n != "_id"}
    flags = [bool(leaf) for leaf in _leaves(rest) if _is_flag(leaf)]
    if _is_flag(key) and not key and not rest or flags and not any(flags):
        if len(flags) < len(_leaves(rest)):
            raise PipelineError(f"{place}: leaves out some fields and computes others")
        return _unset_tree(df, tree if _is_flag(key) and not key else rest)
    if not all(flags):
        raise PipelineError(f"{place}: names fields to keep and fields to leave out")
    first = {} if _is_flag(key) and not key else {"_id": True if key is None else key}
    chosen = _chosen({**first, **rest}, scope.fields, scope, place)
    if not chosen:
        raise PipelineError(f"{place}: no field is left")
    return df.select(*[c.alias(n) for n, c in chosen.items()])


def _unset_tree(df: DataFrame, tree: Mapping) -> DataFrame:
    gone = [n for n, x in tree.items() if not isinstance(x, _Nested)]
    inner = {n: _without(x, F.col(f"`{n}`"), df.schema[n].dataType) for n, x in tree.items() if isinstance(x, _Nested) and n in df.columns}
    return df.withColumns(inner).select(*[F.col(f"`{c}`") for c in df.columns if c not in gone])


def _unset(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    return _unset_tree(df, _tree({_name(n, place): 0 for n in (x if isinstance(x, list) else [x])}, place))


def _add_fields(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    if not isinstance(x, Mapping):
        raise PipelineError(f"{place}: a document is wanted")
    scope = Scope.of(df)
    new = {}
    for name, e in _tree(x, place).items():
        c, kind = scope.fields.get(name, (None, None))
        new[name] = _set(e, c, kind, scope, f"{place}.{name}") if isinstance(e, _Nested) else expression(e, scope, f"{place}.{name}")
    return df.withColumns(new)


def _replaced(df: DataFrame, path: Sequence[str], value: Column) -> DataFrame:
    """A field, maybe within structs, with another value; the order of columns stays."""
    top = f"`{path[0]}`"
    if len(path) > 1:
        value = F.col(top).withField(".".join(f"`{p}`" for p in path[1:]), value)
    return df.withColumn(path[0], value)


def _unwind(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    path, index, keep = (x, None, False) if isinstance(x, str) else _named(x, place, "path", "includeArrayIndex preserveNullAndEmptyArrays")
    if not isinstance(path, str) or not path.startswith("$"):
        raise PipelineError(f"{place}: a path begins with $")
    c, kind = Scope.of(df).field(path[1:])
    if not isinstance(kind, T.ArrayType):  # a value that is no array is its own only element
        out = df if keep else df.filter(c.isNotNull())
        return out if index is None else out.withColumn(index, F.lit(None).cast("bigint"))
    if index is None:
        opened = df.withColumn("__element", F.explode_outer(c) if keep else F.explode(c))
    else:
        opened = df.select("*", (F.posexplode_outer(c) if keep else F.posexplode(c)).alias("__at", "__element"))
    out = _replaced(opened, path[1:].split("."), F.col("__element")).drop("__element")
    return out if index is None else out.withColumn(index, F.col("__at").cast("bigint")).drop("__at")


def _accumulated(name: str, x: Any, scope: Scope, place: str) -> Column:
    """An accumulator of ``$group`` as an aggregate."""
    if name == "$count":
        return F.count(F.lit(1))
    c, at = expression(x, scope, place), F.col(_ORDER)
    if name == "$sum":
        kind = scope.kind(*_typed(x, scope, place))
        return F.coalesce(F.sum(c), F.lit(0)) if isinstance(kind, T.NumericType) else F.lit(0).cast("bigint") + F.count(F.lit(None))
    if name in ("$first", "$last"):
        return (F.min_by if name == "$first" else F.max_by)(F.struct(c.alias("v")), at).getField("v")
    if name == "$push":
        held = F.collect_list(F.when(c.isNotNull(), F.struct(at.alias("at"), c.alias("v"))))
        return F.transform(F.array_sort(held, lambda a, b: F.when(a["at"] < b["at"], -1).otherwise(1)), lambda e: e["v"])
    plain = {"$avg": F.avg, "$min": F.min, "$max": F.max, "$addToSet": F.collect_set, "$stdDevPop": F.stddev_pop, "$stdDevSamp": F.stddev_samp}
    if name not in plain:
        raise PipelineError(f"{place}: unknown accumulator")
    return plain[name](c)


def _group(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    if not isinstance(x, Mapping) or "_id" not in x:
        raise PipelineError(f"{place}: _id is wanted")
    rows = {n: _single(e, f"{place}.{n}") for n, e in x.items() if n != "_id"}
    # only these ask for the order of rows, which costs them a number each
    if any(name in ("$first", "$last", "$push") for name, _ in rows.values()):
        df = _ordered(df)
    scope = Scope.of(df)
    key = expression(x["_id"], scope, f"{place}._id")
    key = key.cast("string") if x["_id"] is None else key
    values = [_accumulated(name, e, scope, f"{place}.{n}.{name}").alias(n) for n, (name, e) in rows.items()]
    grouped = df.groupBy(key.alias("_id"))
    return grouped.agg(*values) if values else grouped.agg(F.count(F.lit(1)).alias("__n")).drop("__n")


def _sort(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    if not isinstance(x, Mapping) or not x or any(d not in (1, -1) for d in x.values()):
        raise PipelineError(f"{place}: fields with 1 or -1 are wanted")
    scope = Scope.of(df)
    return df.orderBy(*[scope.field(_name(n, place))[0].asc_nulls_first() if d == 1 else scope.field(n)[0].desc_nulls_last() for n, d in x.items()])


def _whole_number(x: Any, place: str, least: int) -> int:
    x = _value(x, place)
    if isinstance(x, bool) or not isinstance(x, (int, float)) or x != int(x) or x < least:
        raise PipelineError(f"{place}: a whole number of {least} or more is wanted")
    return int(x)


def _count(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    return df.groupBy().agg(F.count(F.lit(1)).alias(_name(x, place))).filter(F.col(f"`{x}`") > 0)


def _sort_by_count(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    return df.groupBy(expression(x, Scope.of(df), place).alias("_id")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"))


def _replace_root(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    scope = Scope.of(df)
    root = x["newRoot"] if isinstance(x, Mapping) and set(x) == {"newRoot"} else x
    c, kind = _typed(root, scope, place)
    kind = scope.kind(c, kind)
    if not isinstance(kind, T.StructType):
        raise PipelineError(f"{place}: the new root is no document")
    return df.select(*[c.getField(n).alias(n) for n in kind.names])


def _union_with(df: DataFrame, x: Any, others: Mapping, place: str) -> DataFrame:
    name, stages = (x, []) if isinstance(x, str) else _named(x, place, "coll", "pipeline")
    return df.unionByName(_steps(_other(others, name, place), stages or [], others, place), allowMissingColumns=True)


def _other(others: Mapping[str, DataFrame], name: str, place: str) -> DataFrame:
    try:
        return others[name]
    except KeyError:
        raise PipelineError(f"{place}: no collection {name!r}") from None


#: Stages that treat each row alone: what they do to a foreign table they do to the rows that are found in it.
_BY_ROW = ("$match", "$project", "$addFields", "$set", "$unset", "$replaceRoot", "$replaceWith")


def _split_keys(stages: list, variables: Mapping[str, Any], place: str) -> tuple[list[tuple[str, Any]], list]:
    """Foreign fields that must equal variables, from the leading ``$match`` on ``$expr``; and the stages without those tests."""
    if not variables:
        return [], stages
    name, query = _single(stages[0], place) if stages else ("", {})
    tests = query.get("$expr") if name == "$match" else None
    tests = tests["$and"] if isinstance(tests, Mapping) and set(tests) == {"$and"} else [tests]
    keys, rest = [], []
    for test in tests:
        sides = test.get("$eq") if isinstance(test, Mapping) else None
        sides = sorted(sides, key=lambda s: str(s).startswith("$$")) if isinstance(sides, list) else None
        if sides and len(sides) == 2 and str(sides[0]).startswith("$") and str(sides[1])[:2] == "$$" and str(sides[1])[2:] in variables:
            keys.append((sides[0], variables[sides[1][2:]]))
        else:
            rest.append(test)
    if not keys:
        raise PipelineError(f"{place}: with let, the pipeline begins with a $match of $expr in which a field equals a variable")
    query = {n: e for n, e in query.items() if n != "$expr"} | ({"$expr": {"$and": rest}} if rest else {})
    return keys, [{"$match": query}, *stages[1:]]


def _lookup(df: DataFrame, x: Any, others: Mapping, place: str, unwound: bool | None = None) -> DataFrame:
    """Found rows as an array; ``unwound`` (whether rows without any stay) gives a row for each, without making the array."""
    source, name, local, foreign, let, stages = _named(x, place, "from as", "localField foreignField let pipeline")
    stages = list(stages or [])
    keys, stages = _split_keys(stages, let or {}, place)
    if (local is None) != (foreign is None) or local is None and not keys:
        raise PipelineError(f"{place}: localField and foreignField, or let and a pipeline are wanted")
    if local is not None:
        keys = [(f"${foreign}", f"${local}"), *keys]
    for stage in stages:
        if _single(stage, place)[0] not in _BY_ROW:
            raise PipelineError(f"{place}: {_single(stage, place)[0]} cannot stand in a lookup")
    scope, table = Scope.of(df), _other(others, source, place)
    far = Scope.of(table)
    own = {f"__own{i}": _typed(mine, scope, place) for i, (_, mine) in enumerate(keys)}
    if any(isinstance(scope.kind(*e), T.ArrayType) for e in own.values()):
        raise PipelineError(f"{place}: the local field is an array; unwind it first")
    theirs = table.withColumns({f"__key{i}": expression(field, far, place) for i, (field, _) in enumerate(keys)})
    names = [f"__key{i}" for i in range(len(keys))]
    # the stages see the foreign fields; the keys go along beside them
    theirs = _steps(theirs, [_keeping(s, names) for s in stages], others, place)
    found = theirs.select(*names, F.struct(*[F.col(f"`{c}`") for c in theirs.columns if c not in names]).alias("__found"))
    if unwound is None:
        found = found.groupBy(*names).agg(F.collect_list("__found").alias("__found"))
    left = df.withColumns({n: c for n, (c, _) in own.items()})
    # null finds null, as a missing field does
    on = [F.col(f"__own{i}").eqNullSafe(F.col(f"__key{i}")) for i in range(len(keys))]
    joined = left.join(found, on, "inner" if unwound is False else "left")
    value = F.col("__found") if unwound is not None else F.coalesce("__found", F.array().cast(found.schema["__found"].dataType))
    return joined.withColumn("__value", value).select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.col("__value").alias(name))


def _keeping(stage: Mapping, names: Sequence[str]) -> Mapping:
    """A stage that leaves the join's keys in place."""
    kind, x = _single(stage, "$lookup")
    if kind == "$project" and any(bool(leaf) or not _is_flag(leaf) for n, e in x.items() if n != "_id" for leaf in [e]):
        return {kind: {**x, **{n: 1 for n in names}}}
    if kind in ("$replaceRoot", "$replaceWith"):
        root = x["newRoot"] if kind == "$replaceRoot" else x
        return {"$replaceRoot": {"newRoot": {"$mergeObjects": [root, {n: f"${n}" for n in names}]}}}
    return stage


_STAGES: dict[str, Callable[[DataFrame, Any, Mapping, str], DataFrame]] = {
    "$match": _match,
    "$project": _project,
    "$addFields": _add_fields,
    "$set": _add_fields,
    "$unset": _unset,
    "$unwind": _unwind,
    "$group": _group,
    "$sort": _sort,
    "$limit": lambda df, x, others, place: df.limit(_whole_number(x, place, 1)),
    "$skip": lambda df, x, others, place: df.offset(_whole_number(x, place, 0)),
    "$count": _count,
    "$sortByCount": _sort_by_count,
    "$replaceRoot": _replace_root,
    "$replaceWith": _replace_root,
    "$unionWith": _union_with,
    "$lookup": _lookup,
}


def _steps(df: DataFrame, stages: Any, others: Mapping[str, DataFrame], place: str) -> DataFrame:
    if not isinstance(stages, list):
        raise PipelineError(f"{place}: a list of stages is wanted")
    done = -1
    for i, stage in enumerate(stages):
        if i == done:
            continue
        name, x = _single(stage, f"{place}[{i}]")
        at = f"{place}[{i}].{name}"
        if name not in _STAGES:
            raise PipelineError(f"{at}: unknown stage")
        after = stages[i + 1] if i + 1 < len(stages) else {}
        unwind = after.get("$unwind") if name == "$lookup" and isinstance(after, Mapping) else None
        plain = {"path": unwind} if isinstance(unwind, str) else unwind
        if plain and plain.get("path") == f"${x.get('as')}" and set(plain) <= {"path", "preserveNullAndEmptyArrays"}:
            # found rows that are unwound at once come from a plain join: no array of a key's rows is made
            df, done = _lookup(df, x, others, at, bool(plain.get("preserveNullAndEmptyArrays"))), i + 1
        else:
            df = _STAGES[name](df, x, others, at)
    return df


def aggregate(collection: DataFrame, pipeline: str | list, collections: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows that an aggregation pipeline, JSON text or its list of stages, yields of a collection.

    ``collections`` are the tables that ``$lookup`` and ``$unionWith`` may name.
    """
    try:
        stages = json.loads(pipeline) if isinstance(pipeline, str) else pipeline
    except json.JSONDecodeError as error:
        raise PipelineError(f"not JSON: {error}") from None
    return _steps(collection, stages, collections or {}, "pipeline")
