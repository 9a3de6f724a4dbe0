"""Nested records: flattening, JSON text, scalar normalisation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.dates import iso_text, ntz
from quayside.functions.text import trim_all

# The columns of a product programme record, in output order.
PROGRAM_COLUMNS = (
    "_id", "sku", "code", "pbm", "pbmspbm", "displayName", "pbmsdisplayName",
    "ValorBase", "ValorMaximo", "Desconto", "PorcentagemDesconto", "maximumPrice", "PMC",
)

# A page's items as they are landed; the sellers stay the JSON text they come as.
OFFER_PAGE_SCHEMA = """
    sku: string, reference_code: string, last_scan: struct<data: array<struct<
        domain: string, date_occurrence: string, availability: string, price: double, offer_price: double,
        sold_by: string, sellers: string, pack_price: double, pack_info: string, fator: double,
        factor_price: double, factor_offer_price: double, from_price: double>>>
"""

PROGRAM_SCHEMA = """
    _id string, sku string, code string, pbm string, displayName string,
    pbms array<struct<pbm: string, displayName: string, data: struct<
        ValorBase: double, ValorMaximo: double, Desconto: double, PorcentagemDesconto: double,
        price: string>>>
"""

# Fields of one offer and the output columns they feed, in output order.
OFFER_FIELDS = {
    "date_occurrence": "DATE_OCCURRENCE", "availability": "AVAILABILITY", "price": "PRICE",
    "offer_price": "OFFER_PRICE", "sold_by": "SOLD_BY", "sellers": "SELLERS",
    "pack_price": "pack_price", "pack_info": "pack_info", "fator": "fator",
    "factor_price": "factor_price", "factor_offer_price": "factor_offer_price",
    "from_price": "from_price",
}


def flatten_programs(products: DataFrame) -> DataFrame:
    """One row per product and programme; the product's own columns stay on the row.

    A product without programmes keeps one row. A price that is no record gives null price columns:
    as a struct through field access on a null struct, as JSON text through ``from_json``.
    """
    rows = products.select(
        "_id", "sku", "code", "pbm", "displayName", F.explode_outer("pbms").alias("program")
    )
    price_type = rows.schema["program"].dataType["data"].dataType["price"].dataType
    price = F.col("program.data.price")
    if isinstance(price_type, T.StringType):
        price = F.from_json(price, "maximumPrice double, PMC double")
    return rows.withColumn("price", price).select(
        "_id",
        "sku",
        "code",
        "pbm",
        F.col("program.pbm").alias("pbmspbm"),
        "displayName",
        F.col("program.displayName").alias("pbmsdisplayName"),
        "program.data.ValorBase",
        "program.data.ValorMaximo",
        "program.data.Desconto",
        "program.data.PorcentagemDesconto",
        "price.maximumPrice",
        "price.PMC",
    )


def flatten_offers(products: DataFrame, collected_at: datetime) -> DataFrame:
    """One row per product and offering domain; a product without a scan or with an empty one has none."""
    rows = products.select("sku", "reference_code", F.explode("last_scan.data").alias("offer"))
    offer_fields = set(rows.schema["offer"].dataType.names)
    columns = [
        ntz(collected_at).alias("data_coleta_preco"),
        F.col("sku").alias("SKU"),
        F.coalesce("reference_code", F.lit("")).alias("REFERENCE_CODE"),
        F.coalesce(trim_all(F.col("offer.domain")), F.lit("")).alias("DOMAIN"),
    ]
    for field, name in OFFER_FIELDS.items():
        if field not in offer_fields:
            value = F.lit("[]") if field == "sellers" else F.lit(None).cast("string")
        elif field == "sellers" and dict(rows.select("offer.*").dtypes)["sellers"] == "string":
            value = F.coalesce("offer.sellers", F.lit("[]"))
        elif field == "sellers":
            value = json_array_text(F.col("offer.sellers"))
        else:
            value = F.col(f"offer.{field}")
        columns.append(value.alias(name))
    return rows.select(columns)


def json_array_text(c: Column) -> Column:
    """An array as JSON text, a missing one as ``[]``."""
    return F.coalesce(F.to_json(c), F.lit("[]"))


def json_text(df: DataFrame, *names: str) -> DataFrame:
    """Nested columns as JSON text; all of them when none is named."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    chosen = set(names) or {f.name for f in df.schema if isinstance(f.dataType, nested)}
    return df.withColumns({n: F.to_json(F.col(f"`{n}`")) for n in df.columns if n in chosen})


def _scalar(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType) and dtype.names == ["$oid"]:
        return c["$oid"].cast("string")
    if isinstance(dtype, T.StructType) and dtype.names == ["$numberDecimal"]:
        return c["$numberDecimal"].try_cast("decimal(38,9)")
    if isinstance(dtype, T.StructType) and dtype.names == ["$date"]:
        return _scalar(c["$date"], dtype["$date"].dataType)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c, dtype)
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    return c


def normalize_scalars(df: DataFrame) -> DataFrame:
    """Ids to text, dates to ISO text, nested values to JSON text; decimals and the rest unchanged.

    Ids, decimals and dates are also recognised in their extended JSON form (``{"$oid": …}``).
    """
    return df.select([_scalar(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def raw_fallback(df: DataFrame, element: str, schema: str) -> DataFrame:
    """Open JSON elements into columns; one that does not fit them whole is also kept as text in ``_raw``.

    That is an element that is no record, one with fields that are not listed at any depth, or with a value
    of another type than its column's. Elements are parsed one by one, so a bad one does not spoil the document
    it came in.
    """
    text = F.col(element)
    is_record = F.ltrim(text).startswith("{")
    # a generator parses once: through a projection each condition on a field would parse the text again
    parsed = df.select("*", F.explode_outer(F.array(F.when(is_record, F.from_json(text, schema)))).alias("_record"))
    # the columns written as JSON again, against the text; unless equal as they are, both through a variant, which orders the fields
    again = F.to_json("_record")
    whole = F.to_json(F.try_parse_json(again)).eqNullSafe(F.to_json(F.try_parse_json(text)))
    raw = F.when(again == text, F.lit(None)).when(~is_record | ~whole, text)
    opened = parsed.withColumn("_raw", raw).drop(element)
    keep = [c for c in opened.columns if c not in ("_record", "_raw")]
    return opened.select(*keep, "_record.*", "_raw")
