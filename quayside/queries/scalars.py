"""Scalar functions over whole columns of the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from quayside.functions import dates, names, text
from quayside.plans import publish
from quayside.queries.register import query, table


@query(
    "strip_accents",
    "select doc_id, regexp_replace(strip_accents(text), '[^A-Za-z0-9_ ]', '', 'g') as text from documents",
)
def strip_accents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_accents(F.col("text")).alias("text"))


@query("fix_mojibake", "select doc_id, '§ ' || text || ' ã.' as text from documents")
def fix_mojibake(spark, sf_dir):
    whole = F.concat(F.lit(" § "), "text", F.lit(" ã.\n"))
    mangled = F.decode(F.encode(whole, "UTF-8"), "ISO-8859-1")
    return table(spark, sf_dir, "documents").select("doc_id", text.fix_mojibake(mangled).alias("text"))


_SELLER = """case page_id % 6 when 0 then 'Pague-Menos ' || page_id when 1 then '  ' when 2 then ' 4you loja ' || page_id
             when 3 then null else 'x' end"""


@query(
    "normalize_entity",
    f"""with p as (select page_id, {_SELLER} seller,
                  regexp_extract(url, '://([^/?#]*)', 1) host from pages),
            c as (select page_id, case when page_id % 2 = 0 and trim(seller) <> '' then seller
                                       when page_id % 6 = 5 then null else host end s from p),
            h as (select page_id, lower(trim(s)) s from c),
            n as (select page_id, s, trim(regexp_replace(split_part(regexp_replace(s, '^www\\.', ''), '.', 1),
                                                         '[^a-z0-9 ]', '', 'g')) t from h)
       select page_id, case when s like '%pague%' and s like '%menos%' then 'Pague Menos'
                            when s like '%spam%' then 'Spam'
                            when t like '4you%' then '4You Loja ' || page_id
                            when t = '' then null
                            else upper(t[1]) || t[2:] end as entity from n""",
)
def normalize_entity(spark, sf_dir):
    k = F.col("page_id") % 6
    pages = table(spark, sf_dir, "pages")
    page = F.col("page_id").cast("string")
    seller = (
        F.when(k == 0, F.concat(F.lit("Pague-Menos "), page))
        .when(k == 1, F.lit("  "))
        .when(k == 2, F.concat(F.lit(" 4you loja "), page))
        .when(k != 3, F.lit("x"))
    )
    domain = F.when(F.col("page_id") % 2 == 0, seller)
    host = F.when(k != 5, text.url_host(F.col("url")))
    rules = [*text.BRAND_RULES, (("spam",), "Spam")]
    return text.with_entity_name(pages, "entity", domain, host, brand_rules=rules).select("page_id", "entity")


@query(
    "url_host",
    """select page_id, regexp_extract(url, '://([^/?#]*)', 1) host,
              regexp_replace(regexp_replace(regexp_extract(url, '://(.*)$', 1), '[?#].*$', ''), '/+$', '') bare
       from pages""",
)
def url_host(spark, sf_dir):
    bare = F.regexp_extract("url", "://(.*)$", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id", text.url_host(F.col("url")).alias("host"), text.url_host(bare).alias("bare")
    )


@query(
    "external_name",
    """select doc_id, 'ext_' || replace(lower('Dim__' || source || '__' || lang), '__', '_') as name from documents""",
)
def external_name(spark, sf_dir):
    target = F.concat(F.lit("Dim__"), "source", F.lit("__"), "lang")
    return table(spark, sf_dir, "documents").select("doc_id", names.external_name(target).alias("name"))


def _moments(spark, sf_dir):
    """Event times as text, as a Z, an offset and a plain form, and every fourth spoiled."""
    k = F.col("event_id") % 4
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    written = (
        F.when(k == 0, F.concat(iso, F.lit("Z")))
        .when(k == 1, F.concat(iso, F.lit("-03:00")))
        .when(k == 2, F.concat(F.lit(" "), iso))
        .otherwise(F.concat(F.lit("at "), iso))
    )
    return table(spark, sf_dir, "events").select("event_id", "ts", written.alias("written"))


_UTC = """select event_id, case event_id % 4 when 1 then (ts + interval 3 hour)::varchar when 3 then null
                           else ts::varchar end as moment {day} from events"""


@query("parse_iso_ts", _UTC.format(day=", case when event_id % 4 <> 3 then ts::date::varchar end as \"day\""))
def parse_iso_ts(spark, sf_dir):
    return _moments(spark, sf_dir).select(
        "event_id",
        dates.parse_iso(F.col("written")).alias("moment"),
        dates.iso_day(F.col("written")).alias("day"),
    )


@query("coerce_datetime", _UTC.format(day=""))
def coerce_datetime(spark, sf_dir):
    rows = _moments(spark, sf_dir)
    return rows.select("event_id", dates.coerce_datetime(F.col("written")).alias("moment"))


@query(
    "parse_day",
    """select event_id, ts::date::varchar strict,
              case when event_id % 5 = 0 then '2024-02-29' else ts::date::varchar end lenient from events""",
)
def parse_day(spark, sf_dir):
    day = F.date_format("ts", "yyyy-MM-dd")
    loose = F.when(F.col("event_id") % 5 != 0, F.concat(F.lit(" "), day)).when(F.col("event_id") % 10 == 0, "2024-02-31")
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.strict_day(day).alias("strict"),
        dates.lenient_day(loose, date(2024, 2, 29)).alias("lenient"),
    )


@query(
    "destination_path",
    """select page_id, case when page_id % 2 = 0
                then 'arquivos/' || folder || '/' || stem || '/dt=2025-03-10/' || stem || '.parquet'
                else 'arquivos/' || folder || '/' || stem || '.parquet' end destination
       from (select page_id, case when page_id % 3 = 0 then 'mensal' else 'semanal' end folder,
                    case when page_id % 3 = 0 then 'RPE_117_' else 'FF_107_' end || 'x' || page_id || '.v1' stem from pages)""",
)
def destination_path(spark, sf_dir):
    page = F.col("page_id")
    mark = F.when(page % 3 == 0, "RPE_117_").otherwise("FF_107_")
    file_name = F.concat(F.lit("drop/"), mark, F.lit("x"), page.cast("string"), F.lit(".v1.txt"))
    folder = F.concat(F.lit("arquivos/"), publish.period_folder(file_name), F.lit("/"))
    mode = F.when(page % 2 == 0, "partitioned").otherwise("overwrite")
    path = publish.destination_path(file_name, folder, mode, F.lit("parquet"), date(2025, 3, 10))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("destination"))


@query(
    "zone_path",
    """select page_id, 'bucket/landing/' || replace(replace(url, 'transient', 'landing'), '.gz', '.parquet')
              || '/run=2025-03-10/part.parquet' as path from pages""",
)
def zone_path(spark, sf_dir):
    source = F.concat(F.lit("bucket/transient/"), "url", F.lit("/run=2025-03-10/part.gz"))
    return table(spark, sf_dir, "pages").select("page_id", publish.zone_path(source).alias("path"))
