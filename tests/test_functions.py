import re
import unicodedata
from datetime import date, datetime
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import coerce, dates, text
from quayside.operators import filters


def apply(spark, fn, values, dtype="string"):
    """The expression's results for a list of values, in their order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_trim_all_is_python_strip(spark):
    values = ["\t a b \n", " x ", "", " \r\n ", "a", None]
    assert apply(spark, text.trim_all, values) == [v if v is None else v.strip() for v in values]


def test_strip_accents_is_decomposition(spark):
    values = ["Ação, É você?", "naïve_Ünïcode 1", "ǞǠ ≠ ß", "áê", "KK ÅÅ", None]
    kept = [
        v if v is None else re.sub("[^A-Za-z0-9_ ]", "", unicodedata.normalize("NFD", v)) for v in values
    ]
    assert apply(spark, text.strip_accents, values) == kept


def test_fix_mojibake(spark):
    values = [" SÃ£o Paulo ", "farmÃ¡cia", "donâ€t", "don€t Ã", "Ãx", "abc", "São", None]
    assert apply(spark, text.fix_mojibake, values) == [
        "São Paulo", "farmácia", "donâ€t", "don€t Ã", "Ãx", "abc", "São", None,
    ]
    strict = apply(spark, lambda c: text.fix_mojibake(c, strict_reference=True), values[:2])
    assert strict == ["SÃ£o Paulo", "farmÃ¡cia"]


def test_title_case_is_python_title(spark):
    values = ["4you loja", "abc 12def3g", "a\tb c", "ABC"]
    assert apply(spark, text.title_case, values) == [v.title() for v in values]


@pytest.mark.parametrize(
    "domain, seller, expected",
    [
        (" www.Shop-One.com.br ", "ignored", "Shopone"),
        ("  ", "Loja 4you", "Loja 4You"),
        (None, None, None),
        ("", " ", None),
        ("www.", None, None),
        ("Pague e Menos.com", None, "Pague Menos"),
        ("pague.menos", None, "Pague Menos"),
        ("menos", None, "Menos"),
        ("drogaria x.com", None, "Drogaria X"),
        ("SÃ£o JoÃ£o.com", None, "So Joo"),
        ("Minha Marca Ltda", None, "Marca"),
    ],
)
def test_entity_name(spark, domain, seller, expected):
    df = spark.createDataFrame([(domain, seller)], "d string, s string")
    rules = [*text.BRAND_RULES, (("marca",), "Marca")]
    named = text.with_entity_name(df, "name", F.col("d"), F.col("s"), brand_rules=rules)
    assert named.columns == ["d", "s", "name"]
    assert named.first()["name"] == expected


def test_url_host_is_urlparse(spark):
    values = ["https://a.com/x?y#z", "a.com/x/", "//b.com", "http://c.com:80//", "d.com?q=1", "plain", ""]

    def expected(v):
        parsed = urlparse(v)
        return (parsed.netloc or parsed.path).rstrip("/")

    assert apply(spark, text.url_host, values) == [expected(v) for v in values]


def test_parse_iso(spark):
    values = [
        "2020-02-01T00:00:00.52Z", "2020-12-09T16:09:53+00:00", " 2020-12-09 16:09:53-03:00 ",
        "2020-12-09", "2020-12-09T01:30:00+02:00", "2020", "12:30", "soon", "2020-13-01", "", None,
    ]
    assert apply(spark, dates.parse_iso, values) == [
        datetime(2020, 2, 1, 0, 0, 0, 520000), datetime(2020, 12, 9, 16, 9, 53), datetime(2020, 12, 9, 19, 9, 53),
        datetime(2020, 12, 9), datetime(2020, 12, 8, 23, 30), None, None, None, None, None, None,
    ]
    # the day is the one written, not the one in UTC
    assert apply(spark, dates.iso_day, values)[4] == date(2020, 12, 9)


def test_dates_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert apply(spark, dates.parse_iso, ["2020-01-01T01:00:00Z"]) == [datetime(2020, 1, 1, 1)]
        assert apply(spark, dates.iso_day, ["2020-01-01T01:00:00Z"]) == [date(2020, 1, 1)]
        assert spark.range(1).select(dates.ntz(datetime(2020, 1, 1, 5))).first()[0] == datetime(2020, 1, 1, 5)
        # the clocks of that zone skipped this hour in 2018
        skipped = apply(spark, dates.iso_text, [datetime(2018, 11, 4, 0, 30)], "timestamp_ntz")
        assert skipped == ["2018-11-04T00:30:00"]
        instants = ["2020-01-01", "2020-01-01 10:00:00.5", "2020-01-01T10:00:00-03:00", "bad", "", "12:30"]

        def text_of(c):
            return dates.iso_text(dates.utc_instant(c).try_cast("timestamp"), T.TimestampType())

        assert apply(spark, text_of, instants) == [
            "2020-01-01T00:00:00", "2020-01-01T10:00:00.500000", "2020-01-01T13:00:00", None, None, None,
        ]
        stamps = spark.sql("select timestamp'2020-01-01 03:00:00Z' as t, date'2020-01-01' as d")
        assert filters.incremental_window(stamps, "t", "2020-01-01", deleted=None).count() == 1
        assert filters.incremental_window(stamps, "d", "2020-01-01", "2020-01-02", deleted=None).count() == 1
        assert filters.lookback_window(stamps, "t", date(2020, 1, 3)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_days(spark):
    run = date(2025, 3, 10)
    lenient = apply(spark, lambda c: dates.lenient_day(c, run), [" 2024-02-29 ", "2024-02-30", "x", "", None])
    assert lenient == [date(2024, 2, 29), run, run, run, run]
    with pytest.raises(Exception, match="CANNOT_PARSE|parse"):
        apply(spark, dates.strict_day, ["2024/01/01"])
    asked = [(None, 0), (None, 3), (" 2025-01-02 ", 3), ("02/01/2025", 3), ("  ", 3)]
    days = spark.range(1).select([dates.run_day(text, run, back).alias(f"d{i}") for i, (text, back) in enumerate(asked)])
    assert list(days.first()) == [run, date(2025, 3, 7), date(2025, 1, 2), run, date(2025, 3, 7)]
    assert dates.wall_time(date(2025, 1, 2)) == dates.wall_time("2025-01-02") == datetime(2025, 1, 2)
    assert dates.wall_time(datetime(2025, 1, 2, 3, 4)) == datetime(2025, 1, 2, 3, 4)
    with pytest.raises(ValueError):
        dates.wall_time("01/02/2025")


def test_iso_text(spark):
    got = apply(spark, dates.iso_text, [datetime(2020, 1, 2, 3, 4, 5), datetime(2020, 1, 2, 3, 4, 5, 600)], "timestamp_ntz")
    assert got == ["2020-01-02T03:04:05", "2020-01-02T03:04:05.000600"]


def test_integers(spark):
    odd = ["12345678901234567.0", "1.5e1", "15e-1", ".0", "-7.", "+3", "1,0", "e", "inf", "1e400"]
    assert apply(spark, coerce.to_integer, odd) == [12345678901234567, 15, None, 0, -7, 3, None, None, None, None]
    values = ["1e3", "3.5", "12345678901234567", "z", "7.0", " 8 ", "", None, "9223372036854775808", "1d", "0x10", "nan"]
    assert apply(spark, coerce.to_integer, values) == [
        1000, None, 12345678901234567, None, 7, 8, None, None, None, None, None, None,
    ]


def test_numbers_and_booleans(spark):
    assert apply(spark, coerce.to_number, [".5", "5.", "-1E+2", " 7 ", "inf", "1 2"]) == [0.5, 5.0, -100.0, 7.0, float("inf"), None]
    assert apply(spark, coerce.to_number, ["1.5", "2f", "NaN", "1e-2", "x", None]) == [1.5, None, None, 0.01, None, None]
    assert apply(spark, coerce.to_boolean, ["TRUE", "false", "yes", "1", "t", None]) == [True, False, None, None, None, None]


def test_coerced_times(spark):
    values = ["2020-01-01", "2020-01-01 10:00:00", "2020-01-01T10:00:00-03:00", "bad"]
    assert apply(spark, coerce.to_datetime, values) == [
        datetime(2020, 1, 1), datetime(2020, 1, 1, 10), datetime(2020, 1, 1, 13), None,
    ]
    assert apply(spark, coerce.to_date, values) == [date(2020, 1, 1)] * 3 + [None]
