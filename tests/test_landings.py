from datetime import date, datetime

from pyspark.sql import functions as F

from quayside.plans import landings
from quayside.sources.tables import external_table

RUN = datetime(2025, 3, 10, 12)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_collection_landing_makes_everything_text(spark, tmp_path):
    df = spark.createDataFrame(
        [(("a1",), "2025-01-02T03:00:00-03:00", {"k": 1}), (("a2",), "never", None)],
        "_id struct<`$oid`: string>, deletedAt string, `a.b` map<string,int>",
    )
    assert landings.land_collection(df, str(tmp_path / "c"), RUN) == 2
    landed = spark.read.parquet(str(tmp_path / "c"))
    assert rows(landed.select("_id", "a_b", "deletedAt")) == [
        ("a1", '{"k":1}', "2025-01-02T06:00:00+00:00"),
        ("a2", None, None),
    ]


def test_drop_without_files_lands_nothing(spark, tmp_path):
    (tmp_path / "in" / "2025-03-10").mkdir(parents=True)
    assert landings.land_drop(spark, str(tmp_path / "in"), date(2025, 3, 10), str(tmp_path / "out"), RUN) == 0
    assert landings.land_drop(spark, str(tmp_path / "in"), date(2025, 3, 11), str(tmp_path / "out"), RUN) == 0
    assert not (tmp_path / "out").exists()


def test_offers_use_the_seller_when_the_domain_is_blank(spark, tmp_path):
    body = """{"data": {"scan": [{"sku": "1", "last_scan": {"data": [
        {"domain": "www.loja.com", "price": 1.5, "sellers": [{"name": "á"}]}, {"domain": " ", "sold_by": "Pague-Menos"}, {}]}}]}}"""
    df = spark.createDataFrame([(body,)], "body string")
    assert landings.land_offers(df, str(tmp_path / "o"), RUN) == 3
    landed = external_table(spark, str(tmp_path / "o"), "csv")
    assert rows(landed.select("CONCORRENTE", "PRICE", "SELLERS", F.col("dt").cast("string"))) == [
        ("Loja", "1.5", '[{"name":"á"}]', "2025-03-10"),
        ("Pague Menos", None, "[]", "2025-03-10"),
        (None, None, "[]", "2025-03-10"),
    ]


def test_survey_keeps_recent_facts_of_recent_cycles(spark, tmp_path):
    def documents(*records):
        return spark.createDataFrame([('{"payload": [' + ", ".join(records) + "]}",)], "body string")

    report = landings.land_survey(
        spark,
        {
            "cycle": documents('{"id": "b", "cycleEndDate": "2025-03-01T00:00:00Z"}', '{"id": "old", "cycleEndDate": "2024-01-01"}', "5"),
            "answers": documents(
                '{"cycle": "b", "updatedAt": "2025-03-09T00:00:00", "n": {"x": [1]}}',
                '{"cycle": "b", "updatedAt": "2025-03-01T00:00:00"}',
                '{"cycle": "old", "updatedAt": "2025-03-09T00:00:00"}',
            ),
        },
        {"cycle": "id string, cycleEndDate string", "answers": "cycle string, updatedAt timestamp_ntz, n struct<x: array<int>>"},
        str(tmp_path),
        RUN,
        {"answers": "cycle"},
        order="cycleEndDate",
    )
    assert rows(report.select("source", "status", "rows")) == [("answers", "ok", 1), ("cycle", "ok", 3)]
    answers = external_table(spark, str(tmp_path / "answers"))
    assert rows(answers.select("cycle", "n.x", "dt_ingestao", "id_execucao")) == [
        ("b", [1], "2025-03-10T12:00:00Z", "20250310T120000Z")
    ]
    assert external_table(spark, str(tmp_path / "cycle")).filter("_raw = '5'").count() == 1
