import gzip
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayside.operators.audit import run_id_of, with_run_audit
from quayside.plans import runs
from quayside.plans.hooks import common_chain, custom_transform, keep_first
from quayside.plans.publish import append_run, merge_range
from quayside.plans.runs import build_models, counted, read_source, run_all, run_files, run_summary, source_uri
from quayside.queries.runs import FILE_CONFIG
from quayside.queries.scans import workbook_bytes
from quayside.sources.tables import external_table
from quayside.streaming import arrivals
from quayside.streaming.arrivals import stream_ingest

RUN = datetime(2025, 3, 10, 12)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def config_row(source, kind, output, **kw):
    row = dict.fromkeys([part.split()[0] for part in FILE_CONFIG.split(",")])
    row |= {"source_file_name": source, "file_name": source, "active": True, "file_format": kind, "output_file_name": output}
    return tuple((row | kw).values())


def test_files_run(spark, tmp_path):
    drop, out = tmp_path / "drop", tmp_path / "out"
    drop.mkdir()
    agenda = [["GRUPO_COMPRA", "Descrição"], ["g1", "first"], ["g2", "x"], ["g1", "second"]]
    (drop / "Agenda.xlsx").write_bytes(workbook_bytes({"Plan1": agenda, "Plan2": [["Preço"], ["1,5"], ["2,25"]]}))
    (drop / "mercado.txt").write_bytes("Código;Preço\n1;1,5\n2;\n".encode("latin-1"))
    config = spark.createDataFrame(
        [
            config_row("Agenda.xlsx", "xlsx", "agenda", sheet_name="0", custom_processor="agenda_sugestao_compras"),
            config_row("Agenda.xlsx", "xlsx", "precos", sheet_name="Plan2", decimal=",", output_file_format="parquet"),
            config_row(
                "mercado.txt", "txt", "mercado", delimiter=";", encoding="latin1", decimal=",",
                gcs_folder="arquivos/", output_file_format="parquet", write_mode="partitioned",
            ),
            config_row("Agenda.xlsx", "xlsx", "bad", sheet_name="Plan1", custom_processor="none_such"),
            config_row("Agenda.xlsx", "ods", "worse", sheet_name="Plan1"),
        ],
        FILE_CONFIG,
    )
    report = run_files(spark, config, str(drop), str(out), RUN, ["Agenda.xlsx", "mercado.txt", "lost.csv"])
    assert rows(report.select("source", "target", "status", "rows")) == [
        ("Agenda.xlsx", "agenda", "ok", 2),
        ("Agenda.xlsx", "bad", "failed", 0),
        ("Agenda.xlsx", "precos", "ok", 2),
        ("Agenda.xlsx", "worse", "failed", 0),
        ("lost.csv", None, "failed", 0),
        ("mercado.txt", "mercado", "ok", 2),
    ]
    agenda = spark.read.option("header", True).csv(str(out / "agenda"))
    assert agenda.columns == ["GRUPO_COMPRA", "DESCRICAO", "DT_INGESTAO"]
    assert rows(agenda) == [(g, d, "2025-03-10 09:00:00.000000") for g, d in (("g1", "first"), ("g2", "x"))]
    assert rows(spark.read.parquet(str(out / "precos")).select("PRECO")) == [(1.5,), (2.25,)]
    mercado = spark.read.parquet(str(out / "arquivos" / "mercado"))
    assert mercado.dtypes[:2] == [("CODIGO", "bigint"), ("PRECO", "double")]
    assert rows(mercado.select("CODIGO", "PRECO", F.col("dt").cast("string"))) == [(1, 1.5, "2025-03-10"), (2, None, "2025-03-10")]
    assert rows(run_summary(report)) == [
        ("Agenda.xlsx", "failed", 2, 0), ("Agenda.xlsx", "ok", 2, 4), ("lost.csv", "failed", 1, 0), ("mercado.txt", "ok", 1, 2),
    ]


def test_unknown_hook(spark):
    with pytest.raises(ValueError, match="no custom transform"):
        custom_transform(spark.range(1), "x")
    assert custom_transform(spark.range(3), None).count() == 3


def test_chain_types_only_typed_outputs(spark):
    df = spark.createDataFrame([("1", "f", 0)], "`Nº` string, _file string, _row int")
    assert common_chain(df, RUN, "csv").dtypes == [("N", "string"), ("DT_INGESTAO", "timestamp_ntz")]
    assert common_chain(df, RUN, "parquet").dtypes[0] == ("N", "bigint")


def test_source_uri():
    assert source_uri("r/", "Vendas.Pedidos") == "r/vendas/pedidos"
    assert source_uri("r", "Pedidos") == "r/dbo/pedidos"


def drop_gz(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_takes_only_new_files(spark, tmp_path):
    source, target, state, rejects = (str(tmp_path / n) for n in ("in", "out", "state", "rejects"))
    types = {"id": "INTEGER", "ok": "BOOLEAN"}

    def run():
        stream_ingest(spark, source, target, state, ["id", "ok"], types, rejects)
        return rows(spark.read.parquet(target).select("id", "ok", F.col("run").cast("string")))

    drop_gz(tmp_path / "in" / "run=2025-01-01", "a.gz", ["id|ok", "1|true", "x|yes"])
    (tmp_path / "in" / "run=2025-01-01" / "note.txt").write_text("id|ok\n9|true\n")
    first = [(1, True, "2025-01-01"), (None, None, "2025-01-01")]
    assert run() == first
    assert run() == first
    drop_gz(tmp_path / "in" / "run=2025-01-01", "b.gz", ["id|ok", "2|FALSE"])
    drop_gz(tmp_path / "in" / "run=2025-01-02", "c.gz", ["id|ok", "3|"])
    assert run() == [(1, True, "2025-01-01"), (2, False, "2025-01-01"), (3, None, "2025-01-02"), (None, None, "2025-01-01")]
    counts = spark.read.parquet(rejects).groupBy("column_name").agg(F.sum("rejected"))
    assert rows(counts) == [("id", 1), ("ok", 1)]


def test_a_file_sent_again_takes_the_place_of_its_rows(spark, tmp_path):
    source, target, state, rejects = (str(tmp_path / n) for n in ("in", "out", "state", "rejects"))
    folder = tmp_path / "in" / "run=2025-01-01"

    def run():
        stream_ingest(spark, source, target, state, ["id", "ok"], {"id": "INTEGER"}, rejects)
        return rows(external_table(spark, target).select("id", "ok"))

    drop_gz(folder, "a b+c.gz", ["id|ok", "1|a", "2|b"])
    drop_gz(folder, "b.gz", ["id|ok", "3|c"])
    assert run() == [(1, "a"), (2, "b"), (3, "c")]
    drop_gz(folder, "a b+c.gz", ["ok|id", "x|10"])  # other rows, in another order of columns
    drop_gz(tmp_path / "in", "late.gz", ["id|ok", "5|e"])  # new, and of no run
    assert run() == [(10, "x"), (3, "c"), (5, "e")]
    assert run() == [(10, "x"), (3, "c"), (5, "e")]
    drop_gz(folder, "b.gz", ["id|ok"])  # no rows any more
    drop_gz(tmp_path / "in", "late.gz", ["id|ok", "oops|f"])
    assert run() == [(10, "x"), (None, "f")]
    os.utime(folder / "b.gz", (1, 1))  # the same content, but written again
    assert run() == [(10, "x"), (None, "f")]
    assert sorted(p.name for p in (tmp_path / "rejects").iterdir() if p.is_dir()) == ["batch=-1", "batch=-2", "batch=-3", "batch=0", "batch=1"]
    with pytest.raises(ValueError, match="arrival"):
        stream_ingest(spark, source, target, state, ["Arrival"], {})


def test_a_batch_that_failed_after_its_commit_adds_nothing_twice(spark, tmp_path, monkeypatch):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    drop_gz(tmp_path / "in" / "run=2025-01-01", "a.gz", ["id", "1", "2"])
    with monkeypatch.context() as m:
        m.setattr(arrivals, "_LEDGER", "path string")  # the ledger's write fails after the rows are committed
        with pytest.raises(Exception):
            stream_ingest(spark, source, target, state, ["id"], {"id": "INTEGER"})
    stream_ingest(spark, source, target, state, ["id"], {"id": "INTEGER"})
    stream_ingest(spark, source, target, state, ["id"], {"id": "INTEGER"})
    assert rows(external_table(spark, target).select("id")) == [(1,), (2,)]


def _landed(spark, root, name, days):
    for day, df in days:
        run = datetime(2025, 3, day, 2)
        append_run(with_run_audit(df, run), f"{root}/dbo/{name}", run.date(), run_id_of(run))


def _model(name, kind="FULL"):
    return (f"dbo.{name}", None, "bronze", name, kind, None if kind == "FULL" else "d", None, None, 0)


MODELS = """source_table_name string, source_file_name string, target_dataset string, target_table_name string, migration_type string,
    partition_column string, filter_column string, incremental_join_clause string, flag_table_created int"""


def test_models_are_honest(spark, tmp_path):
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    text = spark.createDataFrame([("7.0", "a"), ("3.5", "b"), ("n/d", "c"), (None, "d")], "k string, s string")
    _landed(spark, landing, "lossy", [(9, text)])
    _landed(spark, landing, "drift", [(8, text.select("k")), (9, text)])
    _landed(spark, landing, "bare", [(9, text)])
    config = spark.createDataFrame([_model(n) for n in ("lossy", "drift", "bare")], MODELS)
    catalogues = spark.createDataFrame(
        [("DBO.Lossy", "k", "int"), ("dbo.lossy", "s", "varchar"), ("dbo.drift", "s", "varchar")], "table_name string, column_name string, data_type string"
    )
    report = build_models(spark, config, landing, bronze, catalogues, "sqlserver", "2025-01-01", "2025-12-31").collect()
    by = {r["target"]: r for r in report}
    assert (by["lossy"]["status"], by["lossy"]["rows"], by["lossy"]["rejected"]) == ("ok", 4, 2)
    assert sorted(spark.read.parquet(f"{bronze}/bronze/lossy").filter("K is not null").select("K").collect()) == [(7,)]
    assert (by["drift"]["status"], by["drift"]["rows"]) == ("ok", 4)
    assert by["bare"]["status"] == "failed" and "catalogue" in by["bare"]["message"]
    strict = build_models(spark, config, landing, bronze, catalogues, "sqlserver", "2025-01-01", "2025-12-31", strict=True).collect()
    assert {r["target"]: r["status"] for r in strict}["lossy"] == "failed"


def test_an_empty_snapshot_clears_its_range(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.sql("select id, date_add(date'2025-01-01', cast(id as int)) DT from range(5)")
    merge_range(spark, rows, path, "2025-01-01", "2025-01-31")
    seen = counted(rows.limit(0), lambda df: merge_range(spark, df, path, "2025-01-02", "2025-01-03"))
    assert seen == 0
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 3, 4]


def test_errors_without_text_are_reported():
    def job():
        raise AssertionError

    assert run_all([("a", "b", job)], 1) == [("a", "b", "failed", 0, "AssertionError: ", None)]


def test_first_row_of_a_text_folder_is_of_its_first_file(spark, tmp_path):
    (tmp_path / "t.csv").mkdir()
    (tmp_path / "t.csv" / "a.csv").write_text("k,v,w\nx,first,\"1,5\"\n")
    (tmp_path / "t.csv" / "b.csv").write_text("k,v,w\n" + "".join(f"x,later {i},\"2,5\"\n" for i in range(500)) + "y,\"10,20\",\"3\"\n")
    cfg = {"source_file_name": "t.csv", "file_format": "csv", "delimiter": ",", "decimal": ","}
    table = read_source(spark, cfg, str(tmp_path))
    kept = custom_transform(table, "one", None, {"one": keep_first("k")})
    # a column with other text keeps its commas, one of numbers gets points
    assert sorted((r.k, r.v, r.w) for r in kept.collect()) == [("x", "first", "1.5"), ("y", "10,20", "3")]


def _endless(spark):
    return spark.range(10**15, numPartitions=2).selectExpr("sum(sqrt(id)) as s").first()[0]


def test_rows_over_their_limit_are_cut_off(spark, monkeypatch):
    monkeypatch.setattr(runs, "_GRACE", 1.0)
    names = []

    def named(value):
        names.append(spark.sparkContext.getLocalProperty("quayside.test"))
        return value

    def stubborn():  # begins again after each cancellation
        while True:
            try:
                _endless(spark)
            except Exception:
                if len(names) > 20:
                    raise
                names.append("again")

    spark.sparkContext.setLocalProperty("quayside.test", "mine")
    jobs = [("a", "a", lambda: _endless(spark)), ("b", "b", lambda: named(2)), ("c", "c", lambda: time.sleep(60)), ("d", "d", stubborn), ("e", "e", lambda: named(spark.range(5).count()))]
    began = time.monotonic()
    report = run_all(jobs, 2, spark, limit=3.0, pool="rows")
    assert time.monotonic() - began < 40
    assert [r[:4] for r in report] == [("a", "a", "failed", 0), ("b", "b", "ok", 2), ("c", "c", "failed", 0), ("d", "d", "failed", 0), ("e", "e", "ok", 5)]
    assert [r[4] for r in report if r[4]][0] == "cut off after 3 s" and "outside Spark" in report[2][4]
    assert names.count("mine") == 2
    names.extend(["again"] * 30)  # lets the stubborn one end
    with pytest.raises(ValueError, match="session"):
        run_all([], 1, limit=1.0)
    assert spark.range(3).count() == 3  # jobs of others were not touched
