"""Tables of commits, and the swap of a whole table: what readers see, also where a run dies between steps."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quayside import commits, storage
from quayside.operators.filters import start_of_extract
from quayside.plans import publish
from quayside.sources.tables import external_table


def days(spark, values):
    return spark.createDataFrame([(v, d and date.fromisoformat(d)) for v, d in values], "v int, DT date")


def held(spark, path):
    return sorted((r["v"], str(r["DT"])) for r in external_table(spark, path).collect())


class Died(Exception):
    pass


def dying(monkeypatch, name, after=0):
    """A storage call that dies instead of doing its work, after so many calls that went well."""
    real, left = getattr(storage, name), [after]

    def call(*args):
        if left[0] <= 0:
            raise Died(name)
        left[0] -= 1
        return real(*args)

    monkeypatch.setattr(storage, name, call)


BASE = [(1, "2025-01-01"), (2, "2025-01-02"), (3, "2025-01-03"), (4, "2025-01-04")]
SNAPSHOT = [(20, "2025-01-02"), (40, "2025-01-04"), (50, "2025-01-05")]
MERGED = [(1, "2025-01-01"), (4, "2025-01-04"), (20, "2025-01-02"), (40, "2025-01-04"), (50, "2025-01-05")]


def test_rows_are_evaluated_once(spark, tmp_path):
    path, seen = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def counted(v):
        seen.add(1)
        return v

    publish.replace_partition(days(spark, BASE), path, "DT")
    rows = days(spark, SNAPSHOT).repartition(3).withColumn("v", F.udf(counted, "int")("v"))
    publish.merge_range(spark, rows, path, "2025-01-02", "2025-01-03")
    assert held(spark, path) == MERGED and seen.value == len(SNAPSHOT)
    publish.replace_partition(rows, path, "DT")
    assert seen.value == 2 * len(SNAPSHOT)


def test_death_before_the_end_leaves_the_old_days(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish.replace_partition(days(spark, BASE), path, "DT")
    late = days(spark, SNAPSHOT).repartition(4).withColumn("v", F.when(F.col("v") < 50, F.col("v")).otherwise(F.raise_error(F.lit("no")).cast("int")))
    with pytest.raises(Exception, match="no"):
        publish.merge_range(spark, late, path, "2025-01-02", "2025-01-03")
    # files of tasks that ended may lie there; no commit has them
    assert held(spark, path) == sorted(BASE)
    with monkeypatch.context() as m:
        dying(m, "write_text")
        with pytest.raises(Died):
            publish.merge_range(spark, days(spark, SNAPSHOT), path, "2025-01-02", "2025-01-03")
    assert held(spark, path) == sorted(BASE)
    publish.merge_range(spark, days(spark, SNAPSHOT), path, "2025-01-02", "2025-01-03")
    assert held(spark, path) == MERGED
    # the commits that never ended are swept
    assert len([n for n in storage.child_folders(spark, path) if n.startswith("commit=")]) == 2


@pytest.mark.parametrize("deletions", [0, 1])
def test_death_after_the_end_leaves_the_new_days(spark, tmp_path, monkeypatch, deletions):
    path = str(tmp_path / "t")
    publish.replace_partition(days(spark, BASE), path, "DT")
    with monkeypatch.context() as m:
        dying(m, "delete", deletions)
        with pytest.raises(Died):
            publish.merge_range(spark, days(spark, SNAPSHOT), path, "2025-01-02", "2025-01-03")
    assert held(spark, path) == MERGED
    # replaced folders that were left are swept by the next run, and hide nothing then
    publish.replace_partition(days(spark, [(9, "2025-01-01")]), path, "DT")
    assert held(spark, path) == sorted([r for r in MERGED if r[0] != 1] + [(9, "2025-01-01")])
    plain = spark.read.parquet(path)
    assert sorted((r["v"], str(r["DT"])) for r in plain.collect()) == held(spark, path) and "commit" in plain.columns


def test_no_file_is_moved_by_the_driver(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    dying(monkeypatch, "rename")
    publish.replace_partition(days(spark, BASE), path, "DT")
    publish.merge_range(spark, days(spark, SNAPSHOT), path, "2025-01-02", "2025-01-03")
    assert held(spark, path) == MERGED


def test_merge_onto_plain_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    days(spark, BASE).write.partitionBy("DT").parquet(path)
    publish.merge_range(spark, days(spark, SNAPSHOT), path, "2025-01-02", "2025-01-03")
    assert held(spark, path) == MERGED
    publish.replace_partition(days(spark, [(41, "2025-01-04")]), path, "DT")
    assert held(spark, path) == sorted([r for r in MERGED if r[1] != "2025-01-04"] + [(41, "2025-01-04")])


def test_days_without_rows_null_days_and_two_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.replace_partition(days(spark, BASE + [(7, None)]), path, "DT")
    publish.merge_range(spark, days(spark, []), path, "2025-01-01", "2025-01-03")
    assert held(spark, path) == [(4, "2025-01-04"), (7, "None")]
    publish.merge_range(spark, days(spark, [(8, None)]), path, "2025-01-01", "2025-01-03")
    assert held(spark, path) == [(4, "2025-01-04"), (7, "None"), (8, "None")]  # outside any range: added
    publish.merge_range(spark, days(spark, []), path, "2025-01-01", "2025-01-31")
    publish.replace_partition(days(spark, [(9, None)]), path, "DT")
    assert held(spark, path) == [(9, "None")]
    two = str(tmp_path / "two")
    rows = spark.createDataFrame([(1, "x", 1), (2, "x", 2), (3, "y", 1)], "v int, a string, b int")
    publish.replace_partition(rows, two, "a", "b")
    publish.replace_partition(rows.filter("v = 2").withColumn("v", F.lit(20)), two, "a", "b")
    assert sorted(tuple(r) for r in external_table(spark, two).select("v", "a", "b").collect()) == [(1, "x", 1), (3, "y", 1), (20, "x", 2)]


def test_empty_table_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.replace_partition(days(spark, []), path, "DT")
    assert external_table(spark, path).columns == ["v", "DT"] and held(spark, path) == []
    with pytest.raises(FileNotFoundError):
        commits.read(spark, str(tmp_path))
    with pytest.raises(ValueError, match="commit"):
        publish.replace_partition(days(spark, BASE).withColumn("Commit", F.lit(1)), path, "DT")


def test_watermark_is_read_from_the_folders(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish.replace_partition(days(spark, BASE), path, "DT")
    publish.merge_range(spark, days(spark, []), path, "2025-01-04", "2025-01-09")
    assert start_of_extract(spark, path) == date(2025, 1, 2)
    assert commits.partition_days(spark, path)[-1] == date(2025, 1, 3)


# swap of a whole table


def test_swap_survives_death_between_its_steps(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old, new, newer = spark.range(2), spark.range(3), spark.range(4)
    publish.full_refresh(old, path)
    with monkeypatch.context() as m:
        dying(m, "rename")  # before the old table makes room
        with pytest.raises(Died):
            publish.full_refresh(new, path)
    assert spark.read.parquet(path).count() == 2
    with monkeypatch.context() as m:
        dying(m, "rename", 1)  # between the two renames
        with pytest.raises(Died):
            publish.full_refresh(new, path)
    assert not storage.exists(spark, path)
    with pytest.raises(Exception, match="no"):  # the next run dies in its job, but has put things right before
        publish.full_refresh(newer.select(F.raise_error(F.lit("no")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    with monkeypatch.context() as m:
        publish._recovered(spark, path)
        dying(m, "delete")  # new in place, old one not yet gone
        with pytest.raises(Died):
            publish.full_refresh(newer, path)
    assert spark.read.parquet(path).count() == 4
    publish.full_refresh(old, path)
    assert spark.read.parquet(path).count() == 2
    assert storage.child_folders(spark, str(tmp_path)) == ["t"]


def test_half_written_table_does_not_take_the_place(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_csv_overwrite(spark.range(2), path)
    storage.make_folder(spark, f"{path}-next-dead")  # a job that died: no _SUCCESS
    storage.rename(spark, path, f"{path}-was-dead")
    publish._recovered(spark, path)
    assert spark.read.option("header", True).csv(path).count() == 2
    assert storage.child_folders(spark, str(tmp_path)) == ["t"]
