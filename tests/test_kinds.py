"""Types by way of the book of kinds next to a look at all values."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quayside.operators import casting, kinds

VALUES = ["1", "2.0", "2.5", "true", "no", "x", None, "nan", "1e3", ""]


def write(spark, path, rows, schema="a string, b string, n int"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(path))


def scratch_types(spark, path):
    df = spark.read.option("mergeSchema", True).parquet(str(path))
    return casting.best_types(df.drop("d"))


def test_only_new_files_are_opened(spark, tmp_path):
    folder, book = str(tmp_path / "in"), str(tmp_path / "book")
    write(spark, f"{folder}/d=1", [("1", "true", 1), ("2", None, 2)])
    first = kinds.folder_types(spark, folder, book)
    assert first.types == {"a": "bigint", "b": "boolean"} and len(first.opened) == 1
    assert kinds.folder_types(spark, folder, book) == kinds.FolderTypes(first.types, [])
    write(spark, f"{folder}/d=2", [("2.5", "x", 1)])
    # the old file cannot be read any more: nobody tries
    old = first.opened[0].removeprefix("file:")
    look = os.stat(old)
    with open(old, "r+b") as f:
        f.write(b"\0" * look.st_size)
    os.utime(old, ns=(look.st_atime_ns, look.st_mtime_ns))
    second = kinds.folder_types(spark, folder, book)
    assert second.types == {"a": "double", "b": "string"}
    assert len(second.opened) == 1 and "/d=2/" in second.opened[0]


def test_rewritten_and_removed_files(spark, tmp_path):
    folder, book = str(tmp_path / "in"), str(tmp_path / "book")
    write(spark, f"{folder}/d=1", [("1", "1", 1)])
    write(spark, f"{folder}/d=2", [("x", "1.5", 1)])
    assert kinds.folder_types(spark, folder, book).types == {"a": "string", "b": "double"}
    write(spark, f"{folder}/d=2", [("7", "1.5", 1)])
    assert kinds.folder_types(spark, folder, book).types == {"a": "bigint", "b": "double"}
    for name in os.listdir(f"{folder}/d=2"):
        os.remove(f"{folder}/d=2/{name}")
    gone = kinds.folder_types(spark, folder, book)
    assert gone == kinds.FolderTypes({"a": "bigint", "b": "bigint"}, [])


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_from_scratch(spark, tmp_path, seed):
    rng = random.Random(seed)
    folder, book = str(tmp_path / "in"), str(tmp_path / "book")
    for d in range(4):
        some = rng.sample(VALUES, 3)
        rows = [(rng.choice(some), rng.choice(some), i) for i in range(rng.choice([0, 1, 30]))]
        write(spark, f"{folder}/d={d}", rows)
        found = kinds.folder_types(spark, folder, book, most_entries=2)
        have = scratch_types(spark, folder)
        assert {c: found.types.get(c, "string") for c in have} == have
        assert all(f"/d={d}/" in f for f in found.opened)
        assert len([n for n in os.listdir(book) if n.startswith("entry=")]) <= 2


def test_columns_that_only_some_files_have(spark, tmp_path):
    folder, book = str(tmp_path / "a b+c%"), str(tmp_path / "book")
    write(spark, f"{folder}/d=1", [("1", 1)], "a string, n int")
    write(spark, f"{folder}/d=x", [("2.5", "true")], "`z.z` string, b string")
    found = kinds.folder_types(spark, folder, book)
    assert found.types == {"a": "bigint", "z.z": "double", "b": "boolean"} and len(found.opened) == 2
    assert kinds.folder_types(spark, folder, book).opened == []
    typed = kinds.infer_folder(spark, folder, book)
    assert dict(typed.dtypes) == {"a": "bigint", "n": "int", "z.z": "double", "b": "boolean", "d": "string"}
    assert sorted((r.a, r.n, r["z.z"], r.b, r.d) for r in typed.where(F.col("a").isNotNull()).collect()) == [(1, 1, None, None, "1")]


def test_a_run_that_died_leaves_nothing(spark, tmp_path):
    folder, book = str(tmp_path / "in"), str(tmp_path / "book")
    write(spark, f"{folder}/d=1", [("1", "x", 1)])
    kinds.folder_types(spark, folder, book)
    write(spark, f"{folder}/d=2", [("y", "x", 1)])
    kinds.folder_types(spark, folder, book)
    os.remove(f"{book}/entry=00000002/_SUCCESS")
    again = kinds.folder_types(spark, folder, book)
    assert again.types == {"a": "string", "b": "string"} and len(again.opened) == 1 and "/d=2/" in again.opened[0]


def test_nothing_to_type(spark, tmp_path):
    folder, book = str(tmp_path / "in"), str(tmp_path / "book")
    write(spark, folder, [(1,), (2,)], "n int")
    assert kinds.folder_types(spark, folder, book).types == {}
    assert kinds.folder_types(spark, folder, book) == kinds.FolderTypes({}, [])
    assert kinds.infer_folder(spark, folder, book).dtypes == [("n", "int")]


def test_delimited_files(spark, tmp_path):
    folder, book = tmp_path / "in", str(tmp_path / "book")
    folder.mkdir()
    (folder / "one.csv").write_text("a,b\n1,x\n2,y\n")
    assert kinds.folder_types(spark, str(folder), book, "csv", header=True).types == {"a": "bigint", "b": "string"}
    (folder / "two.csv").write_text("a,b\n1.5,x\n")
    found = kinds.folder_types(spark, str(folder), book, "csv", header=True)
    assert found.types == {"a": "double", "b": "string"} and len(found.opened) == 1
