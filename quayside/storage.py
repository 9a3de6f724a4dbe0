"""Folder operations through Hadoop's file system API, so any store Spark can write to works."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; one listing call, no data is read."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files right below ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p) if s.isFile())
    return sorted(n for n in names if not n.startswith(("_", ".")))


def nested_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders ``depth`` levels below ``path``, relative to it; one listing call for each folder above them."""
    found = [""]
    for _ in range(depth):
        found = [f"{above}/{name}" if above else name for above in found for name in child_folders(spark, f"{path}/{above}" if above else path) if "=" in name]
    return found


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_lines(spark: SparkSession, files: Sequence[str], count: int = 1, encoding: str = "UTF-8", workers: int = 16) -> dict[str, list[str]]:
    """The first ``count`` lines of each file that are not blank, unpacked where the name says so.

    A file is opened and closed again after its first block, from a few threads: no job runs and no file is read
    twice as a whole. It is a call for each file, as its listing is.
    """
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())

    def look(file: str) -> list[str]:
        fs, p = _fs(spark, file)
        codec, stream = codecs.getCodec(p), fs.open(p)
        try:
            plain = stream if codec is None else codec.createInputStream(stream)
            reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(plain, encoding))
            found: list[str] = []
            while len(found) < count and (line := reader.readLine()) is not None:
                line = line.removeprefix("\ufeff") if not found else line
                if line.strip():
                    found.append(line)
            return found
        finally:
            stream.close()

    return dict(zip(files, in_threads(look, files, workers)))


def in_threads(look: Callable, items: Sequence, workers: int = 16) -> list:
    """Small looks at many files or folders, a few at a time."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(look, items))


def files_read(df: DataFrame) -> list[str]:
    """Paths of the files a scan would open; its listing is what the driver plans with, no job runs."""
    return sorted(unquote(f) for f in df.inputFiles())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must not be there yet."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()


def partition_values(spark: SparkSession, path: str, column: str = "dt") -> list[str]:
    """Values of the first-level partition folders, from a listing; no file is opened."""
    prefix = f"{column.lower()}="
    return [n[len(prefix) :] for n in child_folders(spark, path) if n.lower().startswith(prefix)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not move {source} to {target}")
