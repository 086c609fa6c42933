"""Small files and folders of any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, by name; nothing where it does not exist."""
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, at = _at(spark, path)
    return fs.getContentSummary(at).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder another name, which must be free."""
    fs, at = _at(spark, path)
    if fs.exists(_at(spark, to)[1]) or not fs.rename(at, _at(spark, to)[1]):
        raise OSError(f"{path} could not be moved to {to}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it appears complete or not at all; an older one must not exist."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/_draft-{name}"
    fs, at = _at(spark, draft)
    stream = fs.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move(spark, draft, path)
