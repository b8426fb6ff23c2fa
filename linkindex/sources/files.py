"""Folders and small files wherever Spark's paths lead; Spark has no public calls for them, so Hadoop's
are taken."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _system(spark, path)
    return system.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none where there is no folder."""
    system, where = _system(spark, path)
    if not system.exists(where):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(where))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds."""
    system, where = _system(spark, path)
    system.delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; nothing may be at ``to``."""
    system, where = _system(spark, path)
    system.mkdirs(_system(spark, to)[1].getParent())
    if not system.rename(where, _system(spark, to)[1]):
        raise OSError(f"{path} could not be renamed to {to}")


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _system(spark, path)
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one go, over the one that is there."""
    system, where = _system(spark, path)
    stream = system.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
