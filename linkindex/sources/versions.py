"""Tables that are replaced without a moment in which they are lost.

A table at ``path`` is a folder ``path.versions`` with a folder for each write, and a small file
``path.current`` that names the complete one and its number of rows. A write makes a new version, counts
what it can read back, and only then changes the file's content; so a write that fails, wherever it does, leaves
the former version in force. The version before the one in force is kept for readers that still
have it open, older ones go. On stores without a rename nothing has to be renamed: the file
is replaced by one write, and read as JSON, so half of it would be an error and not another table.

What is missing is told from what never was: before the first version is written the file says that
there is none yet. Versions without a file that names one, or a version that has lost rows, are an error.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from linkindex.sources import files


class LostTable(RuntimeError):
    """A table that was written cannot be read any more."""


def versions_of(path: str) -> str:
    return f"{path}.versions"


def pointer_of(path: str) -> str:
    return f"{path}.current"


def _named(spark: SparkSession, path: str) -> dict | None:
    """What the pointer says; None if there is none."""
    if not files.exists(spark, pointer_of(path)):
        return None
    text = files.read_text(spark, pointer_of(path))
    try:
        found = json.loads(text)
        return {"version": found["version"], "rows": int(found["rows"])}
    except (ValueError, KeyError, TypeError) as e:
        raise LostTable(f"{pointer_of(path)} names no version: {text[:200]!r}") from e


def _point(spark: SparkSession, path: str, version: str | None, rows: int) -> None:
    files.write_text(spark, pointer_of(path), json.dumps({"version": version, "rows": rows}))


def announce(spark: SparkSession, path: str) -> None:
    """Say that a first version is on its way, unless there is one."""
    if _named(spark, path) is None:
        if files.children(spark, versions_of(path)):
            raise LostTable(f"{versions_of(path)} has versions, but {pointer_of(path)} is missing")
        _point(spark, path, None, 0)


def announced(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at ``path``, or a write of it has begun."""
    return _named(spark, path) is not None


def write_version(df: DataFrame, path: str) -> int:
    """Replace the table at ``path``, which ``df`` may have been read from; the rows written."""
    spark = df.sparkSession
    announce(spark, path)
    before = _named(spark, path)
    version = uuid.uuid4().hex
    folder = f"{versions_of(path)}/{version}"
    df.write.parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder).count()
    _point(spark, path, version, rows)
    kept = {version, before["version"]}
    for name in files.children(spark, versions_of(path)):
        if name not in kept:
            files.remove(spark, f"{versions_of(path)}/{name}")
    return rows


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The version in force; None if no version has ever been."""
    named = _named(spark, path)
    if named is None:
        if files.children(spark, versions_of(path)):
            raise LostTable(f"{versions_of(path)} has versions, but {pointer_of(path)} is missing")
        return None
    if named["version"] is None:
        return None
    folder = f"{versions_of(path)}/{named['version']}"
    try:
        df = spark.read.parquet(folder)
        rows = df.count()
    except AnalysisException as e:
        raise LostTable(f"{folder}, the version in force, cannot be read") from e
    if rows != named["rows"]:
        raise LostTable(f"{folder} has {rows} of {named['rows']} rows")
    return df
