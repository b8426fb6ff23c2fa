"""Tables written on the way, in the shared folder the session names for checkpoints.

The folder is ``spark.checkpoint.dir``; where that is unset, the session's warehouse, which all
executors reach too. Every run has a folder of its own there. ``staged_until_done`` opens a run and
removes its folder at the end; tables staged outside of one belong to the session's own run, which
stays until its owner clears it with ``clear_session``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from linkindex.sources.files import remove

_run: ContextVar[str | None] = ContextVar("run", default=None)
_session_runs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for staged tables: the same rule on every master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def _new_run(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/linkindex-{uuid.uuid4().hex}"


def _session_key(spark: SparkSession) -> str:
    return f"{spark.conf.get('spark.app.id')} {shared_dir(spark)}"


def run_dir(spark: SparkSession) -> str:
    """The folder of the run that is open here, or the session's own."""
    return _run.get() or _session_runs.setdefault(_session_key(spark), _new_run(spark))


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the run's folder that nothing has used yet."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back: the rows are fixed and the plan above starts from files."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_until_done(spark: SparkSession) -> Iterator[str]:
    """A run of its own, removed with all its tables once the block ends."""
    folder = _new_run(spark)
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        remove(spark, folder)


def clear_session(spark: SparkSession) -> None:
    """Remove what was staged outside of any run. Frames read from it can no longer be used."""
    folder = _session_runs.pop(_session_key(spark), None)
    if folder:
        remove(spark, folder)
