"""Helpers that several operators share: staged tables, fresh column names, table paths."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkindex.sources.staging import new_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors reach, in the folder of the run that is open.

    Runs are those of ``sources.staging``: ``staged_until_done`` opens one, whose tables go when it ends,
    with all results that are read lazily from them; what is staged outside of one stays until
    ``clear_session``.
    """
    return new_path(spark, "llm")


def staged(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    """The column of exactly this name, also if it holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Rows and bytes of an Arrow batch, which a Python worker holds several times over: Spark's defaults
#: and what takes their place. A session's own values stay.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
           "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b")}

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's modules to the Python workers of this application, once, and make the
    session's Arrow batches small.

    The modules are only needed where the package is not installed on the executors; sending them is
    harmless where it is.
    """
    for key, (default, small) in BATCHES.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, small)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"  # the driver serves this file
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
