"""Reading the pipeline's files."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from linkindex.schemas import ADMIN_SCHEMAS, MATCHED_LINKS, NUMBERED_LINKS, RAW_LINKS, TCN
from linkindex.sources import files
from linkindex.sources.versions import LostTable, announced, read_version


def read_admin_csv(spark: SparkSession, path: str | list[str], src: str) -> DataFrame:
    """CSV files of one source, columns taken by position, the header line skipped.

    ``path`` may be a glob. Quotes are doubled inside quoted text; a cell that does not fit its
    type is null, and so is an empty one, quoted or not.
    """
    return (
        spark.read.option("header", "true")
        .option("enforceSchema", "true")
        .option("quote", '"')
        .option("escape", '"')
        .schema(ADMIN_SCHEMAS[src])
        .csv(path)
    )


def read_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """The industry code lookup."""
    return read_admin_csv(spark, path, TCN)


def read_links_json(spark: SparkSession, path: str, with_number: bool = False) -> DataFrame:
    """Raw links as JSON: an object per line, or an array of objects on one line."""
    return spark.read.schema(NUMBERED_LINKS if with_number else RAW_LINKS).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def empty_links(spark: SparkSession) -> DataFrame:
    return empty(spark, NUMBERED_LINKS)


def empty_matches(spark: SparkSession) -> DataFrame:
    return empty(spark, MATCHED_LINKS)


def read_prev_links(spark: SparkSession, path: str) -> DataFrame:
    """Last month's links, as ``write_prev_links`` left them or as a plain folder of Parquet files; no
    rows when there are none because nothing was ever written. Any other error is raised, also where
    the links are gone but versions or dated copies of them show that there were some."""
    found = read_version(spark, path)
    if found is not None:
        return found
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    folder, file = path.rsplit("/", 1)
    dated = [name for name in files.children(spark, folder)
             if re.fullmatch("[0-9]{12}", name) and files.exists(spark, f"{folder}/{name}/{file}")]
    if dated and not announced(spark, path):
        raise LostTable(f"{path} is missing, but there are copies of {', '.join(dated)}")
    return empty_links(spark)


def as_large(df: DataFrame) -> DataFrame:
    """The frame, not to be broadcast in the join it takes part in.

    Spark expects of a file's columns their share of its compressed size. A few columns of a wide table
    with many rows so look small enough for the driver, which would hold them all as a hash table.
    """
    return df.hint("merge")


def register_views(**tables: DataFrame) -> None:
    """Make frames available to SQL under the given names; of any size, so joins shuffle them."""
    for name, df in tables.items():
        as_large(df).createOrReplaceTempView(name)


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with ``_file``, its path, and ``_row``, the place in that file, of each row."""
    rows = spark.read.parquet(path)
    return rows.select("*", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.row_index").alias("_row"))
