"""Writing the pipeline's files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkindex.schemas import INDEX
from linkindex.sources import files
from linkindex.sources.readers import read_parquet
from linkindex.sources.versions import announce, write_version

DOCUMENT_STORE = "org.elasticsearch.spark.sql"


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the Parquet files at ``path``."""
    df.write.mode("overwrite").parquet(path)


def rows_in(spark: SparkSession, path: str) -> int:
    """Number of rows of Parquet files, from their footers."""
    return read_parquet(spark, path).count()


def write_index(index: DataFrame, path: str) -> None:
    """Replace the index file, its columns in file order."""
    write_parquet(index.select(*INDEX.names), path)


def write_prev_links(
    links: DataFrame, prev_dir: str, file: str, run_ts: str | None = None
) -> None:
    """Links for next month, or with ``run_ts`` (``yyyyMMddHHmm``) a copy that stays.

    Next month's links are a new version of the table, so the former ones are in force until all of the
    new ones are there. The copy is a plain folder, written aside and then renamed.
    """
    if run_ts:
        replace_parquet(links, f"{prev_dir}/{run_ts}/{file}")
    else:
        write_version(links, f"{prev_dir}/{file}")


def replace_parquet(df: DataFrame, path: str) -> None:
    """Replace the Parquet files at ``path`` by rows that are complete beside it before the old ones go."""
    spark, aside = df.sparkSession, f"{path}.new-{uuid.uuid4().hex}"
    df.write.parquet(aside)
    files.remove(spark, path)
    files.move(spark, aside, path)


def write_links(links: DataFrame, work_dir: str, prev_dir: str, file: str, run_ts: str) -> None:
    """Write the working copy, then make the dated copy and next month's from it.

    ``links`` may have been read from next month's copy. That one is replaced last, and only when all
    rows of the new one can be read: whatever fails before, last month's links are still there.
    """
    path = f"{work_dir}/{file}"
    if not files.exists(links.sparkSession, f"{prev_dir}/{file}"):
        announce(links.sparkSession, f"{prev_dir}/{file}")
    write_parquet(links, path)
    written = read_parquet(links.sparkSession, path)
    write_prev_links(written, prev_dir, file, run_ts)
    write_prev_links(written, prev_dir, file)


def write_snapshot(df: DataFrame, path: str, run_ts: str) -> None:
    """A dated copy next to ``path``."""
    write_parquet(df, f"{path}_{run_ts}")


def write_csv_extract(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header, every cell quoted, null as the empty text.

    The parts are written in parallel. ``single_file`` puts everything through one task, for
    extracts known to be small.
    """
    parts = df.coalesce(1) if single_file else df
    (
        parts.write.mode("overwrite")
        .option("header", "true")
        .option("quoteAll", "true")
        .option("nullValue", "")
        .csv(path)
    )


def bulk_documents(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Index-or-replace actions for a document store, one ``value`` of two lines per row."""
    action = F.to_json(F.struct(F.struct(F.col(id_col).cast("string").alias("_id")).alias("index")))
    document = F.to_json(F.struct(*df.columns))
    return df.select(F.concat_ws("\n", action, document).alias("value"))


def write_bulk_documents(df: DataFrame, path: str, id_col: str = "id") -> None:
    """Bulk files for a document store, written in parallel."""
    bulk_documents(df, id_col).write.mode("overwrite").text(path)


def publish_documents(
    df: DataFrame, target: str, id_col: str = "id", options: dict[str, str] | None = None
) -> None:
    """Insert or replace the rows as documents, through the store's Spark connector.

    The connector must be on the session's class path; nodes, port, user and password go into
    ``options`` or the session's settings.
    """
    (
        df.write.format(DOCUMENT_STORE)
        .option("es.mapping.id", id_col)
        .options(**(options or {}))
        .mode("append")
        .save(target)
    )
