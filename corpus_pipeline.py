"""A corpus pipeline: toxic documents go, one document of each near-duplicate group stays, benchmark
leaks go, secrets are masked, and what is left is packed into sequences.

``STAGES`` lists the stages by name. Each takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all
but the last return the columns of ``docs``. ``run`` writes each stage's rows and reads them again as
the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkindex.llm import credentials, decontam, jaccard, packing, toxicity
from linkindex.llm.common import fresh, ship, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5."""
    ship(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group, or one without an id where none has one; one row
    of it, where rows repeat. Documents without words are linked with nothing and stay."""
    ship(spark)
    return jaccard.one_per_component(docs, null_ids=True)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return credentials.masked(docs)


#: A sequence's capacities, all of which bind: short documents fill it by their number, long ones by the cost of
#: their attention before they do by their tokens.
SEQUENCE = packing.Capacities(tokens=4096, documents=64, cost=4096 * 3072)
CHOICE = packing.Choice("norm", (1.0, 0.25, 0.25))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 1, SEQUENCE, CHOICE)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Learned trees and a tokeniser cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
