"""The flat extracts of the index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkindex.functions import stringify_array
from linkindex.schemas import LEGAL_ENTITY_COLUMNS


def legal_entities(index: DataFrame) -> DataFrame:
    """The index without its arrays."""
    return index.select(*LEGAL_ENTITY_COLUMNS)


def legal_entities_with_refs(index: DataFrame) -> DataFrame:
    """The index with its arrays as ``[a,b]`` text."""
    return index.select(
        *LEGAL_ENTITY_COLUMNS,
        stringify_array(F.col("VatRefs")).alias("VatRef"),
        stringify_array(F.col("PayeRefs")).alias("PayeRef"),
    )


def vat_refs(index: DataFrame) -> DataFrame:
    """``(id, VatRef)``; units without a reference give no row."""
    return index.select("id", F.explode("VatRefs").alias("VatRef"))


def paye_refs(index: DataFrame) -> DataFrame:
    """``(id, PayeRef)``; units without a reference give no row."""
    return index.select("id", F.explode("PayeRefs").alias("PayeRef"))
