"""Questions asked of the working files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """One pass: row count and filled cells per column, as ``(column, type, rows, filled)``."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("_rows").alias("rows"),
                F.col(f.name).alias("filled"),
            )
            for f in df.schema.fields
        ]
    )
    return counts.select(F.inline(per_column))


def header_leaks(company: DataFrame) -> DataFrame:
    """How many company records are a header line read as data."""
    return company.where(F.col("CompanyNumber") == "CompanyNumber").agg(
        F.count(F.lit(1)).alias("bad_recs")
    )


def refs_of_length(paye: DataFrame, length: int = 4, limit: int | None = None) -> DataFrame:
    """PAYE references of a suspicious length, with the first line of the name."""
    return _first(paye.where(F.length("payeref") == length).select("payeref", "name1"), limit)


def links_by_first_vat(links: DataFrame, ref: int | str, limit: int | None = None) -> DataFrame:
    """Links whose first VAT reference is ``ref``."""
    return _first(links.where(F.get("VAT", F.lit(0)) == F.lit(str(ref))), limit)


def vat_by_ref(vat: DataFrame, ref: int, limit: int | None = None) -> DataFrame:
    """VAT records with that reference."""
    return _first(vat.where(F.col("vatref") == F.lit(ref)), limit)


def units_by_name(index: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """Index records of that exact name, six columns."""
    found = index.where(F.col("BusinessName") == name)
    columns = ["PostCode", "IndustryCode", "LegalStatus", "EmploymentBands", "PayeRefs"]
    return _first(found.select("BusinessName", *columns), limit)


def _first(found: DataFrame, limit: int | None) -> DataFrame:
    """All rows, or the first few in the order of their columns."""
    return found if limit is None else found.orderBy(*found.columns).limit(limit)
