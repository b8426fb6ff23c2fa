"""The columns each source contributes, under common names.

Every admin view has the join ``key`` as text plus the record's attributes. A record's address is
one struct, so the rule that picks a source's address picks all its lines at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkindex.functions import month_of, name_lines, year_of

NULL_UBRN = 1


def _address(*lines: str) -> Column:
    return F.struct(*[F.col(c).alias(f"line{i}") for i, c in enumerate(lines, 1)]).alias("address")


def _numbered_address() -> Column:
    return _address("address1", "address2", "address3", "address4", "address5")


def company_view(company: DataFrame) -> DataFrame:
    """The used company columns, one row per record that has a number."""
    return company.where(F.col("CompanyNumber").isNotNull()).select(
        F.col("CompanyNumber").alias("key"),
        F.col("CompanyName").alias("name"),
        F.col("CompanyStatus").alias("status"),
        F.col("SICCodeSicText_1").alias("sic"),
        F.col("RegAddressPostCode").alias("postcode"),
        _address(
            "RegAddressAddressLine1",
            "RegAddressAddressLine2",
            "RegAddressPostTown",
            "RegAddressCounty",
            "RegAddressCountry",
        ),
    )


def vat_view(vat: DataFrame) -> DataFrame:
    """The used VAT columns, one row per record that has a reference."""
    vatref = F.col("vatref").try_cast("bigint")
    return vat.where(F.col("vatref").isNotNull()).select(
        vatref.cast("string").alias("key"),
        vatref.alias("ref"),
        name_lines(F.col("name1"), F.col("name2"), F.col("name3")).alias("name"),
        F.col("tradstyle1").alias("style"),
        F.col("status"),
        F.col("sic92").cast("string").alias("sic"),
        F.col("deathcode").cast("string").alias("deathcode"),
        F.col("turnover").try_cast("bigint").alias("turnover"),
        F.col("postcode"),
        _numbered_address(),
    )


def lookup_join(paye: DataFrame, lookup: DataFrame, dedupe_lookup: bool = False) -> DataFrame:
    """PAYE records with the SIC of their industry code; records without one are kept.

    The lookup's text code is compared as a number, so ``0100`` is 100. A code listed with several
    SICs repeats its records, unless ``dedupe_lookup`` keeps the lowest SIC of each code. No
    broadcast is forced: Spark broadcasts the lookup when its size allows and shuffles otherwise.
    """
    sic = lookup.select(
        F.col("TCN").try_cast("int").alias("tcn"), F.col("SIC07").cast("string").alias("SIC07")
    ).where(F.col("tcn").isNotNull())
    if dedupe_lookup:
        sic = sic.groupBy("tcn").agg(F.min("SIC07").alias("SIC07"))
    coded = paye.withColumn("stc", F.col("stc").try_cast("int"))
    # records without a code would all be shuffled to one place to find nothing: they get keys of
    # their own below all codes
    spread = F.lit(-(2**40)) - F.pmod(F.xxhash64("payeref"), F.lit(2**31))
    keyed = coded.withColumn("_code", F.coalesce(F.col("stc").cast("long"), spread))
    codes = sic.select(F.col("tcn").cast("long").alias("_code"), "SIC07")
    return keyed.join(codes, "_code", "left").select(*coded.columns, "SIC07")


def paye_view(
    paye: DataFrame, lookup: DataFrame, dedupe_lookup: bool = False, last_year: int = 2045
) -> DataFrame:
    """The used PAYE columns with their SIC, one row per record and matching lookup row.

    ``last_year`` ends the hundred years that two-digit years of the last update belong to.
    """
    updated = F.col("jobs_lastupd").cast("string")
    jobs = [
        F.col(c).try_cast("double").alias(c)
        for c in ("mar_jobs", "june_jobs", "sept_jobs", "dec_jobs")
    ]
    used = paye.where(F.col("payeref").isNotNull())
    return lookup_join(used, lookup, dedupe_lookup).select(
        F.col("payeref").cast("string").alias("key"),
        name_lines(F.col("name1"), F.col("name2"), F.col("name3")).alias("name"),
        F.col("tradstyle1").alias("style"),
        F.col("status"),
        F.col("stc"),
        F.col("SIC07").alias("sic"),
        F.col("deathcode"),
        month_of(updated).alias("updated_month"),
        year_of(updated, last_year).alias("updated_year"),
        *jobs,
        F.col("postcode"),
        _numbered_address(),
    )


def link_view(links: DataFrame, strict: bool = False) -> DataFrame:
    """Numbered links with ``CH`` as its first element.

    A link without a number counts as unit 1 (``strict`` drops it); negative numbers are dropped.
    """
    ubrn = F.col("UBRN") if strict else F.coalesce("UBRN", F.lit(NULL_UBRN).cast("bigint"))
    return links.select(
        ubrn.alias("UBRN"), F.get("CH", F.lit(0)).alias("CH"), "VAT", "PAYE"
    ).where(F.col("UBRN") >= 0)
