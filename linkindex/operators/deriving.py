"""The index record of an assembled unit, one expression per field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkindex.functions import (
    death_status,
    employment_band,
    sic_prefix,
    status_band,
    turnover_band,
    whole_number,
)
from linkindex.schemas import INDEX

_SOURCES = ("ch", "vat", "paye")  # in order of preference


def _of(source: str, field: str) -> Column:
    """A field of the unit's first record of that source."""
    return F.col(source)[field]


def _preferred(field: str, *sources: str) -> Column:
    return F.coalesce(*[_of(source, field) for source in sources])


def business_name() -> Column:
    return F.upper(_preferred("name", *_SOURCES))


def trading_style() -> Column:
    return _preferred("style", "vat", "paye")


def postcode() -> Column:
    return _preferred("postcode", *_SOURCES)


def address() -> Column:
    """All lines of the first source that has a postcode, null lines included."""
    return F.coalesce(
        *[F.when(_of(s, "postcode").isNotNull(), _of(s, "address")) for s in _SOURCES]
    )


def industry_code() -> Column:
    return F.coalesce(*[sic_prefix(_of(s, "sic")) for s in _SOURCES])


def legal_status() -> Column:
    return F.coalesce(
        F.when(F.col("ch").isNotNull(), F.lit("1")),
        _of("vat", "status").cast("string"),
        _of("paye", "status").cast("string"),
        F.lit("1"),
    )


def trading_status() -> Column:
    return F.coalesce(
        status_band(_of("ch", "status")),
        status_band(death_status(_of("vat", "deathcode"))),
        status_band(death_status(_of("paye", "deathcode"))),
    )


def employees() -> Column:
    return whole_number(F.col("jobs"))


def derive_index(units: DataFrame) -> DataFrame:
    """Assembled units to index records, columns in the order of the index file.

    The address and the employee count are projected first, being used several times each: this
    keeps the generated code of either step small enough for the JVM to compile.
    """
    picked = units.select(
        "UBRN",
        address().alias("address"),
        employees().alias("employees"),
        "turnover",
        business_name().alias("BusinessName"),
        trading_style().alias("TradingStyle"),
        postcode().alias("PostCode"),
        industry_code().alias("IndustryCode"),
        legal_status().alias("LegalStatus"),
        trading_status().alias("TradingStatus"),
        _of("ch", "key").alias("CompanyNo"),
        "VatRefs",
        "PayeRefs",
    )
    computed = {
        "id": F.col("UBRN"),
        "UPRN": F.col("UBRN"),
        **{f"Address{i}": F.col("address")[f"line{i}"] for i in range(1, 6)},
        "Turnover": turnover_band(F.col("turnover")),
        "EmploymentBands": employment_band(F.col("employees")),
    }
    return picked.select(*[computed.get(name, F.col(name)).alias(name) for name in INDEX.names])
