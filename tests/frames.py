"""Small source tables for tests: named values, everything else null."""

from __future__ import annotations

from linkindex.schemas import ADMIN_SCHEMAS, CH, NUMBERED_LINKS, PAYE, RAW_LINKS, TCN, VAT

B = 10**15


def admin(spark, src, *records):
    schema = ADMIN_SCHEMAS[src]
    return spark.createDataFrame([[r.get(n) for n in schema.names] for r in records], schema)


def company(spark, *records):
    return admin(spark, CH, *records)


def vat(spark, *records):
    return admin(spark, VAT, *records)


def paye(spark, *records):
    return admin(spark, PAYE, *records)


def tcn(spark, *pairs):
    return spark.createDataFrame(list(pairs), ADMIN_SCHEMAS[TCN])


def links(spark, *rows):
    return spark.createDataFrame(list(rows), NUMBERED_LINKS)


def raw_links(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_LINKS)


def bag(df):
    """Rows as plain tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
