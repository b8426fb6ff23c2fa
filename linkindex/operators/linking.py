"""From links to units: explode, join to the sources, reduce per unit.

Each source is joined on its own key and the three results are reduced per unit behind one
shuffle. Everything kept per unit is a minimum, a maximum, a sum or a list of references, so it is
reduced on the map side first: a unit holding a large share of all rows reaches the last step as
one row per map task. VAT and PAYE records stay out of that shuffle: a unit finds the place of its first
record, and fetches that one by its key. The list of references is as long as the unit's index cell has to be;
``linked_refs`` gives the same references as rows for whoever does not need the cell.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkindex.functions import quarter_jobs, update_order
from linkindex.schemas import CH, PAYE, VAT
from linkindex.sources.readers import as_large


# What the index takes from a unit's first VAT or PAYE record.
RECORD = ["sic", "name", "style", "status", "deathcode", "postcode", "address"]


def edges(links: DataFrame, src: str) -> DataFrame:
    """``(UBRN, pos, key)`` of one source; ``links`` is a link view."""
    if src == CH:
        out = links.select("UBRN", F.lit(0).alias("pos"), F.col(CH).alias("key"))
    else:
        out = links.select("UBRN", F.posexplode(src).alias("pos", "key"))
    return out.where(F.col("key").isNotNull())


def explode_links(links: DataFrame) -> DataFrame:
    """All edges of a link view: ``(UBRN, src, pos, key)``."""
    tagged = [
        edges(links, src).select("UBRN", F.lit(src).alias("src"), "pos", "key")
        for src in (CH, VAT, PAYE)
    ]
    return reduce(DataFrame.unionByName, tagged)


def join_source(
    links: DataFrame, records: DataFrame, src: str, dedupe: bool = False, blank_key: bool = True
) -> DataFrame:
    """The edges of one source with the records they point to; other edges vanish.

    A key may be repeated on either side and every pair counts, unless ``dedupe`` keeps the first
    place of each unit and key and the first record of each key, before they meet. A key with very
    many edges makes a large join partition, which Spark splits while it runs (adaptive skew join).
    Blanks stand in for missing references in very many links. When no record has a ``blank_key``
    they match nothing, and are dropped before the shuffle.
    A file of few narrow columns looks small whatever its rows, so no side is broadcast by that.
    """
    one = edges(links, src)
    if not blank_key:
        one = one.where(F.col("key") != "")
    if dedupe:
        one = one.groupBy("UBRN", "key").agg(F.min("pos").alias("pos"))
        records = _one_per_key(records, [c for c in records.columns if c != "key"])
    return one.join(as_large(records), "key")


def _one_per_key(records: DataFrame, columns: list[str]) -> DataFrame:
    """The key and the lowest record of each, in the order of the columns."""
    return records.groupBy("key").agg(F.min(F.struct(*columns)).alias("r")).select("key", "r.*")


def join_company(links: DataFrame, company: DataFrame, **options: bool) -> DataFrame:
    return join_source(links, company, CH, **options)


def join_vat(links: DataFrame, vat: DataFrame, dedupe: bool = False) -> DataFrame:
    """VAT keys are numbers, so none is blank."""
    return join_source(links, vat, VAT, dedupe, blank_key=False)


def join_paye(links: DataFrame, paye: DataFrame, **options: bool) -> DataFrame:
    return join_source(links, paye, PAYE, **options)


def sources_with_blank_key(company: DataFrame, paye: DataFrame) -> list[str]:
    """Which of the two tables has a record with a blank key: a look for one row in each."""
    blanks = {
        CH: company.where(F.col("CompanyNumber") == ""), PAYE: paye.where(F.col("payeref") == "")
    }
    return [src for src, df in blanks.items() if not df.isEmpty()]


def linked_refs(joined: DataFrame, ref: str, name: str) -> DataFrame:
    """``(id, name)`` rows of joined edges: the long form of the index's reference arrays."""
    return joined.select(F.col("UBRN").alias("id"), F.col(ref).alias(name))


def union_sources(
    company: DataFrame, vat: DataFrame, paye: DataFrame, records: bool = True
) -> DataFrame:
    """Joined edges of the three sources in one frame, with what each adds to its unit.

    ``ch``, ``vat`` and ``paye`` hold the record under its place in the link (``pos``, its
    reference, then the record itself, so that their order is total and the first well defined).
    Without ``records``, ``vat`` and ``paye`` hold the place alone, for ``with_first_record``.
    """
    record = RECORD if records else []
    from_company = company.select(
        "UBRN",
        F.struct("pos", "key", "sic", "name", "status", "postcode", "address").alias("ch"),
    )
    from_vat = vat.select(
        "UBRN",
        F.struct("pos", "ref", *record).alias("vat"),
        "turnover",
        F.struct("pos", "ref").alias("vat_ref"),
    )
    month, year = F.col("updated_month"), F.col("updated_year")
    jobs = quarter_jobs(
        month,
        F.col("mar_jobs"),
        F.col("june_jobs"),
        F.col("sept_jobs"),
        F.col("dec_jobs"),
    )
    from_paye = paye.select(
        "UBRN",
        F.struct("pos", "key", *record).alias("paye"),
        F.struct(update_order(month, year).alias("updated"), "pos", jobs.alias("jobs")).alias(
            "jobs"
        ),
        F.struct("pos", F.col("key").alias("ref")).alias("paye_ref"),
    )
    return from_company.unionByName(from_vat, allowMissingColumns=True).unionByName(
        from_paye, allowMissingColumns=True
    )


def _in_order(ref: str):
    return F.transform(F.sort_array(F.collect_list(ref)), lambda r: r["ref"])


def assemble(united: DataFrame) -> DataFrame:
    """One row per unit: first record of each source, turnover, latest jobs, references.

    The first record is the one earliest in the link; its null fields stay null. The latest jobs
    are those of the last update, whatever their value; among equal updates the later place wins.
    """
    return united.groupBy("UBRN").agg(
        F.min("ch").alias("ch"),
        F.min("vat").alias("vat"),
        F.min("paye").alias("paye"),
        F.sum("turnover").alias("turnover"),
        F.max("jobs")["jobs"].alias("jobs"),
        _in_order("vat_ref").alias("VatRefs"),
        _in_order("paye_ref").alias("PayeRefs"),
    )


def with_first_record(
    units: DataFrame, records: DataFrame, src: str, dedupe: bool = False
) -> DataFrame:
    """Units with a place in column ``src`` to the same with the record at that place.

    Of several records of a key it is the lowest, which ``dedupe`` takes in the order of all columns, as
    ``join_source`` does. Records are sorted after their shuffle only, so whole files are never sorted.
    Units without a place get keys of their own, as null keys would all meet in one task.
    """
    place = ["pos", "ref" if src == "vat" else "key"]
    columns = [c for c in records.columns if c != "key"] if dedupe else RECORD
    first = _one_per_key(records.where(F.col("key").isNotNull()).repartition("key"), columns)
    first = first.select(F.col("key").alias("_key"), F.struct(*RECORD).alias("_record"))
    own = F.concat(F.lit(" "), F.col("UBRN").cast("string"))
    keyed = units.withColumn("_key", F.coalesce(F.col(src)[place[1]].cast("string"), own))
    fields = [F.col(src)[c].alias(c) for c in place] + [F.col("_record")[c].alias(c) for c in RECORD]
    found = F.when(F.col(src).isNotNull(), F.struct(*fields)).alias(src)
    return keyed.join(as_large(first), "_key", "left").select(
        *[found if c == src else F.col(c) for c in units.columns]
    )


def link_units(
    links: DataFrame,
    company: DataFrame,
    vat: DataFrame,
    paye: DataFrame,
    dedupe_refs: bool = False,
    blank_keys: Collection[str] = (CH, PAYE),
) -> DataFrame:
    """Link view and admin views to one row per unit that has at least one record.

    ``blank_keys`` are the sources that may have a record with a blank key.
    """
    united = union_sources(
        join_company(links, company, dedupe=dedupe_refs, blank_key=CH in blank_keys),
        join_vat(links, vat, dedupe=dedupe_refs),
        join_paye(links, paye, dedupe=dedupe_refs, blank_key=PAYE in blank_keys),
        records=False,
    )
    units = with_first_record(assemble(united), vat, "vat", dedupe_refs)
    return with_first_record(units, paye, "paye", dedupe_refs)
