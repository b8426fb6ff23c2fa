"""The jobs: each reads the files of the one before, builds one plan and writes it.

Row counts are taken from the written files' footers, or from the narrowest columns that give them,
not from a second run of the plan.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkindex.operators import extracts, linking
from linkindex.operators.deriving import derive_index
from linkindex.operators.matching import assign_ids
from linkindex.operators.views import company_view, link_view, paye_view, vat_view
from linkindex.plans.layout import Layout
from linkindex.schemas import CH, LINKS, PAYE, TCN, VAT
from linkindex.sources import readers, writers
from linkindex.sources.files import remove
from linkindex.sources.staging import staged_until_done


def ingest(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """CSV of every admin source to Parquet; rows written per source."""
    rows = {}
    for src in (CH, VAT, PAYE, TCN):
        path = layout.working(src)
        writers.write_parquet(readers.read_admin_csv(spark, layout.admin_input(src), src), path)
        rows[src] = writers.rows_in(spark, path)
    return rows


def match_and_number(spark: SparkSession, layout: Layout, run_ts: str, **options) -> int:
    """New links to numbered links, and how many; ``options`` are those of ``assign_ids``."""
    read = readers.read_in_order if options.get("input_order") else readers.read_parquet
    new = read(spark, layout.new_links)
    prev = readers.read_prev_links(spark, layout.prev_links)
    with staged_until_done(spark):
        links = assign_ids(new, prev, **options)
        writers.write_links(links, layout.work_dir, layout.prev_dir, layout.files[LINKS], run_ts)
    return writers.rows_in(spark, layout.working(LINKS))


def index_from(
    links: DataFrame,
    company: DataFrame,
    vat: DataFrame,
    paye: DataFrame,
    lookup: DataFrame,
    strict: bool = False,
    dedupe_lookup: bool = False,
    dedupe_refs: bool = False,
    blank_keys: Collection[str] | None = None,
    last_year: int = 2045,
) -> DataFrame:
    """Numbered links and source tables to the index.

    ``blank_keys`` are the sources that have a record with a blank key; unless given, it is looked
    up, so that blank references leave the joins early where nothing has one. ``last_year`` ends the
    hundred years of two-digit years.
    """
    if blank_keys is None:
        blank_keys = linking.sources_with_blank_key(company, paye)
    return derive_index(
        linking.link_units(
            link_view(links, strict),
            company_view(company),
            vat_view(vat),
            paye_view(paye, lookup, dedupe_lookup, last_year),
            dedupe_refs,
            blank_keys,
        )
    )


def _sources(spark: SparkSession, layout: Layout) -> list[DataFrame]:
    return [
        readers.read_parquet(spark, layout.working(src)) for src in (LINKS, CH, VAT, PAYE, TCN)
    ]


def link_and_derive(spark: SparkSession, layout: Layout, **options) -> int:
    """Working files to the index file, and its rows; ``options`` are those of ``index_from``."""
    links, company, vat, paye, lookup = _sources(spark, layout)
    index = index_from(links, company, vat, paye, lookup, **options)
    writers.write_index(index, layout.index)
    return writers.rows_in(spark, layout.index)


def publish(
    spark: SparkSession,
    layout: Layout,
    run_ts: str,
    target: str | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Index to the published copy, the dated copy and the document store ``target``.

    Without a target the documents are left as bulk files beside the published copy.
    """
    index = readers.read_parquet(spark, layout.index)
    writers.write_parquet(index, layout.publish_dir)
    writers.write_snapshot(index, layout.history_path, run_ts)
    if target:
        writers.publish_documents(index, target, options=options)
    else:
        writers.write_bulk_documents(index, f"{layout.publish_dir}-bulk")
    return writers.rows_in(spark, layout.publish_dir)


def extract(spark: SparkSession, layout: Layout, single_file: bool = False) -> dict[str, int]:
    """Index to its four CSV extracts; rows written per extract."""
    index = readers.read_parquet(spark, layout.index)
    frames = {
        "legal-entities": extracts.legal_entities(index),
        "legal-entities-refs": extracts.legal_entities_with_refs(index),
        "vat": extracts.vat_refs(index),
        "paye": extracts.paye_refs(index),
    }
    return {
        name: _write_counted(df, layout.extract(name), single_file) for name, df in frames.items()
    }


def _write_counted(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Write an extract and return its rows, counted while they are written."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writers.write_csv_extract(counted, path, single_file)
    return seen.get["rows"]


def extract_from_links(
    spark: SparkSession,
    layout: Layout,
    strict: bool = False,
    dedupe_lookup: bool = False,
    dedupe_refs: bool = False,
    last_year: int = 2045,
) -> dict[str, int]:
    """The flat extracts straight from the working files, without the index; rows per extract.

    No array of references is built on the way, so a unit may have more of them than one row of
    the index can hold. The fourth extract has such arrays as its cells, so it cannot be made here:
    one of an earlier run is removed, as it would not belong to the new three.
    """
    links, company, vat, paye, lookup = _sources(spark, layout)
    view, vats = link_view(links, strict), vat_view(vat)
    payes = paye_view(paye, lookup, dedupe_lookup, last_year)
    blanks = linking.sources_with_blank_key(company, paye)
    units = linking.link_units(
        view, company_view(company), vats, payes, dedupe_refs, blank_keys=blanks
    )
    of_paye = linking.join_paye(view, payes, dedupe=dedupe_refs, blank_key=PAYE in blanks)
    frames = {
        "legal-entities": extracts.legal_entities(derive_index(units)),
        "vat": linking.linked_refs(linking.join_vat(view, vats, dedupe_refs), "ref", "VatRef"),
        "paye": linking.linked_refs(of_paye, "key", "PayeRef"),
    }
    remove(spark, layout.extract("legal-entities-refs"))
    return {name: _write_counted(df, layout.extract(name)) for name, df in frames.items()}
