"""The queries: each runs one operator over the whole tables and has the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkindex.demo import oracle as O
from linkindex.demo.adapters import Tables, with_views
from linkindex.functions import employment_band, stringify_array, turnover_band
from linkindex.operators import deriving, extracts, linking, matching, quality, views
from linkindex.operators.numbering import allocate_dense_ids, max_ubrn
from linkindex.plans import jobs
from linkindex.plans.layout import Layout
from linkindex.schemas import ADMIN_SCHEMAS, CH, INDEX, LEGAL_ENTITY_COLUMNS, PAYE, TCN, VAT
from linkindex.sources import readers, staging, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables.of(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def _flat(view: DataFrame) -> DataFrame:
    """A view with its address as five columns."""
    return view.select(*[c for c in view.columns if c != "address"], "address.*")


def _joined(arrays: list[str]) -> list[Column]:
    return [F.array_join(c, ",").alias(c) for c in arrays]


def _texts(links: DataFrame) -> DataFrame:
    """Links with their references as texts."""
    return links.withColumns(dict(zip([CH, VAT, PAYE], _joined([CH, VAT, PAYE]), strict=True)))


def _as_text(links: DataFrame) -> DataFrame:
    return _texts(links).select("UBRN", CH, VAT, PAYE)




# Views of the sources ------------------------------------------------------------------------


@query("company_view", O.linked("SELECT * FROM cv"))
def _(t: Tables):
    return _flat(views.company_view(t["company"]))


@query("vat_view", O.linked("SELECT * FROM vv"))
def _(t: Tables):
    return _flat(views.vat_view(t["vat"]))


@query(
    "paye_view",
    O.linked("""SELECT key, name, style, status, stc, sic, deathcode, updated_month, updated_year,
        mar_jobs, june_jobs, sept_jobs, dec_jobs, postcode, line1, line2, line3, line4, line5
        FROM pd"""),
)
def _(t: Tables):
    return _flat(views.paye_view(t["paye"], t["tcn"]))


@query("paye_lookup_join", O.linked("SELECT payeref, stc, SIC07 FROM pl"))
def _(t: Tables):
    return views.lookup_join(t["paye"], t["tcn"]).select("payeref", "stc", "SIC07")


@query(
    "paye_lookup_join_deduped",
    O.linked("SELECT payeref, stc, SIC07 FROM pl", **O.DEDUPED),
)
def _(t: Tables):
    return views.lookup_join(t["paye"], t["tcn"], dedupe_lookup=True).select(
        "payeref", "stc", "SIC07"
    )


_LINK_VIEW = "SELECT {0} AS UBRN, CH[1] AS CH, array_to_string(VAT, ',') AS VAT, " \
    "array_to_string(PAYE, ',') AS PAYE FROM {1} WHERE {0} >= 0"


@query("link_view", with_views("links") + _LINK_VIEW.format("coalesce(UBRN, 1)", "links"))
def _(t: Tables):
    return views.link_view(t["links"]).select("UBRN", CH, *_joined([VAT, PAYE]))


@query(
    "link_view_without_number",
    with_views("edited_links") + _LINK_VIEW.format("coalesce(UBRN, 1)", "edited_links"),
)
def _(t: Tables):
    return views.link_view(t["edited_links"]).select("UBRN", CH, *_joined([VAT, PAYE]))


@query(
    "link_view_strict", with_views("edited_links") + _LINK_VIEW.format("UBRN", "edited_links")
)
def _(t: Tables):
    return views.link_view(t["edited_links"], strict=True).select("UBRN", CH, *_joined([VAT, PAYE]))


# Linking -------------------------------------------------------------------------------------


@query(
    "explode_links",
    O.linked("""SELECT UBRN, 'CH' AS src, pos, key FROM ce
        UNION ALL SELECT UBRN, 'VAT', pos, key FROM ve
        UNION ALL SELECT UBRN, 'PAYE', pos, key FROM pe"""),
)
def _(t: Tables):
    return linking.explode_links(views.link_view(t["links"])).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def _blank_keys(t: Tables) -> list[str]:
    """As the jobs do: blanks go before the shuffle where no record has one."""
    return linking.sources_with_blank_key(t["company"], t["paye"])


def _company(t: Tables) -> DataFrame:
    return linking.join_company(
        views.link_view(t["links"]), views.company_view(t["company"]), blank_key=CH in _blank_keys(t)
    )


def _vat(t: Tables) -> DataFrame:
    return linking.join_vat(views.link_view(t["links"]), views.vat_view(t["vat"]))


def _paye(t: Tables) -> DataFrame:
    return linking.join_paye(
        views.link_view(t["links"]), views.paye_view(t["paye"], t["tcn"]),
        blank_key=PAYE in _blank_keys(t),
    )


def _united(t: Tables) -> DataFrame:
    return linking.union_sources(_company(t), _vat(t), _paye(t))


def _units(t: Tables) -> DataFrame:
    return linking.link_units(
        views.link_view(t["links"]), views.company_view(t["company"]), views.vat_view(t["vat"]),
        views.paye_view(t["paye"], t["tcn"]), blank_keys=_blank_keys(t),
    )


@query("link_company", O.linked("SELECT UBRN, key, name, status, sic FROM cj"))
def _(t: Tables):
    return _company(t).select("UBRN", "key", "name", "status", "sic")


@query("link_vat", O.linked("SELECT UBRN, key, name, turnover, deathcode FROM vj"))
def _(t: Tables):
    return _vat(t).select("UBRN", "key", "name", "turnover", "deathcode")


@query("link_paye", O.linked("SELECT UBRN, key, name, sic, deathcode, sept_jobs FROM pj"))
def _(t: Tables):
    return _paye(t).select("UBRN", "key", "name", "sic", "deathcode", "sept_jobs")


@query(
    "source_union_counts",
    O.linked("""SELECT (SELECT count(*) FROM cj) AS companies, (SELECT count(*) FROM vj) AS vats,
        (SELECT count(*) FROM pj) AS payes"""),
)
def _(t: Tables):
    return _united(t).agg(
        *[
            F.count(one).alias(name)
            for one, name in (("ch", "companies"), ("vat", "vats"), ("paye", "payes"))
        ]
    )


@query(
    "total_turnover",
    O.linked(f"""SELECT UBRN, turnover, {O.TURNOVER_BAND} AS band
        FROM u LEFT JOIN vt USING (UBRN)"""),
)
def _(t: Tables):
    return _units(t).select(
        "UBRN", "turnover", turnover_band(F.col("turnover")).alias("band")
    )


@query(
    "latest_employees",
    O.linked(f"""SELECT UBRN, employees, {O.EMPLOYMENT_BAND} AS band
        FROM u LEFT JOIN jb USING (UBRN)"""),
)
def _(t: Tables):
    counted = _units(t).select("UBRN", deriving.employees().alias("employees"))
    return counted.withColumn("band", employment_band(F.col("employees")))


@query(
    "first_records",
    O.firsts("""c1.key AS company, v1.key AS vat, v1.deathcode AS vat_deathcode, p1.key AS paye,
        p1.sic AS paye_sic, p1.name AS paye_name"""),
)
def _(t: Tables):
    return _units(t).select(
        "UBRN",
        F.col("ch.key").alias("company"),
        F.col("vat.ref").cast("string").alias("vat"),
        F.col("vat.deathcode").alias("vat_deathcode"),
        F.col("paye.key").alias("paye"),
        F.col("paye.sic").alias("paye_sic"),
        F.col("paye.name").alias("paye_name"),
    )


@query(
    "refs_per_unit",
    O.linked(f"""SELECT UBRN, {O.BRACKETED.format('vt.refs')} AS vats,
        {O.BRACKETED.format('pt.refs')} AS payes
        FROM u LEFT JOIN vt USING (UBRN) LEFT JOIN pt USING (UBRN)"""),
)
def _(t: Tables):
    return _units(t).select(
        "UBRN",
        stringify_array(F.col("VatRefs")).alias("vats"),
        stringify_array(F.col("PayeRefs")).alias("payes"),
    )


@query("legal_entities_direct", O.linked(f"SELECT {O.ENTITY} FROM {O.ALL}"))
def _(t: Tables):
    """Straight from the links: Spark leaves the arrays out."""
    return extracts.legal_entities(t.index())


@query("vat_refs_long", O.linked("SELECT UBRN AS id, ref AS VatRef FROM vj"))
def _(t: Tables):
    return linking.linked_refs(_vat(t), "ref", "VatRef")


@query("paye_refs_long", O.linked("SELECT UBRN AS id, key AS PayeRef FROM pj"))
def _(t: Tables):
    return linking.linked_refs(_paye(t), "key", "PayeRef")


# Derived fields ------------------------------------------------------------------------------


@query("names_upper", O.firsts(f"{O.NAME} AS BusinessName"))
def _(t: Tables):
    return _units(t).select("UBRN", deriving.business_name().alias("BusinessName"))


@query("postcode_address", O.firsts(f"{O.POSTCODE} AS PostCode, {O.ADDRESS}"))
def _(t: Tables):
    picked = _units(t).select(
        "UBRN", deriving.postcode().alias("PostCode"), deriving.address().alias("a")
    )
    return picked.select(
        "UBRN", "PostCode", *[F.col(f"a.line{i}").alias(f"Address{i}") for i in range(1, 6)]
    )


@query("trading_style", O.firsts(f"{O.STYLE} AS TradingStyle"))
def _(t: Tables):
    return _units(t).select("UBRN", deriving.trading_style().alias("TradingStyle"))


@query("industry_code", O.firsts(f"{O.INDUSTRY} AS IndustryCode"))
def _(t: Tables):
    return _units(t).select("UBRN", deriving.industry_code().alias("IndustryCode"))


@query("legal_trading_status", O.firsts(f"{O.LEGAL} AS LegalStatus, {O.TRADING} AS TradingStatus"))
def _(t: Tables):
    return _units(t).select(
        "UBRN",
        deriving.legal_status().alias("LegalStatus"),
        deriving.trading_status().alias("TradingStatus"),
    )


# The index and its extracts ------------------------------------------------------------------

_REFS = f"{O.BRACKETED.format('vt.refs')} AS {{0}}, {O.BRACKETED.format('pt.refs')} AS {{1}}"
_INDEX = f"SELECT {O.ENTITY}, UBRN AS UPRN, {_REFS.format('VatRefs', 'PayeRefs')} FROM {O.ALL}"


def _index_text(index: DataFrame) -> DataFrame:
    return index.withColumns({c: stringify_array(F.col(c)) for c in ("VatRefs", "PayeRefs")})


@query("index_full", O.linked(_INDEX))
def _(t: Tables):
    return _index_text(t.index())


_ONE_RECORD = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY UBRN, key " \
    "ORDER BY {order}) AS rn FROM ({joined})) WHERE rn = 1"
# The kept record of a unit and key is the first by place and then by its columns in file order.
_PAYE_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in "pos name style status stc sic deathcode updated_month updated_year mar_jobs "
    "june_jobs sept_jobs dec_jobs postcode line1 line2 line3 line4 line5".split()
)


@query(
    "index_deduped",
    O.linked(
        _INDEX,
        **O.DEDUPED,
        ve=f"SELECT UBRN, min(pos) AS pos, key FROM ({O.CTES['ve']}) GROUP BY UBRN, key",
        pj=_ONE_RECORD.format(order=_PAYE_ORDER, joined=O.CTES["pj"]),
    ),
)
def _(t: Tables):
    return _index_text(t.index(dedupe_lookup=True, dedupe_refs=True))


@query("legal_entities", O.linked(f"SELECT {O.ENTITY} FROM {O.ALL}"))
def _(t: Tables):
    return extracts.legal_entities(t["index"])


@query(
    "legal_entities_refs",
    O.linked(f"SELECT {O.ENTITY}, {_REFS.format('VatRef', 'PayeRef')} FROM {O.ALL}"),
)
def _(t: Tables):
    return extracts.legal_entities_with_refs(t["index"])


@query("vat_refs", O.linked("SELECT UBRN AS id, ref AS VatRef FROM vj"))
def _(t: Tables):
    return extracts.vat_refs(t["index"])


@query("paye_refs", O.linked("SELECT UBRN AS id, key AS PayeRef FROM pj"))
def _(t: Tables):
    return extracts.paye_refs(t["index"])


# Matching and numbering ----------------------------------------------------------------------


def _match(rule: str) -> str:
    return O.matching(f"SELECT UBRN, {O.text()} FROM ({rule.format(o='o', n='n')})")


@query(
    "match_by_id",
    O.matching(
        f"SELECT UBRN, {O.text()} FROM ({O.ID_MATCH.format(o='o', n='n')})", new="edited_links"
    ),
)
def _(t: Tables):
    return _as_text(matching.rule_id(t["prev_links"], t["edited_links"]))


@query("match_by_company", _match(O.COMPANY_MATCH))
def _(t: Tables):
    return _as_text(matching.rule_company(t["prev_links"], t["new_links"]))


@query("match_by_content", _match(O.CONTENT_MATCH))
def _(t: Tables):
    return _as_text(matching.rule_content(t["prev_links"], t["new_links"]))


def _gid(t: Tables) -> DataFrame:
    return matching.with_gid(t["new_links"])


@query("match_by_vat", _match(O.reference_match("VAT")))
def _(t: Tables):
    found = matching.rule_reference(t["prev_links"], _gid(t), VAT, written=_texts)
    return found.select("UBRN", CH, VAT, PAYE)


@query("match_by_paye", _match(O.reference_match("PAYE")))
def _(t: Tables):
    found = matching.rule_reference(t["prev_links"], _gid(t), PAYE, written=_texts)
    return found.select("UBRN", CH, VAT, PAYE)


_LEFT = f"m AS ({O.COMPANY_MATCH.format(o='o', n='n')})"


def _left(t: Tables) -> matching.Matches:
    new = _gid(t)
    return matching.exclude_matched(
        t["prev_links"], new, matching.rule_company(t["prev_links"], new)
    )


@query(
    "unmatched_new",
    O.matching(
        f"""SELECT {O.text()} FROM n WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.GID = n.GID)""",
        _LEFT,
    ),
)
def _(t: Tables):
    return _left(t).unmatched_new.select(*_joined([CH, VAT, PAYE]))


@query(
    "unmatched_old",
    O.matching(
        f"""SELECT UBRN, {O.text()} FROM o
            WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.UBRN = o.UBRN)""",
        _LEFT,
    ),
)
def _(t: Tables):
    return _as_text(_left(t).unmatched_old)


@query("max_id", O.matching(f"SELECT {O.MAX_UBRN} AS max_ubrn"))
def _(t: Tables):
    return max_ubrn(t["prev_links"])


@query("assign_ids_key", O.key_assignment(O.COMPANY_MATCH, one_to_one=False))
def _(t: Tables):
    return _as_text(matching.assign_ids(t["new_links"], t["prev_links"], one_to_one=False))


@query("assign_ids_default", O.key_assignment(O.COMPANY_MATCH))
def _(t: Tables):
    return _as_text(matching.assign_ids(t["new_links"], t["prev_links"]))


@query("assign_ids_high_water", O.key_assignment(O.COMPANY_MATCH, highest="2000000000000000"))
def _(t: Tables):
    return _as_text(matching.assign_ids(t["new_links"], t["prev_links"], high_water=2 * 10**15))


@query("assign_ids_blank_matches_nothing", O.cascade(one_to_one=True, blanks_match=False))
def _(t: Tables):
    return _as_text(
        matching.assign_ids(
            t["new_links"], t["prev_links"], rules=matching.ALL_RULES, blanks_match=False
        )
    )


@query("assign_ids_edited", O.key_assignment(O.ID_MATCH, "edited_links", one_to_one=False))
def _(t: Tables):
    return _as_text(
        matching.assign_ids(t["edited_links"], t["prev_links"], one_to_one=False)
    )


@query("assign_ids_full", O.cascade())
def _(t: Tables):
    return matching.assign_ids(
        t["new_links"], t["prev_links"], rules=matching.ALL_RULES, one_to_one=False, written=_texts
    )


@query("assign_ids_one_to_one", O.cascade(one_to_one=True))
def _(t: Tables):
    return _as_text(
        matching.assign_ids(
            t["new_links"], t["prev_links"], rules=matching.ALL_RULES, one_to_one=True
        )
    )


@query(
    "assign_ids_first_month",
    O.matching(f"SELECT UBRN, {O.text()} FROM x", f"x AS ({O.numbered('n', str(O.BASE))})"),
)
def _(t: Tables):
    """No previous links at all: the path does not exist."""
    missing = readers.read_prev_links(t.spark, staging.new_path(t.spark, "missing"))
    return _as_text(matching.assign_ids(t["new_links"], missing))


@query(
    "assign_ids_input_order", O.key_assignment(O.COMPANY_MATCH, numbers=O.numbered_in_order)
)
def _(t: Tables):
    """Links written in the order of their texts, and numbered in the order of the files."""
    path = staging.new_path(t.spark, "new-links")
    order = [F.coalesce(F.concat(F.lit("["), F.array_join(c, ","), F.lit("]")), F.lit("-"))
             for c in (CH, VAT, PAYE)]
    t["new_links"].sort(*order).write.parquet(path)
    new = readers.read_in_order(t.spark, path)
    return _as_text(matching.assign_ids(new, t["prev_links"], input_order=True))


@query(
    "dense_ids",
    """SELECT l_returnflag, l_linestatus,
            1000 + row_number() OVER (
                ORDER BY substr(md5(l_returnflag || '|' || l_linestatus), 1, 4),
                    l_returnflag, l_linestatus) AS UBRN
        FROM lineitem""",
)
def _(t: Tables):
    """Few distinct rows, each very often: the runs of numbers are written by many tasks."""
    rows = t["lineitem"].select("l_returnflag", "l_linestatus")
    return allocate_dense_ids(rows, F.lit(1000).cast("bigint"))


# Files ---------------------------------------------------------------------------------------


def _admin_csv(t: Tables, name: str, src: str) -> str:
    """The view written as the source's CSV file."""
    path = staging.new_path(t.spark, f"{name}-csv")
    t[name].write.option("header", "true").option("escape", '"').csv(path)
    return path


def _given(name: str, columns: str) -> str:
    return f"{with_views(name)} SELECT {columns} FROM {name}"


@query(
    "csv_scan_vat",
    _given("vat", "vatref, turnover, status, name1, name2, name3, sic92, postcode, address1"),
)
def _(t: Tables):
    return readers.read_admin_csv(t.spark, _admin_csv(t, "vat", VAT), VAT).select(
        "vatref", "turnover", "status", "name1", "name2", "name3", "sic92", "postcode", "address1"
    )


@query(
    "csv_scan_company",
    _given("company", "CompanyNumber, CompanyName, SICCodeSicText_1, RegAddressCounty"),
)
def _(t: Tables):
    return readers.read_admin_csv(t.spark, _admin_csv(t, "company", CH) + "/*.csv", CH).select(
        "CompanyNumber", "CompanyName", "SICCodeSicText_1", "RegAddressCounty"
    )


@query("csv_scan_lookup", _given("tcn", "TCN, SIC07"))
def _(t: Tables):
    return readers.read_lookup_csv(t.spark, _admin_csv(t, "tcn", TCN))


def _counts(rows: str) -> str:
    return " UNION ALL ".join(f"SELECT '{src}' AS src, {rows.format(v=v)} FROM {v}"
                              for src, v in ((CH, "company"), (VAT, "vat"), (PAYE, "paye"), (TCN, "tcn")))


@query(
    "ingest_all_sources",
    with_views("company", "vat", "paye", "tcn") + _counts("count(*) AS written, count(*) AS in_file"),
)
def _(t: Tables):
    """The ingest job over a layout with folders and file names of its own: what it says that it wrote, and
    what the working files hold."""
    home = staging.new_path(t.spark, "layout")
    layout = Layout(home, external="in", work="out",
                    inputs={CH: "ch/part-*.csv", VAT: "v/part-*.csv", PAYE: "p/*.csv", TCN: "t"},
                    files={CH: "c.parquet", VAT: "v.parquet", PAYE: "p.parquet", TCN: "t.parquet"})
    for folder, name in (("ch", "company"), ("v", "vat"), ("p", "paye"), ("t", "tcn")):
        t[name].write.option("header", "true").option("escape", '"').csv(f"{home}/in/{folder}")
    written = jobs.ingest(t.spark, layout)
    held = [readers.read_parquet(t.spark, layout.working(src)).agg(
        F.count(F.lit(1)).alias("in_file")).select(F.lit(src).alias("src"), F.lit(n).cast("long").alias("written"), "in_file")
        for src, n in written.items()]
    return reduce(DataFrame.unionAll, held)


@query(
    "ingest_roundtrip",
    _given(
        "paye",
        "payeref, nullif(deathcode, '') AS deathcode, dec_jobs, june_jobs, jobs_lastupd, status, "
        "stc, name1",
    ),
)
def _(t: Tables):
    """CSV to Parquet and back; empty cells come back as null."""
    path = staging.new_path(t.spark, "paye-parquet")
    source = readers.read_admin_csv(t.spark, _admin_csv(t, "paye", PAYE), PAYE)
    writers.write_parquet(source, path)
    return readers.read_parquet(t.spark, path).select(
        "payeref", "deathcode", "dec_jobs", "june_jobs", "jobs_lastupd", "status", "stc", "name1"
    )


@query("links_json_scan", f"{with_views('new_links')} SELECT {O.text()} FROM new_links")
def _(t: Tables):
    path = staging.new_path(t.spark, "links-json")
    t["new_links"].write.json(path)
    return readers.read_links_json(t.spark, path).select(*_joined([CH, VAT, PAYE]))


@query("prev_links_missing", f"{with_views('prev_links')} SELECT UBRN, {O.text()} FROM prev_links")
def _(t: Tables):
    """A missing path reads as no rows, an existing one as its rows."""
    missing = readers.read_prev_links(t.spark, staging.new_path(t.spark, "missing"))
    return _as_text(missing.unionByName(t["prev_links"]))


def _written_links(t: Tables) -> tuple[str, str]:
    home = staging.new_path(t.spark, "home")
    writers.write_links(t["links"], f"{home}/work", f"{home}/prev", "links", "202401311200")
    return home, "202401311200"


@query(
    "write_links_roundtrip",
    f"""{with_views('links')}, l AS (SELECT UBRN, {O.text()} FROM links)
        SELECT 'working' AS copy, * FROM l UNION ALL SELECT 'previous', * FROM l
        UNION ALL SELECT 'dated', * FROM l""",
)
def _(t: Tables):
    home, run_ts = _written_links(t)
    places = {"working": "work", "previous": "prev", "dated": f"prev/{run_ts}"}
    copies = [
        _as_text(readers.read_prev_links(t.spark, f"{home}/{place}/links")).select(
            F.lit(name).alias("copy"), "*"
        )
        for name, place in places.items()
    ]
    return copies[0].unionByName(copies[1]).unionByName(copies[2])


@query("snapshot_roundtrip", f"{with_views('links')} SELECT UBRN, {O.text()} FROM links")
def _(t: Tables):
    path = staging.new_path(t.spark, "snapshot")
    writers.write_snapshot(t["links"], path, "202401311200")
    return _as_text(readers.read_parquet(t.spark, f"{path}_202401311200"))


@query("index_write", O.linked(_INDEX))
def _(t: Tables):
    path = Layout(staging.new_path(t.spark, "home")).index
    writers.write_index(t["index"], path)
    return _index_text(readers.read_parquet(t.spark, path)).select(*INDEX.names)


def _blank(column: str) -> str:
    """CSV cells lose their outer blanks, and an empty one reads as null."""
    return f"nullif(trim(CAST({column} AS VARCHAR)), '') AS {column}"


def _extracted(t: Tables, name: str, frame: DataFrame) -> DataFrame:
    """The frame written as the extract of that name, and its cells read back."""
    path = Layout(staging.new_path(t.spark, "home")).extract(name)
    writers.write_csv_extract(frame, path)
    schema = ", ".join(f"{c} string" for c in frame.columns)
    return t.spark.read.option("header", "true").schema(schema).csv(path)


@query(
    "csv_extract",
    O.linked(f"""SELECT {', '.join(_blank(c) for c in LEGAL_ENTITY_COLUMNS)}, VatRef, PayeRef
        FROM (SELECT {O.ENTITY}, {_REFS.format('VatRef', 'PayeRef')} FROM {O.ALL})"""),
)
def _(t: Tables):
    return _extracted(t, "legal-entities-refs", extracts.legal_entities_with_refs(t["index"]))


@query(
    "csv_extract_flat",
    O.linked(f"""SELECT {', '.join(_blank(c) for c in LEGAL_ENTITY_COLUMNS)}
        FROM (SELECT {O.ENTITY} FROM {O.ALL})"""),
)
def _(t: Tables):
    return _extracted(t, "legal-entities", extracts.legal_entities(t["index"]))


@query(
    "csv_extract_vat",
    O.linked("SELECT CAST(UBRN AS VARCHAR) AS id, CAST(ref AS VARCHAR) AS VatRef FROM vj"),
)
def _(t: Tables):
    return _extracted(t, "vat", extracts.vat_refs(t["index"]))


@query(
    "csv_extract_paye",
    O.linked(f"""SELECT id, {_blank('PayeRef')}
        FROM (SELECT CAST(UBRN AS VARCHAR) AS id, key AS PayeRef FROM pj)"""),
)
def _(t: Tables):
    return _extracted(t, "paye", extracts.paye_refs(t["index"]))


@query(
    "bulk_documents",
    O.linked(f"""SELECT CAST(id AS VARCHAR) AS _id, id, BusinessName, Turnover,
            coalesce(array_length(string_split(nullif(vrefs, ''), ',')), 0) AS vats
        FROM (SELECT {O.ENTITY}, vt.refs AS vrefs FROM {O.ALL})"""),
)
def _(t: Tables):
    """The bulk lines, read back as the action's id and some of the document."""
    lines = F.split("value", "\n")
    parsed = writers.bulk_documents(t["index"]).select(
        F.from_json(lines[0], "index struct<_id string>").alias("a"),
        F.from_json(lines[1], INDEX).alias("d"),
    )
    return parsed.select(
        "a.index._id", "d.id", "d.BusinessName", "d.Turnover",
        F.size("d.VatRefs").cast("bigint").alias("vats"),
    )


@query(
    "bulk_files",
    O.linked(f"SELECT CAST(id AS VARCHAR) AS _id, id, BusinessName, Turnover "
             f"FROM (SELECT {O.ENTITY} FROM {O.ALL})"),
)
def _(t: Tables):
    """The written files: every action has its document, every document its action."""
    path = staging.new_path(t.spark, "bulk")
    writers.write_bulk_documents(t["index"], path)
    lines = t.spark.read.text(path).select(
        F.from_json("value", "index struct<_id string>")["index"]["_id"].alias("_id"),
        F.from_json("value", INDEX).alias("d"),
    )
    actions = lines.where(F.col("_id").isNotNull()).select("_id")
    documents = lines.where(F.col("_id").isNull()).select("d.id", "d.BusinessName", "d.Turnover")
    return actions.join(documents, F.col("_id") == F.col("id").cast("string"), "full")


# Questions asked of the files ------------------------------------------------------------------


def _profile_sql(name: str, src: str) -> str:
    schema = ADMIN_SCHEMAS[src]
    known = {
        CH: "CompanyNumber CompanyName CompanyStatus SICCodeSicText_1 RegAddressPostCode "
        "RegAddressAddressLine1 RegAddressAddressLine2 RegAddressPostTown RegAddressCounty "
        "RegAddressCountry",
    }[src].split()
    parts = [
        f"SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type, "
        f"count(*) AS rows, {f'count({f.name})' if f.name in known else '0'} AS filled FROM {name}"
        for f in schema.fields
    ]
    return with_views(name) + " UNION ALL ".join(parts)


@query("profile", _profile_sql("company", CH))
def _(t: Tables):
    return quality.profile(t["company"])


@query(
    "header_leaks",
    f"""{with_views('company')} SELECT count(*) AS bad_recs FROM company
        WHERE CompanyNumber = 'CompanyNumber'""",
)
def _(t: Tables):
    return quality.header_leaks(t["company"])


@query(
    "odd_refs", f"{with_views('paye')} SELECT payeref, name1 FROM paye WHERE length(payeref) = 7"
)
def _(t: Tables):
    return quality.refs_of_length(t["paye"], 7)


@query(
    "first_ref_lookup",
    f"{with_views('links')} SELECT UBRN, {O.text()} FROM links WHERE VAT[1] = '110505'",
)
def _(t: Tables):
    return _as_text(quality.links_by_first_vat(t["links"], 110505))


@query(
    "odd_refs_first",
    f"""{with_views('paye')} SELECT payeref, name1 FROM paye WHERE length(payeref) = 7
        ORDER BY payeref NULLS FIRST, name1 NULLS FIRST LIMIT 10""",
)
def _(t: Tables):
    return quality.refs_of_length(t["paye"], 7, limit=10)


@query(
    "vat_lookup",
    f"{with_views('vat')} SELECT vatref, name3, turnover FROM vat WHERE vatref = 110505",
)
def _(t: Tables):
    return quality.vat_by_ref(t["vat"], 110505).select("vatref", "name3", "turnover")


@query(
    "unit_lookup",
    O.linked(f"""SELECT BusinessName, PostCode, IndustryCode, LegalStatus, EmploymentBands,
        {O.BRACKETED.format('prefs')} AS PayeRefs
        FROM (SELECT {O.ENTITY}, pt.refs AS prefs FROM {O.ALL})
        WHERE BusinessName = 'CUSTOMER#000000011'"""),
)
def _(t: Tables):
    found = quality.units_by_name(t["index"], "CUSTOMER#000000011")
    return found.withColumn("PayeRefs", stringify_array(F.col("PayeRefs")))


@query(
    "registered_views",
    f"""{with_views('links', 'vat')} SELECT status, count(*) AS records,
            CAST(sum(turnover) AS BIGINT) AS turnover
        FROM (SELECT unnest(VAT) AS ref FROM links) l JOIN vat ON CAST(vatref AS VARCHAR) = l.ref
        GROUP BY status""",
)
def _(t: Tables):
    """SQL over the views a user registers."""
    readers.register_views(linkindex_links=t["links"], linkindex_vat=t["vat"])
    return t.spark.sql("""
        SELECT status, count(*) AS records, sum(turnover) AS turnover
        FROM (SELECT explode(VAT) AS ref FROM linkindex_links) l
        JOIN linkindex_vat ON CAST(vatref AS STRING) = l.ref GROUP BY status""")
