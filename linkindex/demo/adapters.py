"""Views that read the general tables as admin sources and links.

A customer is a company and a unit; every order is a VAT record, every order line a PAYE reference,
and part sizes and types are the industry code lookup. All customers of nation 24 together are one unit, which
so holds some four hundredths of all references. All views cover their whole tables. The SQL is written so
that Spark and DuckDB both run it. Companies are a plain projection and stay inline; the
other views group and join, so they are staged as the Parquet files the jobs expect.
"""

from __future__ import annotations

import re
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkindex.plans.jobs import index_from
from linkindex.schemas import ADMIN_SCHEMAS, CH, PAYE, TCN, VAT
from linkindex.sources.readers import as_large
from linkindex.sources.staging import stage

_COMPANY_KEY = """CASE WHEN c_mktsegment <> 'HOUSEHOLD'
                 THEN split(lpad(CAST(c_custkey AS STRING), 8, '0'), ',') END"""

_BLANKS_AND_REPEATS = """CASE WHEN c_acctbal < -600 AND v.refs IS NOT NULL
                 THEN split('', ',') || v.refs
                 WHEN c_acctbal > 9700 AND v.refs IS NOT NULL THEN v.refs || v.refs
                 ELSE v.refs END"""

VIEWS = {
    "company": """
        SELECT
            CASE WHEN c_acctbal >= -900 THEN lpad(CAST(c_custkey AS STRING), 8, '0') END
                AS CompanyNumber,
            CASE WHEN c_acctbal >= -700 THEN c_name END AS CompanyName,
            CASE c_mktsegment
                WHEN 'BUILDING' THEN 'Active'
                WHEN 'AUTOMOBILE' THEN 'Active - Proposal to Strike off'
                WHEN 'FURNITURE' THEN 'Dormant'
                WHEN 'HOUSEHOLD' THEN CASE WHEN c_nationkey < 12 THEN 'Closed' ELSE 'Insolvent' END
            END AS CompanyStatus,
            CASE WHEN c_nationkey < 5 THEN 'None Supplied'
                 WHEN c_nationkey >= 8
                 THEN CAST(10000 + c_nationkey * 100 AS STRING) || ' - Activity, '
                      || lower(c_mktsegment)
            END AS SICCodeSicText_1,
            CASE WHEN c_acctbal < 2000 OR c_acctbal > 4000
                 THEN 'PC' || CAST(c_nationkey AS STRING) || ' 1AA' END AS RegAddressPostCode,
            '1 ' || c_mktsegment || ' STREET' AS RegAddressAddressLine1,
            CASE WHEN c_nationkey < 10 THEN 'FLOOR ' || CAST(c_nationkey AS STRING) END
                AS RegAddressAddressLine2,
            'TOWN ' || CAST(c_nationkey AS STRING) AS RegAddressPostTown,
            CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'COUNTY' END AS RegAddressCounty,
            'COUNTRY ' || CAST(c_nationkey AS STRING) AS RegAddressCountry
        FROM customer""",
    "vat": """
        SELECT
            CAST(o_custkey AS STRING) AS entref,
            o_orderkey AS vatref,
            CASE o_orderstatus
                WHEN 'F' THEN substr('0123456789EMSTX', CAST(day(o_orderdate) AS INT), 1)
                WHEN 'O' THEN '0' END AS deathcode,
            CASE WHEN o_orderpriority <> '5-LOW'
                 THEN CAST(20000 + CAST(month(o_orderdate) AS INT) AS STRING) END AS sic92,
            CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                 THEN CAST(floor(o_totalprice / 100) AS BIGINT) END AS turnover,
            CAST(year(o_orderdate) AS STRING) || '-'
                || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS turnover_date,
            CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS status,
            CASE WHEN o_orderpriority <> '1-URGENT' THEN 'vat ' || o_orderpriority END AS name1,
            CASE WHEN o_orderstatus = 'P' THEN 'pending' END AS name2,
            'month ' || CAST(month(o_orderdate) AS STRING) AS name3,
            CASE WHEN o_orderstatus <> 'O' THEN 'style ' || o_orderpriority END AS tradstyle1,
            CAST(day(o_orderdate) AS STRING) || ' VAT ROAD' AS address1,
            CASE WHEN o_orderstatus = 'F' THEN 'VAT AREA' END AS address2,
            'VAT TOWN' AS address3,
            CAST(NULL AS STRING) AS address4,
            'VAT COUNTRY' AS address5,
            CASE WHEN o_orderstatus <> 'P' THEN 'V' || CAST(month(o_orderdate) AS STRING) || ' 2BB' END
                AS postcode
        FROM orders""",
    # The lines of an order with one number are one PAYE reference, with a record for each of their
    # return flags.
    "paye": """
        SELECT
            CAST(o_custkey AS STRING) AS entref,
            CAST(l_orderkey AS STRING) || '/' || CAST(line AS STRING) AS payeref,
            CASE state WHEN 'F' THEN substr('0123456789EMSTX', CAST(day(shipped) AS INT), 1)
            END AS deathcode,
            CAST(quarter(shipped) AS STRING) AS birthdate,
            CASE WHEN l_returnflag <> 'A' THEN quantity * 12 END AS dec_jobs,
            quantity - 1 AS mar_jobs,
            CASE WHEN l_returnflag <> 'R' THEN quantity * 1.5 END AS june_jobs,
            quantity * 3 AS sept_jobs,
            CASE WHEN tax < 0.03 THEN 'unknown'
                 WHEN tax < 0.08
                 THEN substr('JanFebMarAprMayJunJulAugSepOctNovDec',
                             CAST(month(shipped) AS INT) * 3 - 2, 3)
                      || substr(CAST(year(shipped) AS STRING), 3, 2)
            END AS jobs_lastupd,
            CASE l_returnflag WHEN 'A' THEN 3 WHEN 'N' THEN 4 END AS status,
            CAST(quantity AS INT) + 3 AS stc,
            CASE WHEN discount < 0.05 THEN 'paye ' || l_returnflag END AS name1,
            'line ' || CAST(line AS STRING) AS name2,
            CAST(NULL AS STRING) AS name3,
            CASE WHEN state = 'O' THEN 'style ' || l_returnflag END AS tradstyle1,
            CAST(line AS STRING) || ' PAYE LANE' AS address1,
            CAST(NULL AS STRING) AS address2,
            'PAYE TOWN' AS address3,
            CASE WHEN l_returnflag = 'N' THEN 'PAYE COUNTY' END AS address4,
            'PAYE COUNTRY' AS address5,
            CASE WHEN discount < 0.08 THEN 'P' || CAST(line AS STRING) || ' 3CC' END AS postcode
        FROM (
            SELECT o_custkey, l_orderkey, l_linenumber AS line, l_returnflag,
                max(l_linestatus) AS state, max(l_quantity) AS quantity, max(l_shipdate) AS shipped,
                max(l_tax) AS tax, max(l_discount) AS discount
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            GROUP BY o_custkey, l_orderkey, l_linenumber, l_returnflag) l""",
    # One SIC per code, two for the lowest five codes.
    "tcn": """
        SELECT DISTINCT
            lpad(CAST(p_size AS STRING), 4, '0') AS TCN,
            CASE WHEN p_size <= 5 AND p_type = 'PROMO' THEN '4' ELSE '3' END
                || lpad(CAST(p_size AS STRING), 4, '0') AS SIC07
        FROM part""",
    # Which unit a customer belongs to: that of its own number, or of the first customer of nation 24.
    "holders": """
        SELECT c_custkey AS ck, CAST(c_custkey AS STRING) AS holder,
            CASE WHEN c_nationkey = 24
                 THEN (SELECT min(c_custkey) FROM customer WHERE c_nationkey = 24)
                 ELSE c_custkey END AS head
        FROM customer""",
    # The references of each unit, whatever their number.
    "vat_refs": """
        SELECT head, array_sort(array_agg(CAST(vatref AS STRING))) AS refs
        FROM vat JOIN holders ON entref = holder GROUP BY head""",
    "paye_refs": """
        SELECT head, array_sort(array_agg(DISTINCT payeref)) AS refs
        FROM paye JOIN holders ON entref = holder GROUP BY head""",
    # Customers with a very low balance have a blank before their VAT references, those with a very
    # high one have all of them twice, and some without a company have a blank instead of PAYE references.
    "new_links": f"""
        SELECT {_COMPANY_KEY} AS CH, {_BLANKS_AND_REPEATS} AS VAT,
            CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 9600 THEN split('', ',')
                 ELSE p.refs END AS PAYE
        FROM customer
        JOIN holders ON c_custkey = ck AND ck = head
        LEFT JOIN vat_refs v ON c_custkey = v.head
        LEFT JOIN paye_refs p ON c_custkey = p.head""",
    # Last month, customers of nation 7 had other numbers and no references, VAT references of
    # nation 3 were not known, and the second half-years of customers with a low balance were units
    # of their own: in nation 5 under the same company, elsewhere under none.
    "prev_links": f"""
        SELECT
            1000000000000000 + c_custkey * 2 + unit AS UBRN,
            CASE WHEN unit = 1 AND c_nationkey = 7
                 THEN split('OLD' || CAST(c_custkey AS STRING), ',')
                 WHEN unit = 1 OR c_nationkey = 5 THEN {_COMPANY_KEY} END AS CH,
            CASE WHEN c_nationkey <> 3 AND c_nationkey <> 7 THEN {_BLANKS_AND_REPEATS} END AS VAT,
            CASE WHEN c_nationkey <> 7 THEN payes END AS PAYE
        FROM customer
        JOIN (SELECT coalesce(vc, pc) AS unit_head, coalesce(vu, pu) AS unit, vats AS refs, payes
              FROM (SELECT head AS vc, CASE WHEN c_acctbal < 3000
                            AND substr(turnover_date, 6, 2) > '06' THEN 2 ELSE 1 END AS vu,
                        array_sort(array_agg(CAST(vatref AS STRING))) AS vats
                    FROM vat JOIN holders ON entref = holder JOIN customer ON c_custkey = head
                    GROUP BY 1, 2) v
              FULL OUTER JOIN
                   (SELECT head AS pc, CASE WHEN c_acctbal < 3000
                            AND birthdate > '2' THEN 2 ELSE 1 END AS pu,
                        array_sort(array_agg(DISTINCT payeref)) AS payes
                    FROM paye JOIN holders ON entref = holder JOIN customer ON c_custkey = head
                    GROUP BY 1, 2) p ON vc = pc AND vu = pu) v
            ON c_custkey = unit_head""",
    # New links with the number a person gave them: some wrong, some missing.
    "edited_links": f"""
        SELECT
            CASE WHEN c_nationkey < 20 THEN 1000000000000000 + c_custkey * 2 + 1
                 WHEN c_nationkey < 22 THEN 0 END AS UBRN,
            {_COMPANY_KEY} AS CH, v.refs AS VAT, split('', ',') AS PAYE
        FROM customer
        JOIN holders ON c_custkey = ck AND ck = head
        LEFT JOIN vat_refs v ON c_custkey = v.head""",
    # Numbered links of the link job, a few of them marked bad by a negative number. A missing
    # company is a blank, as in the files the jobs get.
    "links": f"""
        SELECT
            CASE WHEN c_acctbal < -950 THEN -1 ELSE 1000000000000001 + c_custkey END AS UBRN,
            coalesce({_COMPANY_KEY}, split('', ',')) AS CH, {_BLANKS_AND_REPEATS} AS VAT,
            p.refs AS PAYE
        FROM customer
        JOIN holders ON c_custkey = ck AND ck = head
        LEFT JOIN vat_refs v ON c_custkey = v.head
        LEFT JOIN paye_refs p ON c_custkey = p.head""",
}

_BASE = ("customer", "orders", "lineitem", "part")
_STAGED = ("vat", "paye", "tcn", "new_links", "prev_links", "edited_links", "links")
_TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_ADMIN = {"company": CH, "vat": VAT, "paye": PAYE, "tcn": TCN}


class Tables:
    """The views over one folder of tables, staged ones written once per session."""

    _by_folder: ClassVar[dict[tuple[str, str], Tables]] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Tables:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._by_folder:
            cls._by_folder[key] = cls(spark, sf_dir)
        return cls._by_folder[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name == "index":
            return stage(self.index(), name)
        if name in _BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        df = self._sql(name)
        if name in _ADMIN:
            df = in_schema(df, _ADMIN[name])
        return self._staged(df, name) if name in _STAGED else df

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        """Stage a view with tasks of little shuffled data: references are short and nearly all different,
        so a task that groups them takes some thirty times what it reads."""
        before = self.spark.conf.get(_TASK_SIZE)
        self.spark.conf.set(_TASK_SIZE, "4m")
        try:
            return stage(df, name)
        finally:
            self.spark.conf.set(_TASK_SIZE, before)

    def _sql(self, name: str) -> DataFrame:
        frames = {needed: as_large(self[needed]) for needed in _needs(name)}
        text = VIEWS[name]
        for needed in frames:  # Spark takes frames as arguments in braces
            text = re.sub(rf"(FROM|JOIN) {needed}\b", rf"\1 {{{needed}}} {needed}", text)
            text = re.sub(rf"\{{{needed}\}} {needed} (?=[a-z]\b(?!\.))", f"{{{needed}}} ", text)
        return self.spark.sql(text, **frames)

    def index(self, **options) -> DataFrame:
        """The index of the numbered links, as a plan."""
        return index_from(
            self["links"], self["company"], self["vat"], self["paye"], self["tcn"], **options
        )


def _needs(name: str) -> list[str]:
    words = set(VIEWS[name].split())
    inner = ("vat", "paye", "holders", "vat_refs", "paye_refs")
    return [n for n in (*_BASE, *inner) if n in words and n != name]


def in_schema(df: DataFrame, src: str) -> DataFrame:
    """The frame with every column of its source file, in file order; missing ones are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ADMIN_SCHEMAS[src].fields
        ]
    )


def with_views(*names: str) -> str:
    """``WITH`` clause that defines the views for DuckDB, and those they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _needs(name):
            if needed in VIEWS:
                add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in order)
