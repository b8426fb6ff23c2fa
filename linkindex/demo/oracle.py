"""The same results in plain SQL for DuckDB, written from the rules and not from the DataFrames."""

from __future__ import annotations

from linkindex.demo.adapters import with_views

_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_REC = "pos, key, sic NULLS FIRST, name NULLS FIRST"
_FULL_REC = (
    f"{_REC}, style NULLS FIRST, status NULLS FIRST, deathcode NULLS FIRST, postcode NULLS FIRST, "
    + ", ".join(f"line{i} NULLS FIRST" for i in range(1, 6))
)
_LINES = ", ".join(f"address{i} AS line{i}" for i in range(1, 6))
_NAME = "coalesce(name1, '') || ' ' || coalesce(name2, '') || ' ' || coalesce(name3, '') AS name"

# What each source contributes, and the edges of the links.
CTES = {
    "cv": """SELECT CompanyNumber AS key, CompanyName AS name, CompanyStatus AS status,
        SICCodeSicText_1 AS sic, RegAddressPostCode AS postcode,
        RegAddressAddressLine1 AS line1, RegAddressAddressLine2 AS line2,
        RegAddressPostTown AS line3, RegAddressCounty AS line4, RegAddressCountry AS line5
        FROM company WHERE CompanyNumber IS NOT NULL""",
    "vv": f"""SELECT CAST(vatref AS VARCHAR) AS key, vatref AS ref, {_NAME}, tradstyle1 AS style,
        status, sic92 AS sic, deathcode, turnover, postcode, {_LINES}
        FROM vat WHERE vatref IS NOT NULL""",
    "pl": """SELECT paye.*, SIC07 FROM paye LEFT JOIN tcn ON CAST(TCN AS INTEGER) = stc""",
    "pv": f"""SELECT payeref AS key, {_NAME}, tradstyle1 AS style, status, stc, SIC07 AS sic,
        deathcode, jobs_lastupd, mar_jobs, june_jobs, sept_jobs, dec_jobs, postcode, {_LINES}
        FROM pl WHERE payeref IS NOT NULL""",
    "pd": f"""SELECT *,
        CASE WHEN jobs_lastupd <> 'unknown'
             THEN CAST((strpos('{_MONTHS}', substr(jobs_lastupd, 1, 3)) + 2) // 3 AS INTEGER)
        END AS updated_month,
        CASE WHEN jobs_lastupd <> 'unknown'
             THEN CAST(substr(jobs_lastupd, 4, 2) AS INTEGER)
                  + CASE WHEN CAST(substr(jobs_lastupd, 4, 2) AS INTEGER) <= 45
                         THEN 2000 ELSE 1900 END END AS updated_year
        FROM pv""",
    "lv": """SELECT coalesce(UBRN, 1) AS UBRN, CH[1] AS CH, VAT, PAYE
        FROM links WHERE coalesce(UBRN, 1) >= 0""",
    "ce": "SELECT UBRN, 0 AS pos, CH AS key FROM lv WHERE CH IS NOT NULL",
    "ve": "SELECT UBRN, generate_subscripts(VAT, 1) - 1 AS pos, unnest(VAT) AS key FROM lv",
    "pe": "SELECT UBRN, generate_subscripts(PAYE, 1) - 1 AS pos, unnest(PAYE) AS key FROM lv",
    "cj": "SELECT UBRN, pos, cv.* FROM ce JOIN cv ON ce.key = cv.key",
    "vj": "SELECT UBRN, pos, vv.* FROM ve JOIN vv ON ve.key = vv.key",
    "pj": "SELECT UBRN, pos, pd.* FROM pe JOIN pd ON pe.key = pd.key",
    "c1": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY UBRN
        ORDER BY {_REC}) AS rn FROM cj) WHERE rn = 1""",
    "v1": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY UBRN
        ORDER BY {_FULL_REC.replace('key', 'ref')}) AS rn FROM vj) WHERE rn = 1""",
    "p1": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY UBRN
        ORDER BY {_FULL_REC}) AS rn FROM pj) WHERE rn = 1""",
    "vt": """SELECT UBRN, CAST(sum(turnover) AS BIGINT) AS turnover,
        string_agg(CAST(ref AS VARCHAR), ',' ORDER BY pos, ref) AS refs FROM vj GROUP BY UBRN""",
    "pt": """SELECT UBRN, string_agg(key, ',' ORDER BY pos, key) AS refs FROM pj GROUP BY UBRN""",
    "jb": """SELECT UBRN, CAST(trunc(jobs) AS INTEGER) AS employees FROM (
        SELECT *, row_number() OVER (PARTITION BY UBRN
            ORDER BY updated DESC, pos DESC, jobs DESC NULLS LAST) AS rn
        FROM (SELECT UBRN, pos,
                coalesce(2 * ((updated_year - 1970) * 12 + updated_month - 1), -1) AS updated,
                CASE updated_month WHEN 3 THEN mar_jobs WHEN 6 THEN june_jobs
                                   WHEN 9 THEN sept_jobs WHEN 12 THEN dec_jobs END AS jobs
              FROM pj)) WHERE rn = 1""",
    "u": "SELECT UBRN FROM cj UNION SELECT UBRN FROM vj UNION SELECT UBRN FROM pj",
}
_FIRSTS = "u LEFT JOIN c1 USING (UBRN) LEFT JOIN v1 USING (UBRN) LEFT JOIN p1 USING (UBRN)"

TURNOVER_BAND = """CASE WHEN turnover < 100 THEN 'A' WHEN turnover < 250 THEN 'B'
    WHEN turnover < 500 THEN 'C' WHEN turnover < 1000 THEN 'D' WHEN turnover < 2000 THEN 'E'
    WHEN turnover < 5000 THEN 'F' WHEN turnover < 10000 THEN 'G' WHEN turnover < 50000 THEN 'H'
    WHEN turnover IS NOT NULL THEN 'I' END"""
EMPLOYMENT_BAND = """CASE WHEN employees = 0 THEN 'A' WHEN employees = 1 THEN 'B'
    WHEN employees < 5 THEN 'C' WHEN employees < 10 THEN 'D' WHEN employees < 20 THEN 'E'
    WHEN employees < 25 THEN 'F' WHEN employees < 50 THEN 'G' WHEN employees < 75 THEN 'H'
    WHEN employees < 100 THEN 'I' WHEN employees < 150 THEN 'J' WHEN employees < 200 THEN 'K'
    WHEN employees < 250 THEN 'L' WHEN employees < 300 THEN 'M' WHEN employees < 500 THEN 'N'
    WHEN employees IS NOT NULL THEN 'O' END"""
_STATUS = "CASE {0} WHEN 'Active' THEN 'A' WHEN 'Closed' THEN 'C' WHEN 'Dormant' THEN 'D' " \
    "WHEN 'Insolvent' THEN 'I' END"
_DEATH = "CASE WHEN {0} IN ('0','2','4','6','7','8','E','M','S','T') THEN 'A' " \
    "WHEN {0} IN ('1','9') THEN 'C' WHEN {0} = '3' THEN 'I' WHEN {0} = '5' THEN 'D' END"
_SIC = "nullif(regexp_extract({0}, '^([0-9]+)', 1), '')"

NAME = "upper(coalesce(c1.name, v1.name, p1.name))"
STYLE = "coalesce(v1.style, p1.style)"
POSTCODE = "coalesce(c1.postcode, v1.postcode, p1.postcode)"
ADDRESS = ", ".join(
    f"CASE WHEN c1.postcode IS NOT NULL THEN c1.line{i} WHEN v1.postcode IS NOT NULL "
    f"THEN v1.line{i} WHEN p1.postcode IS NOT NULL THEN p1.line{i} END AS Address{i}"
    for i in range(1, 6)
)
INDUSTRY = f"coalesce({', '.join(_SIC.format(s + '.sic') for s in ('c1', 'v1', 'p1'))})"
LEGAL = """coalesce(CASE WHEN c1.key IS NOT NULL THEN '1' END, CAST(v1.status AS VARCHAR),
    CAST(p1.status AS VARCHAR), '1')"""
TRADING = (
    f"coalesce({_STATUS.format('c1.status')}, {_DEATH.format('v1.deathcode')}, "
    f"{_DEATH.format('p1.deathcode')})"
)
ENTITY = f"""UBRN AS id, {NAME} AS BusinessName, {STYLE} AS TradingStyle, {POSTCODE} AS PostCode,
    {ADDRESS}, {INDUSTRY} AS IndustryCode, {LEGAL} AS LegalStatus, {TRADING} AS TradingStatus,
    {TURNOVER_BAND.replace('turnover', 'vt.turnover')} AS Turnover,
    {EMPLOYMENT_BAND} AS EmploymentBands, c1.key AS CompanyNo"""
ALL = f"{_FIRSTS} LEFT JOIN vt USING (UBRN) LEFT JOIN pt USING (UBRN) LEFT JOIN jb USING (UBRN)"
BRACKETED = "'[' || coalesce({0}, '') || ']'"


def linked(body: str, **replaced: str) -> str:
    """``body`` over the views and the linking steps; steps may be replaced by name."""
    steps = {**CTES, **replaced}
    views = with_views("company", "vat", "paye", "tcn", "links")
    return views + ", " + ", ".join(f"{n} AS ({q})" for n, q in steps.items()) + "\n" + body


def firsts(columns: str) -> str:
    return linked(f"SELECT UBRN, {columns} FROM {_FIRSTS}")


# One record per unit and key, one SIC per code.
DEDUPED = {
    "pl": """SELECT paye.*, SIC07 FROM paye
        LEFT JOIN (SELECT TCN, min(SIC07) AS SIC07 FROM tcn GROUP BY TCN) t
            ON CAST(TCN AS INTEGER) = stc"""
}

BASE = 10**15


def text(alias: str = "") -> str:
    """The three arrays of a link as text."""
    p = f"{alias}." if alias else ""
    return ", ".join(f"array_to_string({p}{c}, ',') AS {c}" for c in ("CH", "VAT", "PAYE"))


def matching(body: str, *steps: str, new: str = "new_links") -> str:
    """``body`` over the links of both months: ``o`` and ``n`` (with a row key)."""
    return (
        with_views(new, "prev_links")
        + ", o AS (SELECT * FROM prev_links)"
        + f", n AS (SELECT *, row_number() OVER () AS GID FROM {new})"
        + "".join(f", {s}" for s in steps)
        + "\n"
        + body
    )


COMPANY_MATCH = """SELECT o.UBRN, n.GID, n.CH, n.VAT, n.PAYE FROM {o} o JOIN {n} n ON o.CH = n.CH
    WHERE o.CH[1] IS NOT NULL AND n.CH[1] IS NOT NULL"""
ID_MATCH = """SELECT n.UBRN, n.GID, n.CH, n.VAT, n.PAYE FROM {o} o JOIN {n} n ON o.UBRN = n.UBRN"""
CONTENT_MATCH = """SELECT o.UBRN, n.GID, n.CH, n.VAT, n.PAYE
    FROM {o} o JOIN {n} n ON o.VAT = n.VAT AND o.PAYE = n.PAYE
    WHERE o.CH[1] IS NULL AND n.CH[1] IS NULL"""


def reference_match(col: str, o: str = "o", n: str = "n") -> str:
    """Of the pairs that share a reference, those whose shared one is the lowest that either side
    shares with anything; once for every time that the two hold it."""
    return f"""SELECT UBRN, GID, n.CH, n.VAT, n.PAYE FROM (
        WITH shared AS (
            SELECT u.UBRN, g.GID, u.ref
            FROM (SELECT UBRN, unnest({col}) AS ref FROM {o}) u,
                 (SELECT GID, unnest({col}) AS ref FROM {n}) g
            WHERE u.ref = g.ref
        )
        SELECT shared.UBRN, shared.GID FROM shared
        JOIN (SELECT UBRN, min(ref) AS ref FROM shared GROUP BY UBRN) low_unit
            ON low_unit.UBRN = shared.UBRN AND low_unit.ref = shared.ref
        JOIN (SELECT GID, min(ref) AS ref FROM shared GROUP BY GID) low_link
            ON low_link.GID = shared.GID AND low_link.ref = shared.ref
    ) found JOIN {n} n USING (GID)"""


def numbered(need: str, base: str) -> str:
    """Numbers for the rows of ``need``: by the first four MD5 digits of their text, then by row."""
    t = " || '|' || ".join(
        f"coalesce('[' || array_to_string({c}, ',') || ']', '-')" for c in ("CH", "VAT", "PAYE")
    )
    return f"""SELECT {base} + row_number() OVER (ORDER BY substr(md5({t}), 1, 4),
        CH NULLS FIRST, VAT NULLS FIRST, PAYE NULLS FIRST) AS UBRN, CH, VAT, PAYE FROM {need}"""


def numbered_in_order(need: str, base: str) -> str:
    """Numbers for the rows of ``need`` in the order of their texts."""
    order = ", ".join(order_text(c) for c in ("CH", "VAT", "PAYE"))
    return f"SELECT {base} + row_number() OVER (ORDER BY {order}) AS UBRN, CH, VAT, PAYE FROM {need}"


def order_text(column: str) -> str:
    """A list as a text that orders alike everywhere."""
    return f"coalesce('[' || array_to_string({column}, ',') || ']', '-')"


MAX_UBRN = f"(SELECT coalesce(max(UBRN), {BASE}) FROM o)"


def lowest_only(found: str) -> str:
    """Of each new link the match with the lowest number."""
    return f"""SELECT min(UBRN) AS UBRN, GID, any_value(CH) AS CH, any_value(VAT) AS VAT,
        any_value(PAYE) AS PAYE FROM ({found}) GROUP BY GID"""


def key_assignment(
    match: str,
    new: str = "new_links",
    columns: str | None = None,
    one_to_one: bool = True,
    highest: str = MAX_UBRN,
    numbers=numbered,
) -> str:
    found = match.format(o="o", n="n")
    return matching(
        f"SELECT {columns or f'UBRN, {text()}'} FROM (SELECT UBRN, CH, VAT, PAYE FROM m "
        f"UNION ALL SELECT * FROM x)",
        f"m AS MATERIALIZED ({lowest_only(found) if one_to_one else found})",
        "rest AS (SELECT * FROM n WHERE GID NOT IN (SELECT GID FROM m))",
        f"x AS ({numbers('rest', highest)})",
        new=new,
    )


_FILLED = ", ".join(
    f"CASE WHEN len(list_filter({c}, lambda r: r <> '')) > 0 "
    f"THEN list_filter({c}, lambda r: r <> '') END AS {c}"
    for c in ("CH", "VAT", "PAYE")
)


def cascade(one_to_one: bool = False, blanks_match: bool = True) -> str:
    """All four rules in order, each on what is left."""
    steps = []
    rules = [
        lambda o, n: COMPANY_MATCH.format(o=o, n=n),
        lambda o, n: CONTENT_MATCH.format(o=o, n=n),
        lambda o, n: reference_match("VAT", o, n),
        lambda o, n: reference_match("PAYE", o, n),
    ]
    o, n = "o", "n"
    if not blanks_match:
        steps += [f"of AS MATERIALIZED (SELECT UBRN, {_FILLED} FROM o)",
                  f"nf AS MATERIALIZED (SELECT GID, {_FILLED} FROM n)"]
        o, n = "of", "nf"
    for i, rule in enumerate(rules):
        found = rule(o, n)
        if one_to_one:
            found = lowest_only(found)
        steps += [
            f"m{i} AS MATERIALIZED ({found})",
            f"o{i} AS MATERIALIZED (SELECT * FROM {o} WHERE UBRN NOT IN (SELECT UBRN FROM m{i}))",
            f"n{i} AS MATERIALIZED (SELECT * FROM {n} WHERE GID NOT IN (SELECT GID FROM m{i}))",
        ]
        o, n = f"o{i}", f"n{i}"
    every = " UNION ALL ".join(f"SELECT UBRN, GID FROM m{i}" for i in range(4))
    return matching(
        f"SELECT UBRN, {text()} FROM (SELECT m.UBRN, n.CH, n.VAT, n.PAYE FROM ({every}) m "
        f"JOIN n USING (GID) UNION ALL SELECT * FROM x)",
        *steps,
        f"y AS (SELECT CH, VAT, PAYE FROM n JOIN {n} USING (GID))" if n == "n"
        else f"y AS (SELECT n.CH, n.VAT, n.PAYE FROM n WHERE GID IN (SELECT GID FROM {n}))",
        f"x AS ({numbered('y', MAX_UBRN)})",
    )
