"""Random small registers against a direct reading of the rules in plain Python."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from frames import B, bag, company, links, paye, raw_links, tcn, vat

from linkindex.operators import matching
from linkindex.plans.jobs import index_from

STATUS = {"Active": "A", "Closed": "C", "Dormant": "D", "Insolvent": "I"}
DEATH = {c: "A" for c in "024678EMST"} | {c: "C" for c in "19"} | {"3": "I", "5": "D"}
MONTHS = ["Jan", "Mar", "Jun", "Sep", "Dec"]
NUMBER = [1, 3, 6, 9, 12]


def maybe(rnd, values):
    return rnd.choice([None, *values])


def register(seed):
    """Links and records with repeated, missing and blank keys."""
    rnd = random.Random(seed)
    companies = [
        {
            "CompanyNumber": maybe(rnd, ["c1", "c2", "c3", ""]), "CompanyName": maybe(rnd, ["n", ""]),
            "CompanyStatus": maybe(rnd, [*STATUS, "Other"]),
            "SICCodeSicText_1": maybe(rnd, ["12 x", "none", "77"]),
            "RegAddressPostCode": maybe(rnd, ["pc"]), "RegAddressAddressLine1": maybe(rnd, ["a"]),
        }
        for _ in range(4)
    ]
    vats = [
        {
            "vatref": maybe(rnd, [1, 2, 3, 4]), "name1": maybe(rnd, ["v"]), "status": maybe(rnd, [1]),
            "turnover": maybe(rnd, [0, 99, 100, 6000]), "sic92": maybe(rnd, ["3x", "x3"]),
            "deathcode": maybe(rnd, list("0135EX")), "postcode": maybe(rnd, ["vp"]),
            "address1": maybe(rnd, ["va"]), "tradstyle1": maybe(rnd, ["vs"]),
        }
        for _ in range(6)
    ]
    payes = [
        {
            "payeref": maybe(rnd, ["p1", "p2", "p3", ""]), "name2": maybe(rnd, ["p"]),
            "status": maybe(rnd, [4]), "stc": maybe(rnd, [100, 200]),
            "deathcode": maybe(rnd, list("29Z")), "postcode": maybe(rnd, ["pp"]),
            "tradstyle1": maybe(rnd, ["ps"]),
            "jobs_lastupd": maybe(rnd, [m + y for m in MONTHS for y in ("99", "05")] + ["bad"]),
            **{j: maybe(rnd, [0.0, 1.0, 7.9]) for j in
               ("mar_jobs", "june_jobs", "sept_jobs", "dec_jobs")},
        }
        for _ in range(6)
    ]
    lookup = [("0100", "500"), ("100", "400"), ("0300", "9")]
    rows = [
        (
            maybe(rnd, [-1, 0, 1, 2, 3, 4]),
            maybe(rnd, [[], ["c1"], ["c2", "c1"], [""], [None]]),
            maybe(rnd, [[], ["1"], ["2", "1", "9"], ["", "3"], ["4", "4"], ["01"]]),
            maybe(rnd, [[], ["p1"], ["p2", "p1"], ["", "p3"], [None, "p3"]]),
        )
        for _ in range(8)
    ]
    return companies, vats, payes, lookup, rows


def low(value):
    """Nulls first."""
    return (value is not None, value if value is not None else 0)


def first(records, *order):
    return min(records, key=lambda r: [low(r[1].get(c)) if c else low(r[0]) for c in order],
               default=(None, {}))[1]


def name(record):
    return " ".join(record.get(f"name{i}") or "" for i in (1, 2, 3))


def digits(text):
    n = len(text or "") - len((text or "").lstrip("0123456789"))
    return text[:n] if n else None


def pick(*values):
    return next((v for v in values if v is not None), None)


def expected(companies, vats, payes, lookup, rows):
    units = defaultdict(lambda: {"c": [], "v": [], "p": []})
    for ubrn, ch, vat_refs, paye_refs in rows:
        ubrn = 1 if ubrn is None else ubrn
        if ubrn < 0:
            continue
        for c in companies:
            if ch and ch[0] is not None and c["CompanyNumber"] == ch[0]:
                units[ubrn]["c"].append((0, c))
        for pos, key in enumerate(vat_refs or []):
            units[ubrn]["v"] += [(pos, v) for v in vats if v["vatref"] is not None
                                 and str(v["vatref"]) == key]
        for pos, key in enumerate(paye_refs or []):
            for p in payes:
                if key is not None and p["payeref"] == key:
                    sics = [s for t, s in lookup if int(t) == p["stc"]] or [None]
                    units[ubrn]["p"] += [(pos, p | {"sic": s}) for s in sics]
    out = {}
    for ubrn, u in units.items():
        if not (u["c"] or u["v"] or u["p"]):
            continue
        vs = [(pos, v | {"name": name(v)}) for pos, v in u["v"]]
        ps = [(pos, p | {"name": name(p)}) for pos, p in u["p"]]
        c = first(u["c"], None, "CompanyNumber", "SICCodeSicText_1", "CompanyName",
                  "CompanyStatus", "RegAddressPostCode", "RegAddressAddressLine1")
        v = first(vs, None, "vatref", "sic92", "name", "tradstyle1", "status", "deathcode",
                  "postcode", "address1")
        p = first(ps, None, "payeref", "sic", "name", "tradstyle1", "status", "deathcode",
                  "postcode", "address1")
        turnovers = [r["turnover"] for _, r in vs if r["turnover"] is not None]
        total = sum(turnovers) if turnovers else None
        updates = []
        for pos, r in ps:
            text = r["jobs_lastupd"]
            when, jobs = -1, None
            if text and text != "bad":
                month = NUMBER[MONTHS.index(text[:3])]
                when = 2 * (((1999 if text[3:] == "99" else 2005) - 1970) * 12 + month - 1)
                column = {3: "mar_jobs", 6: "june_jobs", 9: "sept_jobs", 12: "dec_jobs"}.get(month)
                jobs = r[column] if column else None
            updates.append((when, pos, low(jobs), jobs))
        jobs = max(updates)[3] if updates else None
        out[ubrn] = (
            (lambda n: n and n.upper())(pick(c.get("CompanyName"), v.get("name"), p.get("name"))),
            pick(v.get("tradstyle1"), p.get("tradstyle1")),
            pick(c.get("RegAddressPostCode"), v.get("postcode"), p.get("postcode")),
            c.get("RegAddressAddressLine1") if c.get("RegAddressPostCode") is not None
            else v.get("address1") if v.get("postcode") is not None else p.get("address1"),
            pick(digits(c.get("SICCodeSicText_1")), digits(v.get("sic92")), digits(p.get("sic"))),
            "1" if c else str(pick(v.get("status"), p.get("status"), 1)),
            pick(STATUS.get(c.get("CompanyStatus")), DEATH.get(v.get("deathcode")),
                 DEATH.get(p.get("deathcode"))),
            None if total is None else next(
                (b for limit, b in ((100, "A"), (250, "B"), (500, "C"), (1000, "D"), (2000, "E"),
                                    (5000, "F"), (10000, "G"), (50000, "H")) if total < limit), "I"),
            None if jobs is None else {0: "A", 1: "B", 7: "D"}[int(jobs)],
            c.get("CompanyNumber"),
            [r["vatref"] for _, r in sorted(vs, key=lambda x: (x[0], x[1]["vatref"]))],
            [r["payeref"] for _, r in sorted(ps, key=lambda x: (x[0], x[1]["payeref"]))],
        )
    return out


@pytest.mark.parametrize("seed", range(12))
def test_index(spark, seed):
    companies, vats, payes, lookup, rows = register(seed)
    df = index_from(
        links(spark, *rows), company(spark, *companies), vat(spark, *vats), paye(spark, *payes),
        tcn(spark, *lookup),
    ).select(
        "id", "BusinessName", "TradingStyle", "PostCode", "Address1", "IndustryCode",
        "LegalStatus", "TradingStatus", "Turnover", "EmploymentBands", "CompanyNo", "VatRefs",
        "PayeRefs",
    )
    assert {r[0]: tuple(r)[1:] for r in df.collect()} == expected(
        companies, vats, payes, lookup, rows
    )


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("with_number", [False, True])
@pytest.mark.parametrize("one_to_one", [False, True])
def test_key_rule(spark, seed, with_number, one_to_one):
    """Every pair of the rule, or the lowest number of each link, and dense numbers for the links
    without one."""
    rnd = random.Random(seed)

    def arrays():
        return tuple(maybe(rnd, [[], ["a"], ["b"], ["a", "b"], [""], [None]]) for _ in range(3))

    prev = [(maybe(rnd, [B + 3, B + 5, B + 9]), *arrays()) for _ in range(6)]
    new = [(maybe(rnd, [B + 3, B + 4, B + 9, 0]), *arrays()) for _ in range(9)]

    def match(n, p):
        if with_number:
            return n[0] is not None and n[0] == p[0]
        return bool(n[1]) and n[1][0] is not None and n[1] == p[1]

    pairs = [[p[0] for p in prev if match(n, p)] for n in new]
    if one_to_one:
        pairs = [[min((i for i in found if i is not None), default=None)] * bool(found) for found in pairs]
    carried = [(i, *n[1:]) for n, found in zip(new, pairs, strict=True) for i in found]
    rest = [n[1:] for n in new if not any(match(n, p) for p in prev)]
    frame = links(spark, *new) if with_number else raw_links(spark, *[n[1:] for n in new])
    got = bag(matching.assign_ids(frame, links(spark, *prev), one_to_one=one_to_one))
    top = max([p[0] for p in prev if p[0] is not None], default=B)
    fresh = [r for r in got if r[0] is not None and r[0] > top]
    assert sorted(r[0] for r in fresh) == list(range(top + 1, top + 1 + len(rest)))
    assert sorted(map(repr, (r[1:] for r in fresh))) == sorted(map(repr, rest))
    kept = [r for r in got if r not in fresh]
    assert sorted(map(repr, kept)) == sorted(map(repr, carried))
