"""Exploding, joining, assembling and deriving, case by case."""

from __future__ import annotations

import pytest
from frames import B, bag, company, links, paye, tcn, vat
from pyspark.errors import AnalysisException

from linkindex.operators import extracts, linking, views
from linkindex.plans.jobs import index_from
from linkindex.schemas import INDEX, LEGAL_ENTITY_COLUMNS

FULL_COMPANY = {
    "CompanyNumber": "CH1", "CompanyName": "Company One", "CompanyStatus": "Active",
    "SICCodeSicText_1": "12345 - things", "RegAddressPostCode": "AB1 2CD",
    "RegAddressAddressLine1": "c1", "RegAddressAddressLine2": "c2", "RegAddressPostTown": "c3",
    "RegAddressCounty": "c4", "RegAddressCountry": "c5",
}
FULL_VAT = {
    "vatref": 10, "name1": "vat", "name2": "one", "name3": "name", "tradstyle1": "vat style",
    "postcode": "VV1", "sic92": "54321", "status": 2, "turnover": 12345, "deathcode": "3",
    "address1": "v1", "address2": "v2", "address3": "v3", "address4": "v4", "address5": "v5",
}
FULL_PAYE = {
    "payeref": "P1", "name1": "paye", "name2": "one", "name3": "name", "tradstyle1": "paye style",
    "postcode": "PP1", "status": 3, "stc": 100, "deathcode": "0", "jobs_lastupd": "Jun16",
    "mar_jobs": 30.0, "june_jobs": 60.0, "sept_jobs": 90.0, "dec_jobs": 120.0,
    "address1": "p1", "address2": "p2", "address3": "p3", "address4": "p4", "address5": "p5",
}
ALL = (["CH1"], ["10"], ["P1"])


def index(spark, arrays=ALL, ch=FULL_COMPANY, vats=(FULL_VAT,), payes=(FULL_PAYE,), **options):
    """Index rows of unit 100 as dictionaries."""
    df = index_from(
        links(spark, (100, *arrays)),
        company(spark, *([ch] if ch else [])),
        vat(spark, *vats),
        paye(spark, *payes),
        tcn(spark, ("0100", "77777")),
        **options,
    )
    return [r.asDict() for r in df.collect()]


def one(spark, **changes):
    rows = index(spark, **changes)
    assert len(rows) == 1
    return rows[0]


def without(record, *names, **values):
    return {k: v for k, v in record.items() if k not in names} | values


@pytest.mark.parametrize(
    ("link", "expected"),
    [
        ((1, ["c"], ["v1", "v2"], ["p"]),
         [("CH", 0, "c"), ("PAYE", 0, "p"), ("VAT", 0, "v1"), ("VAT", 1, "v2")]),
        ((1, None, None, None), []),
        ((1, [], [], []), []),
        ((1, None, ["v"], None), [("VAT", 0, "v")]),
        ((1, ["c", "d"], None, None), [("CH", 0, "c")]),
        ((1, [""], [""], ["p", "p"]),
         [("CH", 0, ""), ("PAYE", 0, "p"), ("PAYE", 1, "p"), ("VAT", 0, "")]),
    ],
)
def test_explode(spark, link, expected):
    got = linking.explode_links(views.link_view(links(spark, link)))
    assert bag(got.select("src", "pos", "key")) == expected


def test_link_view_numbers(spark):
    rows = links(
        spark, (None, ["a"], None, None), (-1, ["b"], None, None), (0, ["c"], None, None)
    )
    assert bag(views.link_view(rows).select("UBRN", "CH")) == [(0, "c"), (1, "a")]
    assert bag(views.link_view(rows, strict=True).select("UBRN", "CH")) == [(0, "c")]


def test_full_record(spark):
    """Company first for name, postcode, address, code and status; turnover and jobs summed up."""
    latest = without(FULL_PAYE, payeref="P2", jobs_lastupd="Mar17", mar_jobs=3.7)
    second = without(FULL_VAT, vatref=20, turnover=12345)
    row = one(
        spark,
        arrays=(["CH1"], ["10", "20"], ["P1", "P2"]),
        vats=(FULL_VAT, second),
        payes=(FULL_PAYE, latest),
    )
    assert row == {
        "id": 100, "BusinessName": "COMPANY ONE", "TradingStyle": "vat style", "UPRN": 100,
        "PostCode": "AB1 2CD", "Address1": "c1", "Address2": "c2", "Address3": "c3",
        "Address4": "c4", "Address5": "c5", "IndustryCode": "12345", "LegalStatus": "1",
        "TradingStatus": "A", "Turnover": "H", "EmploymentBands": "C", "CompanyNo": "CH1",
        "VatRefs": [10, 20], "PayeRefs": ["P1", "P2"],
    }
    assert list(row) == INDEX.names


def test_company_only(spark):
    row = one(spark, vats=(), payes=())
    assert (row["CompanyNo"], row["LegalStatus"], row["VatRefs"], row["PayeRefs"]) == (
        "CH1", "1", [], [],
    )
    assert row["TradingStyle"] is row["Turnover"] is row["EmploymentBands"] is None


def test_vat_then_paye_take_over(spark):
    row = one(spark, ch=None)
    assert row["BusinessName"] == "VAT ONE NAME"
    assert (row["PostCode"], row["Address1"], row["IndustryCode"]) == ("VV1", "v1", "54321")
    assert (row["LegalStatus"], row["TradingStatus"], row["CompanyNo"]) == ("2", "I", None)
    row = one(spark, ch=None, vats=())
    assert row["BusinessName"] == "PAYE ONE NAME"
    assert (row["PostCode"], row["Address5"], row["IndustryCode"]) == ("PP1", "p5", "77777")
    assert (row["LegalStatus"], row["TradingStatus"]) == ("3", "A")
    assert (row["TradingStyle"], row["EmploymentBands"]) == ("paye style", "H")


def test_null_falls_through_and_blank_does_not(spark):
    assert one(spark, ch=without(FULL_COMPANY, "CompanyName"))["BusinessName"] == "VAT ONE NAME"
    assert one(spark, ch=without(FULL_COMPANY, CompanyName=""))["BusinessName"] == ""
    blank = one(spark, ch=without(FULL_COMPANY, RegAddressPostCode=""))
    assert (blank["PostCode"], blank["Address1"]) == ("", "c1")
    # a VAT record without any name still has a name, of blanks
    unnamed = without(FULL_VAT, "name1", "name2", "name3")
    assert one(spark, ch=None, vats=(unnamed,))["BusinessName"] == "  "


def test_address_comes_from_one_source(spark):
    row = one(spark, ch=without(FULL_COMPANY, "RegAddressCounty"))
    assert (row["Address3"], row["Address4"], row["Address5"]) == ("c3", None, "c5")
    row = one(spark, ch=without(FULL_COMPANY, "RegAddressPostCode"))
    assert [row[f"Address{i}"] for i in range(1, 6)] == ["v1", "v2", "v3", "v4", "v5"]
    row = one(
        spark,
        ch=without(FULL_COMPANY, "RegAddressPostCode"),
        vats=(without(FULL_VAT, "postcode"),),
        payes=(without(FULL_PAYE, "postcode"),),
    )
    assert row["PostCode"] is row["Address1"] is None


def test_industry_code_skips_bad_ones(spark):
    bad = without(FULL_COMPANY, SICCodeSicText_1="X123 FUBAR")
    assert one(spark, ch=bad)["IndustryCode"] == "54321"
    no_sic = without(FULL_VAT, "sic92")
    assert one(spark, ch=bad, vats=(no_sic,))["IndustryCode"] == "77777"
    assert one(
        spark, ch=bad, vats=(no_sic,), payes=(without(FULL_PAYE, "stc"),)
    )["IndustryCode"] is None


def test_trading_status_skips_bad_ones(spark):
    near = without(FULL_COMPANY, CompanyStatus="Active - Proposal to Strike off")
    assert one(spark, ch=near)["TradingStatus"] == "I"
    bad_vat = without(FULL_VAT, deathcode="BAD")
    assert one(spark, ch=near, vats=(bad_vat,))["TradingStatus"] == "A"
    bad_paye = without(FULL_PAYE, deathcode="BAD")
    assert one(spark, ch=near, vats=(bad_vat,), payes=(bad_paye,))["TradingStatus"] is None


def test_turnover_ignores_nulls(spark):
    def band(*turnovers):
        vats = [without(FULL_VAT, vatref=10 + i, turnover=t) for i, t in enumerate(turnovers)]
        refs = [str(v["vatref"]) for v in vats]
        return one(spark, arrays=(None, refs, None), ch=None, vats=vats, payes=())["Turnover"]

    assert band(100, 300) == "C"
    assert band(100, None) == "B"
    assert band(None, None) is None


def jobs_band(spark, *payes):
    records = [without(FULL_PAYE, payeref=f"P{i}", **p) for i, p in enumerate(payes)]
    refs = [r["payeref"] for r in records]
    return one(spark, arrays=(None, None, refs), ch=None, vats=(), payes=records)["EmploymentBands"]


def test_latest_jobs(spark):
    old = {"jobs_lastupd": "Jun15", "june_jobs": 600.0}
    assert jobs_band(spark, old, {"jobs_lastupd": "Sep15", "sept_jobs": 1.0}) == "B"
    assert jobs_band(spark, {"jobs_lastupd": "Sep15", "sept_jobs": 1.0}, old) == "B"
    # the latest return decides, even without a count of its own
    assert jobs_band(spark, old, {"jobs_lastupd": "Jul15"}) is None
    assert jobs_band(spark, old, {"jobs_lastupd": "Dec15", "dec_jobs": None}) is None
    # among equal dates the later one in the link
    assert jobs_band(spark, old, {"jobs_lastupd": "Jun15", "june_jobs": 0.0}) == "A"
    # no date ranks above the years before 1970
    assert jobs_band(spark, {"jobs_lastupd": "Jun1969"}, {"jobs_lastupd": "x"}) is None
    assert jobs_band(spark, {"jobs_lastupd": "Jun1970", "june_jobs": 7.0}, {}) == "H"
    # 95 is 1995, not 2095
    assert jobs_band(
        spark, {"jobs_lastupd": "Jun95", "june_jobs": 7.0}, {"jobs_lastupd": "Jun01",
                                                             "june_jobs": 30.0}
    ) == "G"


def test_first_record_is_by_place_in_the_link(spark):
    vats = (
        without(FULL_VAT, vatref=5, name1="five"), without(FULL_VAT, vatref=70, name1="seventy"),
    )
    row = one(spark, arrays=(None, ["70", "5", "99"], None), ch=None, vats=vats, payes=())
    assert (row["BusinessName"], row["VatRefs"]) == ("SEVENTY ONE NAME", [70, 5])
    # null fields of the first record stay null, the second one does not fill them
    vats = (without(FULL_VAT, "postcode", vatref=70), without(FULL_VAT, vatref=5))
    row = one(spark, arrays=(None, ["70", "5"], None), ch=None, vats=vats, payes=())
    assert row["PostCode"] is None


def test_lookup(spark):
    lookup = tcn(
        spark, ("0100", "01500"), ("1303", "3"), ("1303", "1"), ("1303", "2"), ("x", "9"),
        (None, "8"),
    )
    records = paye(
        spark, {"payeref": "a", "stc": 100}, {"payeref": "b", "stc": 1303}, {"payeref": "c"},
        {"payeref": "d", "stc": 7},
    )
    got = views.lookup_join(records, lookup).select("payeref", "SIC07")
    assert bag(got) == [
        ("a", "01500"), ("b", "1"), ("b", "2"), ("b", "3"), ("c", None), ("d", None),
    ]
    got = views.lookup_join(records, lookup, dedupe_lookup=True).select("payeref", "SIC07")
    assert bag(got) == [("a", "01500"), ("b", "1"), ("c", None), ("d", None)]


def test_repeated_references(spark):
    """Nothing is de-duplicated by default; ``dedupe_refs`` counts a unit's reference once."""
    again = without(FULL_VAT, name1="again")
    changes = {"arrays": (None, ["10", "10"], None), "ch": None, "vats": (FULL_VAT, again)}
    row = one(spark, **changes)
    assert (row["VatRefs"], row["Turnover"]) == ([10] * 4, "H")
    row = one(spark, **changes, dedupe_refs=True)
    assert (row["VatRefs"], row["Turnover"]) == ([10], "H")


def test_units_without_records_vanish(spark):
    assert index(spark, arrays=(["none"], ["11"], [""])) == []
    # a number with leading zeros is not the VAT record's key
    assert index(spark, arrays=(None, ["010"], None)) == []


def test_blank_keys(spark):
    """A blank is a key like any other; where no record has one, blanks are left out early."""
    blank = without(FULL_PAYE, payeref="")
    row = one(spark, arrays=([""], [""], ["", "P1"]), payes=(blank, FULL_PAYE))
    assert row["PayeRefs"] == ["", "P1"]
    tables = company(spark, FULL_COMPANY), paye(spark, blank)
    assert linking.sources_with_blank_key(*tables) == ["PAYE"]
    changes = {"arrays": (["", "CH1"], ["", "10"], ["", "P1"]), "ch": FULL_COMPANY}
    assert one(spark, **changes, blank_keys=()) == one(spark, **changes)


def test_records_without_key_are_dropped(spark):
    assert index(spark, ch=without(FULL_COMPANY, "CompanyNumber"), vats=(), payes=()) == []


def test_units_without_number_are_one_unit(spark):
    df = index_from(
        links(spark, (None, None, ["10"], None), (None, None, ["20"], None)),
        company(spark),
        vat(spark, FULL_VAT, without(FULL_VAT, vatref=20)),
        paye(spark),
        tcn(spark),
    )
    assert bag(df.select("id", "VatRefs")) == [(1, [10, 20])]


def test_extracts(spark):
    rows = spark.createDataFrame(
        [
            [B + 1, "  N", None, B + 1, *[None] * 10, "A", None, [5, 6], []],
            [B + 2, "M", None, B + 2, *[None] * 10, "A", "c", None, ["p"]],
        ],
        INDEX,
    )
    assert extracts.legal_entities(rows).columns == LEGAL_ENTITY_COLUMNS
    with_refs = extracts.legal_entities_with_refs(rows)
    assert with_refs.columns == [*LEGAL_ENTITY_COLUMNS, "VatRef", "PayeRef"]
    assert bag(with_refs.select("id", "VatRef", "PayeRef")) == [
        (B + 1, "[5,6]", "[]"), (B + 2, "[]", "[p]"),
    ]
    assert bag(extracts.vat_refs(rows)) == [(B + 1, 5), (B + 1, 6)]
    assert bag(extracts.paye_refs(rows)) == [(B + 2, "p")]
    with pytest.raises(AnalysisException):
        extracts.legal_entities(rows.drop("PostCode"))
