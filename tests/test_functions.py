"""Field rules, value by value."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linkindex.functions import (
    death_status,
    employment_band,
    month_of,
    name_lines,
    quarter_jobs,
    sic_prefix,
    status_band,
    stringify_array,
    turnover_band,
    update_order,
    whole_number,
    year_of,
)


def applied(spark, values, kind, rule):
    """The rule's result for each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v")).alias("r")).collect()]


def test_turnover_band(spark):
    cases = {
        None: None, -5: "A", 0: "A", 10: "A", 99: "A", 100: "B", 110: "B", 249: "B", 250: "C",
        499: "C", 500: "D", 510: "D", 999: "D", 1000: "E", 1010: "E", 1999: "E", 2000: "F",
        2010: "F", 4999: "F", 5000: "G", 5010: "G", 9999: "G", 10000: "H", 10010: "H",
        40010: "H", 49999: "H", 50000: "I", 99999: "I", 2**62: "I",
    }
    assert applied(spark, cases, "bigint", turnover_band) == list(cases.values())


def test_employment_band(spark):
    cases = {
        None: None, -1: "C", 0: "A", 1: "B", 2: "C", 4: "C", 5: "D", 6: "D", 9: "D", 10: "E",
        11: "E", 19: "E", 20: "F", 21: "F", 24: "F", 25: "G", 26: "G", 49: "G", 50: "H", 51: "H",
        74: "H", 75: "I", 76: "I", 99: "I", 100: "J", 101: "J", 149: "J", 150: "K", 151: "K",
        199: "K", 200: "L", 201: "L", 249: "L", 250: "M", 251: "M", 299: "M", 300: "N", 301: "N",
        499: "N", 500: "O", 501: "O", 2**31 - 1: "O",
    }
    assert applied(spark, cases, "int", employment_band) == list(cases.values())


def test_status_band(spark):
    cases = {
        "Active": "A", "Closed": "C", "Dormant": "D", "Insolvent": "I", "INVALID": None,
        "active": None, "Active - Proposal to Strike off": None, "?": None, "": None, None: None,
    }
    assert applied(spark, cases, "string", status_band) == list(cases.values())


def test_death_status(spark):
    cases = {
        "0": "Active", "1": "Closed", "2": "Active", "3": "Insolvent", "4": "Active",
        "5": "Dormant", "6": "Active", "7": "Active", "8": "Active", "9": "Closed",
        "E": "Active", "M": "Active", "S": "Active", "T": "Active", "BAD": None, "e": None,
        "": None, None: None,
    }
    assert applied(spark, cases, "string", death_status) == list(cases.values())


def test_sic_prefix(spark):
    cases = {
        "123 FUBAR": "123", "99999 - Dormant Company": "99999", "12345": "12345", "X123": None,
        "None Supplied": None, " 12": None, "": None, None: None, "12\nx": None, "007": "007",
    }
    assert applied(spark, cases, "string", sic_prefix) == list(cases.values())


def test_name_lines_keeps_blanks(spark):
    df = spark.createDataFrame(
        [("a", "b", "c"), (None, None, "c"), ("a", None, "c"), (None, None, None), ("", "b", "")],
        "a string, b string, c string",
    ).coalesce(1)
    got = [r[0] for r in df.select(name_lines(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["a b c", "  c", "a  c", "  ", " b "]


def test_stringify_array(spark):
    assert applied(spark, [None, [], [1], [1, 22]], "array<bigint>", stringify_array) == [
        "[]", "[]", "[1]", "[1,22]",
    ]


@pytest.mark.parametrize(
    ("text", "month", "year"),
    [
        ("Jun16", 6, 2016), ("JUN16", 6, 2016), ("june16", 6, 2016), ("Dec95", 12, 1995),
        ("Jan45", 1, 2045), ("Jan46", 1, 1946), ("May00", 5, 2000), ("Mar2017", 3, 2017),
        ("September99", 9, 1999), ("Sep5", 9, 5), ("Jun-16", 6, -16), ("Jun+16", 6, 16),
        ("Sept16", None, None), ("Jun", None, None), ("", None, None), (None, None, None),
        ("jobs_lastupd", None, None), ("16Jun", None, None), ("Jun16 ", None, None),
        ("J16", None, None), ("Jun1234567890", None, None),
    ],
)
def test_month_year(spark, text, month, year):
    df = spark.createDataFrame([(text,)], "v string")
    v = F.col("v")
    order = update_order(month_of(v), year_of(v))
    row = df.select(month_of(v).alias("m"), year_of(v).alias("y"), order.alias("o")).first()
    assert row.m == month
    if month is None:
        assert row.o == -1
    else:
        assert row.y == year
        assert row.o == 2 * ((year - 1970) * 12 + month - 1)


def test_last_year_moves_the_window(spark):
    assert applied(spark, ["Jun46", "Jun60"], "string", lambda v: year_of(v, 2059)) == [2046, 1960]


def test_quarter_jobs(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)] + [(None,)], "m int").coalesce(1)
    jobs = quarter_jobs(F.col("m"), F.lit(30.0), F.lit(60.0), F.lit(90.0), F.lit(120.0))
    got = {r.m: r.j for r in df.select("m", jobs.alias("j")).collect()}
    assert {m: j for m, j in got.items() if j is not None} == {3: 30.0, 6: 60.0, 9: 90.0, 12: 120.0}


def test_whole_number(spark):
    values = [None, 0.0, 1.9, -1.9, 1e12, -1e12, float("nan"), float("inf")]
    assert applied(spark, values, "double", whole_number) == [
        None, 0, 1, -1, 2**31 - 1, -(2**31), 0, 2**31 - 1,
    ]
