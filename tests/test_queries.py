"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from linkindex.demo import catalogue

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    """Those of the training-data package that SQL cannot express have tests of their own."""
    assert set(catalogue.ORACLES) == set(catalogue.QUERIES)
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, ORACLES[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "id"
