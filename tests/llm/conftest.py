"""The package's zip reaches the Python workers of the tests' session."""

from __future__ import annotations

import pytest

from linkindex.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)
