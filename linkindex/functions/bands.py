"""Codes and bands as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper limits (exclusive) and their band letter, in order.
TURNOVER_LIMITS = [
    (100, "A"), (250, "B"), (500, "C"), (1000, "D"), (2000, "E"),
    (5000, "F"), (10000, "G"), (50000, "H"),
]
TURNOVER_TOP = "I"
# 0 and 1 have bands of their own; the limits apply to every other count, negatives included.
EMPLOYMENT_EXACT = [(0, "A"), (1, "B")]
EMPLOYMENT_LIMITS = [
    (5, "C"), (10, "D"), (20, "E"), (25, "F"), (50, "G"), (75, "H"), (100, "I"),
    (150, "J"), (200, "K"), (250, "L"), (300, "M"), (500, "N"),
]
EMPLOYMENT_TOP = "O"
STATUS_BANDS = {"Active": "A", "Closed": "C", "Dormant": "D", "Insolvent": "I"}
DEATH_CODES = {
    "0": "Active", "1": "Closed", "2": "Active", "3": "Insolvent", "4": "Active",
    "5": "Dormant", "6": "Active", "7": "Active", "8": "Active", "9": "Closed",
    "E": "Active", "M": "Active", "S": "Active", "T": "Active",
}


def lookup(table: dict[str, str | int], key: Column) -> Column:
    """The value ``table`` has for the key, null when it has none."""
    pairs = ", ".join(f"{k!r}, {v!r}" for k, v in table.items())
    return F.expr(f"map({pairs})")[key]


def _case(branches: list[tuple[Column, str]]) -> Column:
    expr = F
    for condition, value in branches:
        expr = expr.when(condition, F.lit(value))
    return expr


def turnover_band(turnover: Column) -> Column:
    """Band letter of a turnover; null stays null."""
    below = [(turnover < limit, band) for limit, band in TURNOVER_LIMITS]
    return _case(below + [(turnover.isNotNull(), TURNOVER_TOP)])


def employment_band(employees: Column) -> Column:
    """Band letter of a whole number of employees; null stays null."""
    exact = [(employees == n, band) for n, band in EMPLOYMENT_EXACT]
    below = [(employees < limit, band) for limit, band in EMPLOYMENT_LIMITS]
    return _case(exact + below + [(employees.isNotNull(), EMPLOYMENT_TOP)])


def status_band(status: Column) -> Column:
    """Band letter of a trading status; any other text gives null."""
    return lookup(STATUS_BANDS, status)


def death_status(code: Column) -> Column:
    """Trading status meant by a VAT or PAYE death code; unknown codes give null."""
    return lookup(DEATH_CODES, code)
