"""Text, date and number rules of single fields, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkindex.functions.bands import lookup

# English month names, short and full, with their number.
_MONTHS = {
    name: number
    for number, names in enumerate(
        [
            "jan january", "feb february", "mar march", "apr april", "may", "jun june",
            "jul july", "aug august", "sep september", "oct october", "nov november",
            "dec december",
        ],
        1,
    )
    for name in names.split()
}
_INT_MAX, _INT_MIN = 2**31 - 1, -(2**31)


def name_lines(*lines: Column) -> Column:
    """Lines joined by one blank each, nulls as empty text, nothing trimmed: never null."""
    return F.concat_ws(" ", *[F.coalesce(line, F.lit("")) for line in lines])


def sic_prefix(text: Column) -> Column:
    """Leading digits of a one-line text, null when it does not start with a digit."""
    return F.nullif(F.regexp_extract(text, r"^(\d+).*\z", 1), F.lit(""))


def stringify_array(array: Column) -> Column:
    """``[a,b]``; a null or empty array gives ``[]``."""
    return F.concat(F.lit("["), F.concat_ws(",", array.cast("array<string>")), F.lit("]"))


def _number_text(text: Column) -> Column:
    """Up to nine digits at the end of a text, and the sign before them; empty when none."""
    return F.regexp_extract(text, r"[+-]?\d{1,9}\z", 0)


def month_of(text: Column) -> Column:
    """Month 1-12 of a text such as ``Jun16``, null when it is not one."""
    number = _number_text(text)
    name = F.lower(F.left(text, F.length(text) - F.length(number)))
    return F.when(number != "", lookup(_MONTHS, name))


def year_of(text: Column, last_year: int = 2045) -> Column:
    """Year of a text such as ``Jun16``, null when it does not end in a number.

    Two bare digits mean the year of that ending in the hundred years up to ``last_year``;
    more digits, fewer, or a sign are taken as they stand.
    """
    number = _number_text(text)
    year = F.when(number != "", number.cast("int"))  # nine digits always fit
    bare = (F.length(number) == 2) & (number >= "0")  # signs sort before digits
    century = last_year // 100 * 100
    base = F.when(~bare, 0).when(year <= last_year % 100, century).otherwise(century - 100)
    return year + base


def update_order(month: Column, year: Column) -> Column:
    """Sort key of an update month: later is larger, no date lies just before January 1970."""
    months = (year.cast("bigint") - 1970) * 12 + month - 1
    return F.coalesce(months * 2, F.lit(-1).cast("bigint"))


def quarter_jobs(month: Column, mar: Column, june: Column, sept: Column, dec: Column) -> Column:
    """The job count that belongs to the update month; null outside the quarter months."""
    return (
        F.when(month == 3, mar).when(month == 6, june).when(month == 9, sept).when(month == 12, dec)
    )


def whole_number(value: Column) -> Column:
    """Double to int: cut toward zero, held at the int limits, NaN as 0."""
    held = F.greatest(F.least(value, F.lit(float(_INT_MAX))), F.lit(float(_INT_MIN)))
    return F.when(F.isnan(value), F.lit(0)).when(value.isNotNull(), held.cast("int"))
