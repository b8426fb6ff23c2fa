"""Column expressions for the derivation rules."""

from linkindex.functions.bands import death_status, employment_band, status_band, turnover_band
from linkindex.functions.fields import (
    month_of,
    name_lines,
    quarter_jobs,
    sic_prefix,
    stringify_array,
    update_order,
    whole_number,
    year_of,
)

__all__ = [
    "death_status", "employment_band", "status_band", "turnover_band", "month_of", "name_lines",
    "quarter_jobs", "sic_prefix", "stringify_array", "update_order", "whole_number", "year_of",
]
