"""Column-level helpers (JVM-side expressions only)."""

from strata.functions.exact import exact_avg, exact_sum, float_avg, float_sum
from strata.functions.dates import date_key, date_label, date_part_long

__all__ = [
    "exact_avg",
    "exact_sum",
    "float_avg",
    "float_sum",
    "date_key",
    "date_label",
    "date_part_long",
]
