"""Date keys and parts, zone-free (pattern letters as in Spark's datetime patterns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column | str) -> Column:
    """``yyyyMMdd`` as bigint, e.g. 2021-01-01 -> 20210101."""
    return F.date_format(c, "yyyyMMdd").cast("bigint")


def date_part_long(c: Column | str, pattern: str) -> Column:
    """Any ``date_format`` pattern read back as bigint (``MMyyyy`` drops the leading zero)."""
    return F.date_format(c, pattern).cast("bigint")


def date_label(c: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Day label as text, e.g. ``2023-01-31``."""
    return F.date_format(c, pattern)
