"""Surrogate keys for facts, and a check for keys that collide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_key(cols: Sequence[str | Column], kind: str = "bigint", too_long: str = "error") -> Column:
    """Digits of each part run together, read as ``kind`` (NULL if any part is NULL or no number).

    ``bigint`` holds up to 18 digits; a longer key fails with an error that names the wider
    kinds (``decimal(38,0)`` or ``string``) and is never NULL, unless ``too_long="null"`` asks for what a
    plain cast gave (for rows that another key tells apart). Unpadded parts can collide:
    (1, 12) and (11, 2) both give 112."""
    if too_long not in ("error", "null"):
        raise ValueError(f"too_long is error or null, not {too_long!r}")
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    text = F.concat(*[p.cast("string") for p in parts])
    number = text.try_cast(kind)
    if too_long == "null":
        return number
    cut = number.isNull() & text.rlike("^[0-9]+$")
    return F.when(cut, F.raise_error(F.concat(F.lit(f"key does not fit {kind}, use decimal(38,0) or string: "), text))).otherwise(number)


def padded_key(cols: Sequence[str | Column], widths: Sequence[int]) -> Column:
    """Collision-free text key: each part left-padded with zeros to a fixed width.

    Every part needs a width; a value longer than its width is an error (padding would cut it)."""
    if len(cols) != len(widths):
        raise ValueError(f"{len(cols)} key columns, {len(widths)} widths")
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    fits = [
        F.when(F.length(p) > w, F.raise_error(F.concat(F.lit(f"key part is longer than {w}: "), p))).otherwise(F.lpad(p, w, "0"))
        for p, w in zip(parts, widths)
    ]
    return F.concat(*fits)


def hash_key(cols: Sequence[str | Column]) -> Column:
    """64-bit hash key (xxhash64); compact, collisions only by chance. A NULL part counts as such:
    the hash itself skips NULLs, so each part goes in with a mark of whether it is there."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.xxhash64(*[x for p in parts for x in (p.isNull(), p)])


def key_collisions(
    df: DataFrame, key: str, natural: Sequence[str], natural_unique: bool = False
) -> DataFrame:
    """Surrogate key values shared by more than one distinct natural key.

    Output: ``key``, ``natural_keys`` (distinct natural keys behind it), ``rows``.
    Planned as two aggregations (by key + natural, then by key), each partially aggregated;
    with ``natural_unique=True`` (each natural key occurs once, e.g. in a rolled-up fact) the
    first one is skipped.
    """
    if natural_unique:
        return (
            df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("natural_keys"), F.count(F.lit(1)).alias("rows"))
            .filter(F.col("natural_keys") > 1)
        )
    per_natural = df.groupBy(key, *natural).agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_natural.groupBy(key)
        .agg(F.count(F.lit(1)).alias("natural_keys"), F.sum("_n").alias("rows"))
        .filter(F.col("natural_keys") > 1)
    )
