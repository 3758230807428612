"""Aggregate marts and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.exact import avg_of_units, bin_columns, finite_column, float_avg, float_sum, not_finite_column, sum_of_bins, sum_of_units, unit_column


@dataclass(frozen=True)
class Metric:
    """One output column of a mart: ``fn`` in {count, sum, avg} over ``column``.

    ``scale`` is the number of decimal places the column is recorded in (exact mode reads
    values at that precision; without a scale the sum is one of doubles that does not depend on
    the order); ``digits`` is the rounding of the result.
    """

    name: str
    fn: str
    column: str
    scale: int | None = None
    digits: int = 2

    def __post_init__(self) -> None:
        if self.fn not in ("count", "sum", "avg"):
            raise ValueError(f"unknown metric function {self.fn!r}")
        if self.fn != "count" and self.scale is not None and self.scale < self.digits:
            raise ValueError("scale must be >= digits")


def _plain(m: Metric) -> Column:
    if m.fn == "count":
        return F.count(F.col(m.column)).alias(m.name)
    return (float_sum if m.fn == "sum" else float_avg)(m.column, m.digits).alias(m.name)


def _parts(spec: Sequence[Metric]) -> tuple[dict[str, Column], dict[str, Column]]:
    """What is added up for ``spec``, by name, and the columns to project before."""
    out, first = {f"n_{m.column}": F.col(m.column) for m in spec}, {}
    for m in spec:
        if m.fn == "count":
            continue
        if m.scale is not None:
            out[f"u{m.scale}_{m.column}"] = unit_column(m.column, m.scale)
        else:
            first[f"__x_{m.column}"] = finite_column(m.column)
            out |= bin_columns(m.column, f"__x_{m.column}") | {f"w_{m.column}": not_finite_column(m.column)}
    return out, first


def mart_state(df: DataFrame, keys: Sequence[str | Column], spec: Sequence[Metric]) -> DataFrame:
    """The mergeable state of a mart: per key the counts and unit sums its metrics need.

    The units are projected once, however many metrics read them, and summed as plain longs, so
    states of different loads can be added up (``merge_states``) to what one load of all rows gives."""
    parts, first = _parts(spec)
    named = df.withColumns(first).select(*keys, *[c.alias(f"__{n}") for n, c in parts.items()])
    of = named.columns[: len(keys)]
    # try_sum: an overflow is NULL here and an error when the mart is made, with ANSI mode on or off
    kinds = {"n": F.count, "w": F.sum}
    return named.groupBy(*of).agg(*[kinds.get(n[0], F.try_sum)(f"__{n}").alias(n) for n in parts])


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of several loads, one row per key and load, added up per key."""
    added = [c for c in states.columns if c not in keys]
    return states.groupBy(*keys).agg(*[(F.sum if c.startswith("w_") else F.try_sum)(c).alias(c) for c in added])


def mart_of_state(state: DataFrame, keys: Sequence[str], spec: Sequence[Metric]) -> DataFrame:
    """The mart of a state: one projection."""
    out = []
    for m in spec:
        n = f"n_{m.column}"
        if m.fn == "count":
            value = F.col(n)
        elif m.scale is not None:
            value = (sum_of_units if m.fn == "sum" else avg_of_units)(f"u{m.scale}_{m.column}", n, m.scale, m.digits)
        else:
            total = sum_of_bins(m.column, n)
            value = F.when(F.col(n) > 0, F.round(total if m.fn == "sum" else total / F.col(n), m.digits))
        out.append(value.alias(m.name))
    return state.select(*keys, *out)


def metrics_by(
    df: DataFrame, keys: Sequence[str | Column], spec: Sequence[Metric], exact: bool = True
) -> DataFrame:
    """``groupBy(keys).agg(spec)``: partial aggregation before the shuffle, NULL keys kept.

    ``exact=False`` is the plain ``round(agg(double))``."""
    if not exact:
        return df.groupBy(*keys).agg(*[_plain(m) for m in spec])
    state = mart_state(df, keys, spec)
    return mart_of_state(state, state.columns[: len(keys)], spec)


def distinct_state(df: DataFrame, keys: Sequence[str | Column], columns: Sequence[str], name: str = "distinct_rows", precision: int = 14) -> DataFrame:
    """Per key a HyperLogLog sketch of the distinct rows of ``columns`` (NULLs are values), a few KB
    whatever the rows: kept per load, a history is counted without reading it again."""
    row = F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])
    return df.groupBy(*keys).agg(F.hll_sketch_agg(row, F.lit(precision)).alias(name))


def merge_distinct(states: DataFrame, keys: Sequence[str], name: str = "distinct_rows") -> DataFrame:
    """Sketches of several loads united per key, with the estimated count as ``<name>_estimate``."""
    united = states.groupBy(*keys).agg(F.hll_union_agg(name).alias(name))
    return united.withColumn(f"{name}_estimate", F.hll_sketch_estimate(name))


def rollup_fact(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Fact roll-up: ``sum`` of each measure per key combination, names kept."""
    return df.groupBy(*keys).agg(*[F.sum(F.col(m)).alias(m) for m in measures])


def top_k(
    df: DataFrame,
    order: Sequence[Column],
    k: int,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """First ``k`` rows by ``order`` with a full tie-break (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order, *[F.col(c).asc_nulls_first() for c in tie_break]).limit(k)
