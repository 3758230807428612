"""Row quality: keep-rules, a business-rule check, and a one-pass four-way split.

Semantics follow a filter-then-check job:

* ``keep`` is a conjunction of rules; a rule that is NULL counts as failed (``filter`` drops it).
* kept rows get a boolean ``check``; ``check = true`` -> valid, ``false`` -> invalid.
* a kept row whose check is NULL lands in neither filter; it is reported as ``unclassified``
  instead of vanishing.
* dropped rows are ``removed``. The set-difference form (``df.subtract(clean)``) keeps one copy
  of each distinct removed row; ``removed_distinct`` reproduces that, ``removed_all`` keeps them all.

``classify`` tags every row in a single projection (no join, no shuffle); each class is a
filter on the tag, so all classes can be written from one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID = "valid"
INVALID = "invalid"
UNCLASSIFIED = "unclassified"
REMOVED = "removed"
CLASSES = (VALID, INVALID, UNCLASSIFIED, REMOVED)


def conjunction(rules: Sequence[Column]) -> Column:
    """AND of all rules (NULL-propagating, as written)."""
    if not rules:
        return F.lit(True)
    return reduce(lambda a, b: a & b, rules)


def kept(rules: Sequence[Column]) -> Column:
    """True where every rule holds; a NULL outcome counts as failure."""
    return F.coalesce(conjunction(rules), F.lit(False))


def quality_filter(df: DataFrame, rules: Sequence[Column]) -> DataFrame:
    """Rows passing all rules (``filter(a & b & ...)``); pushed to the scan where possible."""
    return df.filter(conjunction(rules))


def add_rule(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add a boolean rule column (NULL-propagating)."""
    return df.withColumn(name, expr)


def classify(
    df: DataFrame,
    keep_rules: Sequence[Column],
    check_name: str,
    check: Column,
    on_kept: Mapping[str, Column] | None = None,
    class_col: str = "quality_class",
) -> DataFrame:
    """Tag each row with its quality class in one projection.

    ``on_kept`` are columns (new or replaced) computed for kept rows only; removed rows keep
    their original values there (new columns are NULL for them), so the removed class can be
    projected back to the input schema.
    """
    keep_flag = "__strata_keep"
    marked = df.withColumn(keep_flag, kept(keep_rules))  # rules see the input values
    keep = F.col(keep_flag)
    extra = dict(on_kept or {})
    cols = [keep]
    for c in df.columns:
        if c in extra:
            cols.append(F.when(keep, extra.pop(c)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    for name, expr in extra.items():
        cols.append(F.when(keep, expr).alias(name))
    out = marked.select(*cols).withColumn(check_name, F.when(keep, check))
    cls = (
        F.when(~keep, F.lit(REMOVED))
        .when(F.col(check_name).isNull(), F.lit(UNCLASSIFIED))
        .when(F.col(check_name), F.lit(VALID))
        .otherwise(F.lit(INVALID))
    )
    return out.withColumn(class_col, cls).drop(keep_flag)


def select_class(
    classified: DataFrame, cls: str, columns: Sequence[str], class_col: str = "quality_class"
) -> DataFrame:
    """Rows of one class, projected to ``columns``."""
    return classified.filter(F.col(class_col) == cls).select(*columns)


def split_by_rule(
    df: DataFrame, name: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(valid, invalid, unclassified)`` for a boolean rule column: true / false / NULL."""
    c = F.col(name)
    return df.filter(c), df.filter(~c), df.filter(c.isNull())


def removed_all(df: DataFrame, keep_rules: Sequence[Column]) -> DataFrame:
    """Every row that fails the keep rules, duplicates kept (total-preserving)."""
    return df.filter(~kept(keep_rules))


def removed_distinct(df: DataFrame, keep_rules: Sequence[Column]) -> DataFrame:
    """Same rows as ``df.subtract(quality_filter(df, rules))``: removed rows, one per distinct row.

    A row fails the rules exactly when it is not among the kept rows (the rules are
    deterministic), so the anti-join of ``subtract`` reduces to a filter plus a DISTINCT on the
    removed rows only; the distinct is partially aggregated before its shuffle.
    """
    return removed_all(df, keep_rules).distinct()


def quality_report(
    classified: DataFrame,
    input_columns: Sequence[str],
    class_col: str = "quality_class",
) -> DataFrame:
    """Reconciliation as rows ``(measure, rows)``, from one scan and one shuffle.

    Measures: ``total``, the four classes, ``removed_distinct`` (what the set difference keeps)
    and ``three_table_sum`` = valid + invalid + removed_distinct (which need not equal total).

    Rows are grouped by class and by their input columns, with the input columns masked to
    NULL outside the removed class: every other class collapses into one group (combined
    map-side), while removed rows group by their full value, which yields the distinct count.
    """
    is_removed = F.col(class_col) == REMOVED
    masked = [F.when(is_removed, F.col(c)).alias(f"_m{i}") for i, c in enumerate(input_columns)]
    groups = classified.select(F.col(class_col), *masked).groupBy(class_col, *[f"_m{i}" for i in range(len(input_columns))])
    per_group = groups.agg(F.count(F.lit(1)).alias("rows"))
    counts = per_group.agg(
        *[
            F.coalesce(F.sum(F.when(F.col(class_col) == c, F.col("rows"))), F.lit(0)).alias(c)
            for c in CLASSES
        ],
        F.count(F.when(F.col(class_col) == REMOVED, F.lit(1))).alias("removed_distinct"),
    )
    total = sum((F.col(c) for c in CLASSES), F.lit(0))
    counts = counts.withColumn("total", total).withColumn(
        "three_table_sum", F.col(VALID) + F.col(INVALID) + F.col("removed_distinct")
    )
    measures = ["total", *CLASSES, "removed_distinct", "three_table_sum"]
    stack = ", ".join(f"'{m}', cast(`{m}` as bigint)" for m in measures)
    return counts.selectExpr(f"stack({len(measures)}, {stack}) as (measure, rows)")
