"""Table maintenance as DataFrame algebra: upsert, insert-only merge, full refresh, delete.

Semantics of a key-matched MERGE:

* a key matches only if every key column is non-NULL and equal, so NULL-key rows never match:
  NULL-key source rows are always inserted and NULL-key target rows always stay;
* upsert (update-all + insert-all): matched target rows are replaced by their source rows
  (every copy, if the target holds a key more than once), unmatched source rows are inserted,
  unmatched target rows stay (nothing is deleted);
* two source rows matching the same target row is an error for upsert (``DuplicateMatchError``);
  duplicate source keys without a match are all inserted;
* insert-only: unmatched source rows are inserted, matched target rows are left alone.

NULL-key rows are split off before the anti-join, so a large NULL-key group never lands in
one join partition; other hot keys are left to AQE's skew-join split.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateMatchError(ValueError):
    """More than one source row matches the same target row."""


def _c(name: str) -> Column:
    """A column by its whole name (dots and all)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [_c(k).isNotNull() for k in keys])


def _align(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns in target order (by name); both sides must have the same columns."""
    if sorted(c.lower() for c in source.columns) != sorted(c.lower() for c in target.columns):
        raise ValueError(f"column sets differ: {source.columns} vs {target.columns}")
    lower = {c.lower(): c for c in source.columns}
    return source.select(*[_c(lower[c.lower()]).alias(c) for c in target.columns])


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source keys (without NULL) that occur more than once."""
    counted = source.filter(_all_present(keys)).groupBy(*map(_c, keys)).agg(F.count(F.lit(1)).alias("source_rows"))
    return counted.filter(F.col("source_rows") > 1)


def duplicate_matches(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source keys that occur more than once and also exist in the target."""
    # the (usually tiny) duplicate set is the build side, so the target keys are not shuffled
    # to meet it when it can be broadcast
    return target.filter(_all_present(keys)).select(*map(_c, keys)).join(duplicate_keys(source, keys), list(keys), "left_semi")


def check_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise ``DuplicateMatchError`` if a target row would be matched twice. The target is read
    only if the source has duplicate keys at all."""
    if not duplicate_keys(source, keys).isEmpty() and not duplicate_matches(target, source, keys).isEmpty():
        raise DuplicateMatchError(f"several source rows match one target row on {list(keys)}")


#: Counters of the frequent-keys sketch. A key above 1 / FREQUENT of the rows is surely among those it gives.
COUNTERS, FREQUENT = 8192, 1000


def frequent_keys(rows: DataFrame, keys: Sequence[str], share: float = 1 / 64) -> DataFrame:
    """Keys that about ``share`` of the rows or more have: at most ``1 / share`` of them, by a
    frequent-items sketch (one pass, partially aggregated, bounded counters)."""
    if not 1 / FREQUENT <= share <= 1:
        raise ValueError(f"share must be from 1/{FREQUENT} to 1")
    most = int(1 / share)
    key = F.struct(*[_c(k).alias(f"k{i}") for i, k in enumerate(keys)])
    # the sketch counts one plain value, so a key is counted by its JSON text
    text = F.to_json(key, {"ignoreNullFields": "false"})
    texts = rows.filter(_all_present(keys)).select(text.alias("key"))
    top = texts.agg(F.expr(f"approx_top_k(key, {most}, {COUNTERS})").alias("top"), F.count(F.lit(1)).alias("n"))
    found = top.select("n", F.explode("top").alias("t")).filter(F.col("t.count") >= F.col("n") * share)
    schema = ", ".join(f"k{i} {rows.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    parsed = found.select(F.from_json("t.item", schema).alias("k"))
    return parsed.select(*[F.col(f"k.k{i}").alias(k) for i, k in enumerate(keys)])


def _updated(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows, each with the values of its source row if it has one: a left outer join that
    streams the target, so all copies of a key are updated in their own partitions."""
    hit = "__strata_hit"
    values = [c for c in target.columns if c not in keys]
    s_side = source.select(*map(_c, keys), *[_c(c).alias(f"__s_{c}") for c in values], F.lit(True).alias(hit))
    joined = target.join(s_side, keys, "left_outer")
    return joined.select(*[_c(c) if c in keys else F.when(F.col(hit), _c(f"__s_{c}")).otherwise(_c(c)).alias(c) for c in target.columns])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], check: bool = True, heavy: DataFrame | None = None, aligned: bool = False
) -> DataFrame:
    """Update-all on match, insert-all otherwise; unmatched target rows kept.

    ``heavy`` (``frequent_keys`` of the target) names a bounded set of keys. Their target rows are
    never shuffled: the source rows of these keys, at most one each where the target has them, are
    broadcast to wherever the rows lie. ``aligned`` plans the rest as one full outer join, the
    form in which a target bucketed by the keys stays where it is.
    """
    keys = list(keys)
    src = _align(source, target)
    if check:
        check_single_match(target, src, keys)
    extra = []
    if heavy is not None:
        few = F.broadcast(heavy.select(*map(_c, keys)).distinct())
        t_heavy, s_heavy = target.join(few, keys, "left_semi"), src.join(few, keys, "left_semi")
        t_heavy, s_heavy = t_heavy.select(*map(_c, target.columns)), s_heavy.select(*map(_c, target.columns))
        # where the check holds, a key of the target matches one source row at most, so this side is as bounded as the keys
        extra = [_updated(t_heavy, F.broadcast(s_heavy) if check else s_heavy, keys)]
        extra.append(s_heavy.join(t_heavy.select(*map(_c, keys)).distinct(), keys, "left_anti").select(*map(_c, target.columns)))
        columns = [_c(c) for c in target.columns]
        target, src = (side.join(few, keys, "left_anti").select(*columns) for side in (target, src))
    present = _all_present(keys)
    if aligned:
        return reduce(DataFrame.unionByName, [_outer(target, src, keys), *extra])
    t_in, s_in = target.filter(present), src.filter(present)
    # source rows whose key the target does not have are inserted
    matched = t_in.select(*map(_c, keys)).join(s_in.select(*map(_c, keys)), keys, "left_semi").distinct()
    new = s_in.join(matched, keys, "left_anti")
    parts = [_updated(t_in, s_in, keys), target.filter(~present), new, src.filter(~present), *extra]
    return reduce(DataFrame.unionByName, parts)


def _outer(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The upsert as one full outer join; NULL keys match nothing there, so such rows all stay."""
    t = target.select(*[_c(c).alias(f"t{i}") for i, c in enumerate(target.columns)])
    s = source.select(*[_c(c).alias(f"s{i}") for i, c in enumerate(target.columns)], F.lit(True).alias("hit"))
    at = [target.columns.index(k) for k in keys]
    joined = t.join(s, [F.col(f"t{i}") == F.col(f"s{i}") for i in at], "full_outer")
    return joined.select(*[F.when(F.col("hit"), F.col(f"s{i}")).otherwise(F.col(f"t{i}")).alias(c) for i, c in enumerate(target.columns)])


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows whose key is not in the target, in the target's columns."""
    keys = list(keys)
    src = _align(source, target)
    present = _all_present(keys)
    src_keys = src.filter(present).select(*map(_c, keys))
    # target keys are cut to the ones the source has (semi-join; the source keys are the build
    # side and are broadcast when small, so the target is not shuffled), then the source rows
    # with those keys are dropped
    matched = target.filter(present).select(*map(_c, keys)).join(src_keys, keys, "left_semi").distinct()
    new = src.filter(present).join(matched, keys, "left_anti").select(*map(_c, target.columns))
    return new.unionByName(src.filter(~present))


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-only merge: target plus the source rows whose key is not in the target."""
    return target.unionByName(new_rows(target, source, keys))


def refresh(target: DataFrame, source: DataFrame) -> DataFrame:
    """Full refresh (delete all, then insert): exactly the source, in the target's columns."""
    return _align(source, target)


def delete_all(target: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return target.where(F.lit(False))
