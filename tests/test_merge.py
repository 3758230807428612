"""Upsert / insert-only / refresh semantics (FIXTURES §7)."""

from collections import Counter

import pytest

from strata.operators import merge

SCHEMA = "k long, v string"


def _rows(df):
    return sorted(((r["k"], r["v"]) for r in df.collect()), key=lambda t: (t[0] is not None, t[0] or 0, t[1]))


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_upsert(spark):
    t = _df(spark, [(1, "a"), (2, "b"), (None, "n")])
    s = _df(spark, [(2, "B"), (3, "c"), (None, "N")])
    assert _rows(merge.upsert(t, s, ["k"])) == _rows(_df(spark, [(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "N")]))


def test_insert_only(spark):
    t = _df(spark, [(1, "a"), (2, "b"), (None, "n")])
    s = _df(spark, [(2, "B"), (3, "c"), (None, "N")])
    assert _rows(merge.insert_new(t, s, ["k"])) == _rows(_df(spark, [(1, "a"), (2, "b"), (3, "c"), (None, "n"), (None, "N")]))


def test_refresh_and_delete(spark):
    t = _df(spark, [(1, "a"), (2, "b")])
    s = _df(spark, [(9, "z")])
    assert _rows(merge.refresh(t, s)) == [(9, "z")]
    out = merge.delete_all(t)
    assert out.count() == 0 and out.schema == t.schema


def test_double_match_raises_for_upsert_only(spark):
    t = _df(spark, [(1, "a"), (2, "b")])
    s = _df(spark, [(2, "B"), (2, "C")])
    with pytest.raises(merge.DuplicateMatchError):
        merge.upsert(t, s, ["k"])
    assert _rows(merge.insert_new(t, s, ["k"])) == [(1, "a"), (2, "b")]


def test_unmatched_duplicates_all_inserted(spark):
    t = _df(spark, [(1, "a")])
    s = _df(spark, [(4, "x"), (4, "y")])
    assert _rows(merge.upsert(t, s, ["k"])) == [(1, "a"), (4, "x"), (4, "y")]


def test_upsert_idempotent_without_null_keys(spark):
    t = _df(spark, [(1, "a"), (2, "b")])
    s = _df(spark, [(2, "B"), (3, "c")])
    once = merge.upsert(t, s, ["k"])
    assert _rows(merge.upsert(once, s, ["k"])) == _rows(once)
    # NULL-key source rows are inserted again on every run
    sn = _df(spark, [(None, "N")])
    twice = merge.upsert(merge.upsert(t, sn, ["k"]), sn, ["k"])
    assert _rows(twice).count((None, "N")) == 2


def test_columns_aligned_by_name(spark):
    t = _df(spark, [(1, "a")])
    s = spark.createDataFrame([("B", 1)], "v string, k long")
    assert _rows(merge.upsert(t, s, ["k"])) == [(1, "B")]


def test_composite_key_with_partial_null(spark):
    t = spark.createDataFrame([(1, None, "a"), (1, 2, "b")], "k1 long, k2 long, v string")
    s = spark.createDataFrame([(1, None, "A"), (1, 2, "B")], "k1 long, k2 long, v string")
    got = sorted(tuple(r) for r in merge.upsert(t, s, ["k1", "k2"]).fillna(-1).collect())
    assert got == [(1, -1, "A"), (1, -1, "a"), (1, 2, "B")]


def test_duplicate_target_keys_all_updated(spark):
    t = _df(spark, [(2, "b1"), (2, "b2"), (5, "e")])
    s = _df(spark, [(2, "B"), (7, "g")])
    assert _rows(merge.upsert(t, s, ["k"])) == [(2, "B"), (2, "B"), (5, "e"), (7, "g")]
    assert _rows(merge.insert_new(t, s, ["k"])) == [(2, "b1"), (2, "b2"), (5, "e"), (7, "g")]


def test_null_key_rows_bypass_the_join(spark, tmp_dir):
    t = spark.createDataFrame([(None, "n")] * 5 + [(1, "a")], SCHEMA)
    t.write.parquet(tmp_dir + "/t")
    s = _df(spark, [(1, "A")])
    out = merge.upsert(spark.read.parquet(tmp_dir + "/t"), s, ["k"])
    assert _rows(out) == [(None, "n")] * 5 + [(1, "A")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the branch with NULL keys is a filtered scan feeding the union directly
    assert "isnull(k" in plan


def test_scan_path_and_table(spark, tmp_dir):
    from strata.sources.tables import scan_path, scan_table

    _df(spark, [(1, "a")]).write.parquet(tmp_dir + "/p")
    assert _rows(scan_path(spark, tmp_dir + "/p")) == [(1, "a")]
    scan_path(spark, tmp_dir + "/p").createOrReplaceTempView("strata_scan_v")
    assert scan_table(spark, "strata_scan_v", ["K"]).columns == ["K"]


def test_hot_key_copies_updated_where_they_live(spark, tmp_dir):
    rows = [(1, "old")] * 30 + [(k, "x") for k in range(2, 62)]
    _df(spark, rows).repartition(6).write.parquet(tmp_dir + "/hot")
    t = spark.read.parquet(tmp_dir + "/hot")
    s = _df(spark, [(1, "new"), (99, "ins")])
    out = merge.upsert(t, s, ["k"])
    got = Counter(tuple(r) for r in out.collect())
    assert got[(1, "new")] == 30 and got[(99, "ins")] == 1 and (1, "old") not in got
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" in plan  # every target row meets its source row in its own partition
