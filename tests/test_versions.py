"""Optimistic publishing, atomic appends, bucketed and heavy-key merges, retention."""

import re

import pytest
from pyspark.sql import functions as F

from strata.operators import merge
from strata.sinks import tables, versions


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _frame(spark, rows, columns="k long, v string"):
    return spark.createDataFrame(rows, columns)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _while_writing(monkeypatch, other):
    """Run ``other`` once, after the first writer has written its files and before its claim."""
    real, waiting = tables._write_files, [other]

    def write(df, location, like):
        real(df, location, like)
        if waiting:
            waiting.pop()()

    monkeypatch.setattr(tables, "_write_files", write)


@pytest.mark.parametrize("first,second", [("upsert", "insert"), ("insert", "upsert"), ("upsert", "upsert"), ("insert", "insert")])
def test_two_writers_of_one_version_lose_no_row(spark, tmp_dir, monkeypatch, first, second):
    name, base = f"strata_cas_{first}_{second}", tmp_dir + "/cas"
    run = {"upsert": tables.upsert_table, "insert": tables.insert_new_table}
    tables.upsert_table(spark, _frame(spark, [(1, "a")]), name, ["k"], base)
    other = lambda: run[second](spark, _frame(spark, [(10, "second"), (11, "s")]), name, ["k"], base)
    _while_writing(monkeypatch, other)
    run[first](spark, _frame(spark, [(10, "first"), (12, "f")]), name, ["k"], base)
    ten = "first" if first == "upsert" else "second"
    assert _rows(spark.table(name)) == [(1, "a"), (10, ten), (11, "s"), (12, "f")]


def test_second_writer_is_refused_without_attempts_left(spark, tmp_dir, monkeypatch):
    name, base = "strata_cas_refused", tmp_dir + "/cas"
    tables.upsert_table(spark, _frame(spark, [(1, "a")]), name, ["k"], base)
    _while_writing(monkeypatch, lambda: tables.upsert_table(spark, _frame(spark, [(2, "b")]), name, ["k"], base))
    with pytest.raises(versions.PublishConflict):
        tables.upsert_table(spark, _frame(spark, [(3, "c")]), name, ["k"], base, attempts=1)
    assert _rows(spark.table(name)) == [(1, "a"), (2, "b")]


def test_two_writers_create_one_table(spark, tmp_dir, monkeypatch):
    name, base = "strata_cas_create", tmp_dir + "/cas"
    _while_writing(monkeypatch, lambda: tables.upsert_table(spark, _frame(spark, [(2, "b")]), name, ["k"], base))
    tables.upsert_table(spark, _frame(spark, [(1, "a"), (2, "B")]), name, ["k"], base)
    assert _rows(spark.table(name)) == [(1, "a"), (2, "B")]


def test_a_number_is_claimed_once(spark, tmp_dir):
    one = versions.Publication(0, tmp_dir + "/v-1")
    versions.claim(spark, tmp_dir, one)
    with pytest.raises(versions.PublishConflict):
        versions.claim(spark, tmp_dir, versions.Publication(0, tmp_dir + "/v-2"))
    assert versions.last(spark, tmp_dir) == one
    assert [n for n, _ in versions.folders(spark, tmp_dir + "/_published")] == ["000000000000"]


def test_writer_lost_between_claim_and_catalog(spark, tmp_dir, monkeypatch):
    name, base = "strata_cas_lost", tmp_dir + "/cas"
    tables.upsert_table(spark, _frame(spark, [(1, "a")]), name, ["k"], base)
    with monkeypatch.context() as m:
        real, calls = tables._point, []

        def point(*a):
            calls.append(a)
            if len(calls) == 2:  # the first call reads the rows, the second follows the claim
                raise OSError("lost")
            return real(*a)

        m.setattr(tables, "_point", point)
        with pytest.raises(OSError):
            tables.upsert_table(spark, _frame(spark, [(2, "b")]), name, ["k"], base)
    assert _rows(spark.table(name)) == [(1, "a")]  # published, but the catalog is behind
    tables.upsert_table(spark, _frame(spark, [(3, "c")]), name, ["k"], base)
    assert _rows(spark.table(name)) == [(1, "a"), (2, "b"), (3, "c")]


def test_failed_append_shows_nothing_and_lost_append_is_completed(spark, tmp_dir, monkeypatch):
    name, base = "strata_append_atomic", tmp_dir + "/ap"
    tables.insert_new_table(spark, _frame(spark, [(1, "a")]), name, ["k"], base)
    with monkeypatch.context() as m:
        m.setattr(versions, "claim", lambda *a: (_ for _ in ()).throw(OSError("failed job")))
        with pytest.raises(OSError):
            tables.insert_new_table(spark, _frame(spark, [(2, "b"), (None, "n")]), name, ["k"], base)
    spark.catalog.refreshTable(name)
    assert _rows(spark.table(name)) == [(1, "a")]
    with monkeypatch.context() as m:
        m.setattr(versions, "show_added", lambda spark, p: (_ for _ in ()).throw(OSError("lost")) if p.added else None)
        with pytest.raises(OSError):
            tables.insert_new_table(spark, _frame(spark, [(2, "b"), (None, "n")]), name, ["k"], base)
    tables.insert_new_table(spark, _frame(spark, [(2, "x"), (3, "c")]), name, ["k"], base)
    assert _rows(spark.table(name)) == sorted([(1, "a"), (2, "b"), (3, "c"), (None, "n")], key=str)
    tables.upsert_table(spark, _frame(spark, [(3, "C")]), name, ["k"], base)
    assert _rows(spark.table(name)) == sorted([(1, "a"), (2, "b"), (3, "C"), (None, "n")], key=str)


def test_table_made_elsewhere_is_taken_over(spark, tmp_dir):
    name = "strata_taken_over"
    _frame(spark, [(1, "a")]).write.option("path", tmp_dir + "/old").saveAsTable(name)
    tables.insert_new_table(spark, _frame(spark, [(1, "x"), (2, "b")]), name, ["k"], tmp_dir + "/base")
    assert _rows(spark.table(name)) == [(1, "a"), (2, "b")]
    tables.upsert_table(spark, _frame(spark, [(2, "B")]), name, ["k"], tmp_dir + "/base")
    assert _rows(spark.table(name)) == [(1, "a"), (2, "B")]


def test_bucketed_merge_leaves_the_target_where_it_is(spark, tmp_dir):
    name, base = "strata_bucketed", tmp_dir + "/b"
    rows = [(i, f"v{i}") for i in range(200)] + [(7, "again"), (None, "n")]
    tables.upsert_table(spark, _frame(spark, rows), name, ["k"], base, bucket_by=["k"], buckets=4)
    src = _frame(spark, [(i, f"w{i}") for i in range(150, 260)] + [(7, "seven"), (None, "m")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = _plan(merge.upsert(spark.table(name), src, ["k"], check=False, aligned=True))
        tables.upsert_table(spark, src, name, ["k"], base)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    before, target = plan.split("FileScan parquet")[0], plan.split("FileScan parquet")[1]
    assert "SelectedBucketsCount: 4 out of 4" in target
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange" not in before.split("SortMergeJoin")[1].split("+- ")[0]
    model = {i: f"v{i}" for i in range(200)} | {i: f"w{i}" for i in range(150, 260)} | {7: "seven"}
    want = [*model.items(), (7, "seven"), (None, "n"), (None, "m")]
    assert _rows(spark.table(name)) == sorted(want, key=str)
    files = [f.rsplit("/", 1)[1] for f in spark.table(name).inputFiles()]
    assert len({re.search(r"_(\d{5})\.", f)[1] for f in files}) == len(files) == 4  # one file per bucket again
    tables.insert_new_table(spark, _frame(spark, [(1, "x"), (900, "new")]), name, ["k"], base)
    assert _rows(spark.table(name)) == sorted([*want, (900, "new")], key=str)


def test_heavy_keys_are_found_and_not_shuffled(spark):
    rows = [(1, f"hot{i}") for i in range(3000)] + [(i, "x") for i in range(2, 3000)] + [(None, "n")] * 5
    target = _frame(spark, rows).repartition(8)
    heavy = merge.frequent_keys(target, ["k"], 1 / 64)
    assert _rows(heavy) == [(1,)]
    src = _frame(spark, [(1, "ONE"), (5, "five"), (5000, "new"), (None, "m")])
    want = sorted([(1, "ONE")] * 3000 + [(i, "five" if i == 5 else "x") for i in range(2, 3000)] + [(5000, "new"), (None, "m")] + [(None, "n")] * 5, key=str)
    for aligned in (False, True):
        assert _rows(merge.upsert(target, src, ["k"], heavy=heavy, aligned=aligned)) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = merge.upsert(target, src, ["k"], heavy=heavy)
        sizes = [n for n in got.rdd.glom().map(len).collect() if n]
        assert _rows(got) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(sizes) < 3000  # the hot rows stay spread over the target's partitions
    with pytest.raises(ValueError):
        merge.frequent_keys(target, ["k"], 1 / 5000)


def test_heavy_key_that_only_the_source_has_is_inserted(spark):
    target, src = _frame(spark, [(1, "a")]), _frame(spark, [(2, "b"), (2, "c")])
    heavy = _frame(spark, [(1, "-"), (2, "-")]).select("k")
    assert _rows(merge.upsert(target, src, ["k"], heavy=heavy)) == [(1, "a"), (2, "b"), (2, "c")]


def test_heavy_keys_of_several_columns_and_types(spark):
    import datetime as dt

    rows = [(dt.date(2021, 1, 2), "é", i) for i in range(500)] + [(dt.date(2021, 1, 3), None, i) for i in range(500)] + [(dt.date(2022, 1, 1), str(i), i) for i in range(500)]
    target = spark.createDataFrame(rows, "d date, `r.x` string, v int")
    assert _rows(merge.frequent_keys(target, ["d", "r.x"], 1 / 10)) == [(dt.date(2021, 1, 2), "é")]


def test_merge_with_dots_in_names(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "`id.x` long, `v.y` string, `w``z` int")
    src = spark.createDataFrame([(2, "B", 3), (3, "C", 4)], target.schema)
    assert _rows(merge.upsert(target, src, ["id.x"])) == [(1, "a", 1), (2, "B", 3), (3, "C", 4)]
    assert _rows(merge.upsert(target, src, ["id.x"], aligned=True)) == [(1, "a", 1), (2, "B", 3), (3, "C", 4)]
    assert _rows(merge.insert_new(target, src, ["id.x"])) == [(1, "a", 1), (2, "b", 2), (3, "C", 4)]
    with pytest.raises(merge.DuplicateMatchError):
        merge.upsert(target, src.unionAll(src), ["id.x"])


def test_tables_in_the_sessions_default_format(spark, tmp_dir):
    spark.conf.set("spark.sql.sources.default", "orc")
    try:
        tables.overwrite_table(_frame(spark, [(1, "a")]), "strata_orc", tmp_dir + "/orc")
        tables.upsert_table(spark, _frame(spark, [(1, "a")]), "strata_orc_v", ["k"], tmp_dir + "/v")
    finally:
        spark.conf.unset("spark.sql.sources.default")
    tables.upsert_table(spark, _frame(spark, [(1, "A"), (2, "b")]), "strata_orc_v", ["k"], tmp_dir + "/v")
    tables.insert_new_table(spark, _frame(spark, [(3, "c")]), "strata_orc_v", ["k"], tmp_dir + "/v")
    assert _rows(spark.table("strata_orc_v")) == [(1, "A"), (2, "b"), (3, "c")]
    for name in ("strata_orc", "strata_orc_v"):
        assert all(f.endswith(".orc") for f in spark.table(name).inputFiles())


def test_expired_versions_go_and_used_ones_stay(spark, tmp_dir):
    name, base = "strata_expire", tmp_dir + "/e"
    for i in range(3):
        tables.upsert_table(spark, _frame(spark, [(i, str(i))]), name, ["k"], base)
    tables.insert_new_table(spark, _frame(spark, [(9, "n")]), name, ["k"], base)
    assert tables.expire_versions(spark, name, base) == []
    gone = tables.expire_versions(spark, name, base, keep_hours=-1)
    assert len([g for g in gone if g.startswith("v-")]) == 2 and len([g for g in gone if g.startswith("_staging-")]) == 3
    spark.catalog.refreshTable(name)
    assert _rows(spark.table(name)) == [(0, "0"), (1, "1"), (2, "2"), (9, "n")]
    part, pbase = "strata_expire_parts", tmp_dir + "/p"
    first = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "d int, k long, v string")
    tables.upsert_partitioned_table(spark, first, part, ["d", "k"], ["d"], pbase)
    for v in ("x", "y"):
        tables.upsert_partitioned_table(spark, spark.createDataFrame([(2, 1, v)], first.schema), part, ["d", "k"], ["d"], pbase)
    gone = tables.expire_versions(spark, part, pbase, keep_hours=-1)
    assert len([g for g in gone if g.startswith("v-")]) == 1  # the first version still holds one partition
    assert _rows(spark.table(part).select("d", "k", "v")) == [(1, 1, "a"), (2, 1, "y")]


def test_partitioned_publications_conflict_and_are_finished(spark, tmp_dir, monkeypatch):
    name, base, keys = "strata_cas_parts", tmp_dir + "/p", ["d", "k"]
    schema = "d int, k long, v string"
    run = lambda rows: tables.upsert_partitioned_table(spark, spark.createDataFrame(rows, schema), name, keys, ["d"], base)
    run([(1, 1, "a"), (2, 1, "b")])
    real = merge.upsert
    with monkeypatch.context() as m:
        pending = [lambda: run([(2, 5, "other")])]

        def upsert(*a, **kw):
            if pending:
                pending.pop()()
            return real(*a, **kw)

        m.setattr(tables.merge, "upsert", upsert)
        with pytest.raises(versions.PublishConflict):
            run([(2, 6, "late")])
    got = lambda: _rows(spark.table(name).select("d", "k", "v"))
    assert got() == [(1, 1, "a"), (2, 1, "b"), (2, 5, "other")]
    with monkeypatch.context() as m:
        m.setattr(tables, "_repoint", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run([(1, 1, "A")])
    with pytest.raises(versions.PublishConflict, match="finish_publication"):
        run([(1, 2, "z")])
    tables.finish_publication(spark, name, ["d"], base)
    run([(1, 2, "z")])
    assert got() == [(1, 1, "A"), (1, 2, "z"), (2, 1, "b"), (2, 5, "other")]
