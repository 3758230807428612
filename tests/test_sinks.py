"""Table sinks: versioned writes, create-or-merge, refresh, one-pass quality split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import taxi
from strata.sinks import tables
from strata.sources import tables as catalog


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_create_then_upsert_then_refresh(spark, tmp_dir):
    catalog.ensure_layers(spark, catalog.layer_names("strata_t"))
    name = "strata_t_silver.di_produto"
    first = spark.createDataFrame([(1, "a"), (2, "b")], "codigo_produto long, d string")
    tables.upsert_table(spark, first, name, ["codigo_produto"], tmp_dir + "/di_produto")
    assert catalog.table_exists(spark, name)
    second = spark.createDataFrame([(2, "B"), (3, "c")], "codigo_produto long, d string")
    tables.upsert_table(spark, second, name, ["codigo_produto"], tmp_dir + "/di_produto")
    assert _rows(spark.table(name)) == [(1, "a"), (2, "B"), (3, "c")]
    tables.insert_new_table(spark, spark.createDataFrame([(3, "x"), (4, "d")], "codigo_produto long, d string"), name, ["codigo_produto"], tmp_dir + "/di_produto")
    assert _rows(spark.table(name)) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    tables.refresh_table(spark, spark.createDataFrame([(9, "z")], "codigo_produto long, d string"), name, tmp_dir + "/di_produto")
    assert _rows(spark.table(name)) == [(9, "z")]
    tables.delete_all_table(spark, name, tmp_dir + "/di_produto")
    assert spark.table(name).count() == 0 and spark.table(name).columns == ["codigo_produto", "d"]


def test_overwrite_table(spark, tmp_dir):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    tables.overwrite_table(df, "strata_overwrite_t", path=tmp_dir + "/ow")
    tables.overwrite_table(df.filter("id < 2"), "strata_overwrite_t", path=tmp_dir + "/ow")
    assert spark.table("strata_overwrite_t").count() == 2


def test_quality_split_one_write(spark, tmp_dir):
    t = dt.datetime(2023, 1, 5)
    base = (1, t, t, 1.0, 2.0, 1.0, "n", 1, 2, 1, 10.0, 0.0, 0.5, 1.0, 0.0, 0.3)
    rows = [base + (12.0, 2.5, 0.0), base + (5.0, 2.5, 0.0), (None,) + base[1:] + (12.0, 2.5, 0.0)]
    trips = spark.createDataFrame(rows, taxi.TRIP_CONTRACT)
    counts = tables.write_quality_split(taxi.classify_trips(trips), tmp_dir + "/split")
    assert counts == {"total": 3, "valid": 1, "invalid": 1, "unclassified": 0, "removed": 1}
    removed = tables.read_quality_class(spark, tmp_dir + "/split", "removed", trips.columns)
    assert removed.count() == 1
    plan = removed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quality_class" in plan


def test_partitioned_upsert_rewrites_only_touched(spark, tmp_dir):
    name = "strata_part_fact"
    first = spark.createDataFrame(
        [(1, 20210101, 5.0), (2, 20210101, 6.0), (1, 20210102, 7.0)], "p long, d long, v double"
    )
    tables.upsert_partitioned_table(spark, first, name, ["p", "d"], ["d"], tmp_dir + "/fact")
    locs = {r[0]: r for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert set(locs) == {"d=20210101", "d=20210102"}

    def location(part):
        return spark.sql(f"DESCRIBE FORMATTED {name} PARTITION ({part})").filter("col_name = 'Location'").first()[1]

    before = location("d = 20210102")
    src = spark.createDataFrame([(2, 20210101, 60.0), (3, 20210103, 8.0)], "p long, d long, v double")
    touched = tables.upsert_partitioned_table(spark, src, name, ["p", "d"], ["d"], tmp_dir + "/fact")
    assert sorted(t["d"] for t in touched) == ["20210101", "20210103"]
    assert location("d = 20210102") == before  # untouched partition keeps its files
    assert _rows(spark.table(name).select("p", "d", "v")) == [
        (1, 20210101, 5.0), (1, 20210102, 7.0), (2, 20210101, 60.0), (3, 20210103, 8.0)
    ]


def test_partitioned_upsert_with_text_and_date_partitions(spark, tmp_dir):
    import datetime as dt

    name = "strata_part_text"
    first = spark.createDataFrame(
        [("a:b", dt.date(2021, 1, 1), 1, "x"), ("c d", dt.date(2021, 1, 2), 2, "y")],
        "region string, day date, k long, v string",
    )
    keys = ["region", "day", "k"]
    tables.upsert_partitioned_table(spark, first, name, keys, ["region", "day"], tmp_dir + "/pt")
    src = spark.createDataFrame([("a:b", dt.date(2021, 1, 1), 1, "X"), ("e=f", dt.date(2021, 1, 3), 3, "z")], first.schema)
    tables.upsert_partitioned_table(spark, src, name, keys, ["region", "day"], tmp_dir + "/pt")
    got = sorted((r["region"], r["k"], r["v"]) for r in spark.table(name).collect())
    assert got == [("a:b", 1, "X"), ("c d", 2, "y"), ("e=f", 3, "z")]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 3


def test_partitioned_upsert_keeps_boolean_partitions(spark, tmp_dir):
    first = spark.createDataFrame([(True, 1, "a"), (False, 2, "b")], "p boolean, k long, v string")
    keys = ["p", "k"]
    tables.upsert_partitioned_table(spark, first, "strata_part_bool", keys, ["p"], tmp_dir + "/pb")
    src = spark.createDataFrame([(False, 3, "c"), (False, 2, "B")], first.schema)
    tables.upsert_partitioned_table(spark, src, "strata_part_bool", keys, ["p"], tmp_dir + "/pb")
    assert _rows(spark.table("strata_part_bool").select("p", "k", "v")) == [(False, 2, "B"), (False, 3, "c"), (True, 1, "a")]


@pytest.mark.parametrize("kind, value", [("double", 1e20), ("timestamp", dt.datetime(2021, 1, 1, 0, 0, 0, 5)), ("string", ""), ("string", None)])
def test_partitions_that_cannot_hold_the_value_are_refused(spark, tmp_dir, kind, value):
    src = spark.createDataFrame([(value, 1)], f"p {kind}, k long")
    with pytest.raises(ValueError):
        tables.upsert_partitioned_table(spark, src, "strata_part_refused", ["p", "k"], ["p"], tmp_dir + "/pr")
    assert not catalog.table_exists(spark, "strata_part_refused")


def test_failed_repoint_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    first = spark.createDataFrame([("a", 1, "x"), ("c", 2, "y")], "p string, k long, v string")
    keys = ["p", "k"]
    tables.upsert_partitioned_table(spark, first, "strata_part_fail", keys, ["p"], tmp_dir + "/pf")
    before = _rows(spark.table("strata_part_fail"))
    text = tables._sql_text
    monkeypatch.setattr(tables, "_sql_text", lambda v: "broken" if str(v).endswith("/p=n") else text(v))
    src = spark.createDataFrame([("a", 1, "X"), ("n", 9, "z")], first.schema)
    with pytest.raises(Exception):
        tables.upsert_partitioned_table(spark, src, "strata_part_fail", keys, ["p"], tmp_dir + "/pf")
    assert _rows(spark.table("strata_part_fail")) == before


def test_partitioned_upsert_reads_only_touched_partitions(spark, tmp_dir, monkeypatch):
    days = [(d, k, "x") for d in range(1, 21) for k in range(3)]
    first = spark.createDataFrame(days, "d int, k long, v string")
    tables.upsert_partitioned_table(spark, first, "strata_part_prune", ["d", "k"], ["d"], tmp_dir + "/pp")
    seen = []
    real = tables.merge.upsert
    monkeypatch.setattr(tables.merge, "upsert", lambda t, s, k, check=True: seen.append(t._jdf.queryExecution().executedPlan().toString()) or real(t, s, k, check=check))
    src = spark.createDataFrame([(7, 1, "Y"), (21, 1, "n")], first.schema)
    tables.upsert_partitioned_table(spark, src, "strata_part_prune", ["d", "k"], ["d"], tmp_dir + "/pp")
    (plan,) = seen
    assert "InMemoryFileIndex(1 paths)" in plan and "dynamicpruning" not in plan and "Exchange" not in plan


def test_versions_refuse_another_schema(spark, tmp_dir):
    tables.write_version(spark, spark.createDataFrame([(1, "a")], "k long, v string"), "strata_schema", tmp_dir + "/s")
    for other in (spark.createDataFrame([(1, "a", 2)], "k long, v string, w int"), spark.createDataFrame([(1, 2)], "k long, v int")):
        with pytest.raises(ValueError):
            tables.write_version(spark, other, "strata_schema", tmp_dir + "/s")
    assert _rows(spark.table("strata_schema")) == [(1, "a")]


def test_table_exists_ignores_temporary_views(spark):
    spark.range(1).createOrReplaceTempView("strata_only_a_view")
    assert not catalog.table_exists(spark, "strata_only_a_view")


def test_insert_new_appends_to_the_version(spark, tmp_dir):
    name, base = "strata_append", tmp_dir + "/ap"
    first = tables.insert_new_table(spark, spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string"), name, ["k"], base)
    files = set(spark.table(name).inputFiles())
    src = spark.createDataFrame([("x", 1), ("b", 2), ("b", 2), ("m", None)], "v string, k long")  # other column order
    second = tables.insert_new_table(spark, src, name, ["k"], base)
    assert second.endswith(first) and files < set(spark.table(name).inputFiles())
    got = sorted(((r.k or 0), r.v) for r in spark.table(name).collect())
    assert got == [(0, "m"), (0, "n"), (1, "a"), (2, "b"), (2, "b")]
