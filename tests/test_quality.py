"""Trip quality classes on the hand-made rows of FIXTURES §6."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans import taxi

PICK = dt.datetime(2023, 2, 1, 8, 30)


def _trip(vendor=1, dist=2.0, pax=1.0, fare=10.0, tip=1.0, total=12.0):
    return (vendor, PICK, PICK, pax, dist, 1.0, "n", 10, 20, 1, fare, 0.0, 0.5, tip, 0.0, 0.3, total, 2.5, 0.0)


ROWS = {
    "a": _trip(),
    "b": _trip(total=11.0),
    "c": _trip(total=5.0),
    "d": _trip(tip=None),
    "e": _trip(dist=0.0),
    "e2": _trip(dist=0.0),
    "f": _trip(dist=None),
    "g": _trip(pax=0.0),
    "h": _trip(fare=-1.0),
    "i": _trip(fare=0.0, tip=0.0, total=0.0),
    "j": _trip(vendor=None),
}


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(list(ROWS.values()), taxi.TRIP_CONTRACT)


def test_class_counts(trips):
    got = {r["quality_class"]: r["n"] for r in taxi.classify_trips(trips).groupBy("quality_class").agg(F.count("*").alias("n")).collect()}
    assert got == {"valid": 3, "invalid": 1, "unclassified": 1, "removed": 6}


def test_removed_distinct_matches_subtract(trips):
    clean = quality.quality_filter(trips, taxi.keep_rules())
    expected = sorted(map(tuple, trips.subtract(clean).collect()), key=repr)
    got = sorted(map(tuple, taxi.removed_trips_distinct(trips).collect()), key=repr)
    assert got == expected
    assert len(got) == 5
    assert taxi.removed_trips_all(trips).count() == 6


def test_report_reconciles(trips):
    rep = {r["measure"]: r["rows"] for r in taxi.trip_quality_report(trips).collect()}
    assert rep == {
        "total": 11, "valid": 3, "invalid": 1, "unclassified": 1, "removed": 6,
        "removed_distinct": 5, "three_table_sum": 9,
    }
    # the four classes partition the input
    assert rep["valid"] + rep["invalid"] + rep["unclassified"] + rep["removed"] == rep["total"]


def test_classes_carry_expected_columns(trips):
    valid = taxi.valid_trips(trips)
    assert valid.columns == taxi.TRIP_COLUMNS + ["pickup_year", "pickup_month", "pickup_day", "total_amount_check"]
    row = valid.filter(F.col("total_amount") == 12.0).first()
    assert row["store_and_fwd_flag"] == "N" and row["pickup_year"] == 2023 and row["pickup_day"] == 1
    removed = taxi.trips_of_class(trips, quality.REMOVED)
    assert removed.columns == taxi.TRIP_COLUMNS
    assert {r["store_and_fwd_flag"] for r in removed.collect()} == {"n"}  # not normalised


def test_classify_is_one_pass(trips):
    plan = taxi.classify_trips(trips)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_split_by_rule(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "ok boolean")
    v, i, u = quality.split_by_rule(df, "ok")
    assert (v.count(), i.count(), u.count()) == (1, 1, 1)


def test_filter_pushed_to_parquet(spark, tmp_dir, trips):
    trips.write.parquet(tmp_dir + "/t")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    df = quality.quality_filter(spark.read.parquet(tmp_dir + "/t"), taxi.keep_rules())
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    for f in ("IsNotNull(tpep_pickup_datetime)", "IsNotNull(VendorID)", "GreaterThan(trip_distance,0.0)",
              "GreaterThan(passenger_count,0.0)", "GreaterThanOrEqual(fare_amount,0.0)"):
        assert f in pushed, pushed


def test_removed_all_and_clean_partition_input(trips):
    from collections import Counter

    clean = quality.quality_filter(trips, taxi.keep_rules())
    both = Counter(map(tuple, clean.collect())) + Counter(map(tuple, taxi.removed_trips_all(trips).collect()))
    assert both == Counter(map(tuple, trips.collect()))


def test_quality_report_is_one_scan_one_shuffle(trips, spark, tmp_dir):
    trips.write.parquet(tmp_dir + "/t2")
    rep = taxi.trip_quality_report(spark.read.parquet(tmp_dir + "/t2"))
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_add_rule_is_null_propagating(spark):
    df = spark.createDataFrame([(5.0, 1.0), (1.0, 5.0), (None, 1.0)], "total double, part double")
    out = quality.add_rule(df, "ok", F.col("total") >= F.col("part"))
    assert [r["ok"] for r in out.collect()] == [True, False, None]
