"""Incremental landing: each page file is ingested exactly once."""

import os

from pyspark.sql import types as T

from strata.streaming.landing import ingest_pages

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])


def test_ingest_only_new_pages(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "page-0.json"), "w") as fh:
        fh.write('{"id": "1", "v": "a"}\n{"id": "2"}\n')
    bronze, ckpt = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "ckpt")
    assert ingest_pages(spark, land, SCHEMA, bronze, ckpt).count() == 2
    with open(os.path.join(land, "page-1.json"), "w") as fh:
        fh.write('{"id": "3", "v": "c"}\n')
    out = ingest_pages(spark, land, SCHEMA, bronze, ckpt)
    assert sorted(tuple(r) for r in out.collect()) == [("1", "a"), ("2", None), ("3", "c")]
    # a run with nothing new changes nothing
    assert ingest_pages(spark, land, SCHEMA, bronze, ckpt).count() == 3


def test_empty_landing_gives_empty_table(spark, tmp_dir):
    land = os.path.join(tmp_dir, "empty-landing")
    os.makedirs(land)
    out = ingest_pages(spark, land, SCHEMA, os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "c"))
    assert out.count() == 0 and out.schema == SCHEMA


def test_stream_quality_split_appends_new_bronze_only(spark, tmp_dir):
    from pyspark.sql import functions as F

    from strata.plans import jobs, taxi
    from strata.streaming.landing import stream_quality_split

    def trip(vendor, total):
        return {f.name: None for f in jobs.TRIP_TEXT.fields} | {
            "VendorID": vendor, "tpep_pickup_datetime": "2023-01-01T08:00:00", "passenger_count": "1",
            "trip_distance": "2", "fare_amount": "10", "tip_amount": "1", "tolls_amount": "0",
            "extra": "0", "total_amount": total, "store_and_fwd_flag": "n",
        }

    bronze = os.path.join(tmp_dir, "bronze")
    spark.createDataFrame([trip("1", "12"), trip("1", "5")], jobs.TRIP_TEXT).write.parquet(bronze)
    out, ckpt = os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "ckpt-q")
    res = stream_quality_split(spark, bronze, jobs.TRIP_TEXT, taxi.classify_trips, out, ckpt, taxi.TRIP_CONTRACT)
    assert {r["quality_class"]: r["n"] for r in res.groupBy("quality_class").agg(F.count("*").alias("n")).collect()} == {"valid": 1, "invalid": 1}
    spark.createDataFrame([trip(None, "12")], jobs.TRIP_TEXT).write.mode("append").parquet(bronze)
    res = stream_quality_split(spark, bronze, jobs.TRIP_TEXT, taxi.classify_trips, out, ckpt, taxi.TRIP_CONTRACT)
    got = {r["quality_class"]: r["n"] for r in res.groupBy("quality_class").agg(F.count("*").alias("n")).collect()}
    assert got == {"valid": 1, "invalid": 1, "removed": 1}
    assert res.filter("quality_class = 'valid'").first()["store_and_fwd_flag"] == "N"


def _page(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_every_landed_line_is_in_exactly_one_output(spark, tmp_dir):
    from strata.streaming.landing import broken_lines

    land, bronze, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ckpt"))
    _page(land, "p0.json", ['{"id": "1", "v": "a"}', '{"id": "2", "v"', "", "[1, 2", '{"id": null}'])
    rows = ingest_pages(spark, land, SCHEMA, bronze, ckpt)
    assert sorted(map(tuple, rows.collect()), key=str) == [("1", "a"), (None, None)]
    _page(land, "p1.json", ['{"id": "2", "v"', '{"id": "3"}'])
    rows = ingest_pages(spark, land, SCHEMA, bronze, ckpt)
    assert rows.columns == ["id", "v"] and rows.count() == 3
    got = sorted(r.corrupt_line for r in broken_lines(spark, bronze, SCHEMA).collect())
    assert got == ["[1, 2", '{"id": "2", "v"', '{"id": "2", "v"']


def test_run_that_breaks_off_lands_each_line_once(spark, tmp_dir):
    """The sink's commit of a batch covers rows and broken lines; a batch whose commit is lost runs again."""
    import shutil

    from strata.streaming.landing import broken_lines

    land, bronze, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ckpt"))
    _page(land, "p0.json", ['{"id": "1"}', "broken"])
    ingest_pages(spark, land, SCHEMA, bronze, ckpt)
    _page(land, "p1.json", ['{"id": "2"}', "broken too"])
    ingest_pages(spark, land, SCHEMA, bronze, ckpt)
    # as if the driver had died after the files of batch 1 were written and before it was committed
    for log in (os.path.join(ckpt, "commits"), os.path.join(bronze, "_spark_metadata")):
        for name in ("1", ".1.crc"):
            if os.path.exists(os.path.join(log, name)):
                shutil.move(os.path.join(log, name), os.path.join(tmp_dir, f"lost-{os.path.basename(log)}-{name}"))
    rows = ingest_pages(spark, land, SCHEMA, bronze, ckpt)
    assert sorted(r.id for r in rows.collect()) == ["1", "2"]
    assert sorted(r.corrupt_line for r in broken_lines(spark, bronze, SCHEMA).collect()) == ["broken", "broken too"]


def test_overlapping_pages_land_each_row_once(spark, tmp_dir):
    land, bronze, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ckpt"))
    _page(land, "p0.json", ['{"id": "1", "v": "a"}', '{"id": "2", "v": "b"}', '{"id": "2", "v": "b"}'])
    ingest_pages(spark, land, SCHEMA, bronze, ckpt, unique_on=["ID", "v"])
    _page(land, "p1.json", ['{"id": "2", "v": "b"}', '{"id": "2", "v": "c"}', '{"id": "3"}', '{"id": "3"}'])
    rows = ingest_pages(spark, land, SCHEMA, bronze, ckpt, unique_on=["ID", "v"])
    assert sorted(map(tuple, rows.collect()), key=str) == [("1", "a"), ("2", "b"), ("2", "c"), ("3", None)]


def test_time_range_reads_its_days_only(spark, tmp_dir):
    from strata.streaming.landing import rows_between

    schema = T.StructType([T.StructField("ts", T.StringType()), T.StructField("v", T.StringType())])
    land, bronze = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "bronze")
    _page(land, "p0.json", [f'{{"ts": "2023-01-{d:02d}T{h:02d}:00:00", "v": "{d}"}}' for d in range(1, 21) for h in (0, 23)] + ['{"v": "none"}', '{"ts": "x"}', "bad"])
    all_rows = ingest_pages(spark, land, schema, bronze, date_of="ts", grain="day")
    assert all_rows.count() == 42
    got = rows_between(spark, bronze, schema, "ts", "2023-01-05T12:00:00", "2023-01-07T00:00:00")
    assert sorted(r.ts for r in got.collect()) == ["2023-01-05T23:00:00", "2023-01-06T00:00:00", "2023-01-06T23:00:00", "2023-01-07T00:00:00"]
    plan = got._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "landed_date" in text.split("PartitionFilters: [")[1].split("]")[0]
    scan = plan.collectLeaves().head()
    assert scan.metrics().get("numPartitions").get().value() == 3


def test_landing_refuses_columns_it_makes(spark, tmp_dir):
    import pytest

    with pytest.raises(ValueError):
        ingest_pages(spark, tmp_dir, T.StructType([T.StructField("Landed_As", T.StringType())]), tmp_dir + "/b")


def test_multiline_pages_and_a_broken_file(spark, tmp_dir):
    from strata.streaming.landing import broken_lines

    land, bronze = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "bronze")
    _page(land, "p0.json", ['[{"id": "1",', '"v": "a"}, {"id": "2"}]'])
    _page(land, "p1.json", ['[{"id": "3"'])
    rows = ingest_pages(spark, land, SCHEMA, bronze, multiline=True)
    assert sorted(r.id for r in rows.collect()) == ["1", "2"]
    assert [r.corrupt_line.strip() for r in broken_lines(spark, bronze, SCHEMA).collect()] == ['[{"id": "3"']


def test_broken_page_fails_the_run_if_asked(spark, tmp_dir):
    import pytest

    land, bronze, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ckpt"))
    _page(land, "p0.json", ['{"id": "1"}', '{"id": "2", "v"'])
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        ingest_pages(spark, land, SCHEMA, bronze, ckpt, on_broken="fail")
    _page(land, "p0.json", ['{"id": "1"}', '{"id": "2", "v": "b"}'])
    assert ingest_pages(spark, land, SCHEMA, bronze, ckpt, on_broken="fail").count() == 2
    with pytest.raises(ValueError):
        ingest_pages(spark, land, SCHEMA, bronze, ckpt, on_broken="drop")
