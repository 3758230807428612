"""Landed trip pages take little space, and the jobs over them give every row and every broken line."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import views
from strata.workspace import shared_dir
from tests.oracle_harness import compare, duck

ROWS = 3000


@pytest.fixture()
def items(spark, tmp_dir):
    i = F.col("id")
    rows = spark.range(ROWS).select(
        i.alias("l_orderkey"), (i * 7 % 1009).alias("l_partkey"), (i % 101).alias("l_suppkey"), (i % 7 + 1).cast("int").alias("l_linenumber"),
        (i % 50).cast("double").alias("l_quantity"), (i * 997 % 100003 / 4).alias("l_extendedprice"), (i % 11 / 100).alias("l_discount"),
        (i % 9 / 100).alias("l_tax"), F.when(i % 3 == 0, "N").when(i % 3 == 1, "R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.expr("timestamp_ntz'1994-11-01 00:00:00' + make_dt_interval(int(id % 900))").alias("l_shipdate"),
    )
    rows.coalesce(1).write.parquet(tmp_dir + "/items")
    os.makedirs(tmp_dir + "/sf")
    os.rename(glob.glob(tmp_dir + "/items/*.parquet")[0], tmp_dir + "/sf/lineitem.parquet")
    return tmp_dir + "/sf"


def _pages_of(spark, items, name):
    """The pages that a query landed, once it was found to give what its SQL does."""
    import __spark_entry__ as e

    folders = shared_dir(spark).removeprefix("file:") + "/strata/trip-pages-*"
    before = set(glob.glob(folders))
    ok, what = compare(spark, duck(items), name, items, e.queries()[name], e.oracle_sql()[name])
    assert ok, what
    (folder,) = set(glob.glob(folders)) - before
    return glob.glob(folder + "/part-*")


def test_bronze_range_lands_small_pages(spark, items, monkeypatch):
    monkeypatch.setattr(views, "PAGE_RECORDS", 500, raising=False)
    pages = _pages_of(spark, items, "taxi_bronze_range")
    assert sum(os.path.getsize(p) for p in pages) < 100 * ROWS  # as plain text 458 bytes a row
    lines = [sum(1 for _ in gzip.open(p)) for p in pages]
    assert max(lines) <= 500 and sum(lines) == ROWS + ROWS // 7


def test_broken_lines_land_small_pages(spark, items):
    pages = _pages_of(spark, items, "taxi_broken_lines")
    assert sum(os.path.getsize(p) for p in pages) < 100 * ROWS
