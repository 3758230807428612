"""End-to-end jobs over small own fixtures: files in, versioned tables out."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs, prices, sales
from tests.test_sales import SALES
from tests.test_sources import LINES


def _write(path, text, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as fh:
        fh.write(text)
    return path


def test_sales_star(spark, tmp_dir):
    lake = jobs.Lake(spark, tmp_dir + "/lake")
    jobs.create_layers(lake, ["j_bronze", "j_silver", "j_gold"])
    prod = _write(tmp_dir + "/p.csv", "CODIGO_PRODUTO;DESCRICAO_PRODUTO;SIGLA_PRODUTO\r\n" + "".join(f"{101 + 3 * i};P{i};S{i}\r\n" for i in range(7)), bom=True)
    reg = _write(tmp_dir + "/r.csv", "CODIGO_REGIAO;DESCRICAO_REGIAO;NOME_PAIS\r\n" + "".join(f"{201 + 3 * i};R{i};BR\r\n" for i in range(4)), bom=True)
    fact = _write(tmp_dir + "/v.csv", "CODIGO_PRODUTO;CODIGO_REGIAO;DATA_VENDA;QTDE_VENDA;VALOR_VENDA\r\n" + "".join(f"{p};{r};{d};{q};{999 * int(q)}\r\n" for p, r, d, q in SALES), bom=True)
    for t, p in (("di_produto", prod), ("di_regiao", reg), ("fa_venda", fact)):
        jobs.csv_bronze_job(lake, "j_bronze", t, p)
    d1 = jobs.dimension_silver_job(lake, "j_bronze.di_produto", "j_silver.di_produto", sales.PRODUCT_COLUMNS, sales.PRODUCT_KEY)
    assert d1.count() == 7 and d1.schema["codigo_produto"].dataType.simpleString() == "bigint"
    jobs.dimension_silver_job(lake, "j_bronze.di_regiao", "j_silver.di_regiao", sales.REGION_COLUMNS, sales.REGION_KEY)
    # a second run upserts: same keys, fresh stamps, no duplicates
    again = jobs.dimension_silver_job(lake, "j_bronze.di_produto", "j_silver.di_produto", sales.PRODUCT_COLUMNS, sales.PRODUCT_KEY)
    assert again.count() == 7
    assert jobs.dimension_gold_job(lake, "j_silver.di_regiao", "j_gold.di_regiao", sales.REGION_COLUMNS, sales.REGION_KEY).count() == 4
    s = jobs.fact_silver_job(lake, "j_bronze.fa_venda", "j_silver.fa_venda")
    assert jobs.fact_silver_job(lake, "j_bronze.fa_venda", "j_silver.fa_venda").count() == s.count() == 14
    g = jobs.fact_gold_job(lake, "j_silver.fa_venda", "j_gold.fa_venda", run_ts="2024-01-01 00:00:00")
    g2 = jobs.fact_gold_job(lake, "j_silver.fa_venda", "j_gold.fa_venda", run_ts="2024-01-02 00:00:00")
    assert g2.count() == 14
    assert g2.agg(F.max("data_atualizacao")).first()[0] == dt.datetime(2024, 1, 2)
    gp = jobs.fact_gold_job(lake, "j_silver.fa_venda", "j_gold.fa_venda_p", partition_by=["id_data_venda"])
    gp2 = jobs.fact_gold_job(lake, "j_silver.fa_venda", "j_gold.fa_venda_p", partition_by=["id_data_venda"])
    assert gp.count() == gp2.count() == 14
    cal = jobs.calendar_job(lake, "j_gold.di_tempo", "2021-01-01", "2022-01-01")
    assert cal.count() == 365
    assert jobs.calendar_job(lake, "j_gold.di_tempo", "2021-01-01", "2022-01-01").count() == 365
    # every fact date key finds its calendar row
    assert g.join(cal, g.id_data_venda == cal.id_data, "left_anti").count() == 0


def test_price_job(spark, tmp_dir):
    lake = jobs.Lake(spark, tmp_dir + "/lake")
    jobs.create_layers(lake, ["p_bronze"])
    path = _write(tmp_dir + "/precos.txt", "\n".join(LINES) + "\n")
    t1 = jobs.price_job(lake, path, "p_bronze.fa_preco_produto", prices.TEN_DIGIT)
    t2 = jobs.price_job(lake, path, "p_bronze.fa_preco_produto", prices.TEN_DIGIT)
    assert t1.count() == t2.count() == 3


def test_taxi_jobs(spark, tmp_dir):
    lake = jobs.Lake(spark, tmp_dir + "/lake")
    jobs.create_layers(lake, ["tx"])
    land = tmp_dir + "/landing"
    os.makedirs(land)

    def trip(i, pick, tip="1.0", total="12.0", dist="2.0"):
        d = {"VendorID": "1", "tpep_pickup_datetime": pick, "tpep_dropoff_datetime": pick, "passenger_count": "1",
             "trip_distance": dist, "RatecodeID": "1", "store_and_fwd_flag": "n", "PULocationID": str(100 + i % 2),
             "DOLocationID": "7", "payment_type": "1", "fare_amount": "10.0", "extra": "0", "mta_tax": "0.5",
             "tip_amount": tip, "tolls_amount": "0", "improvement_surcharge": "0.3", "total_amount": total,
             "congestion_surcharge": "2.5"}
        if tip is None:
            del d["tip_amount"]
        return json.dumps(d)

    _write(land + "/page-0.json", "\n".join([
        trip(0, "2023-01-01T00:00:00.000"), trip(1, "2023-01-01T10:00:00.000", total="5.0"),
        trip(2, "2023-01-02T10:00:00.000", tip=None), trip(3, "2023-01-02T11:00:00.000", dist="0"),
        trip(4, "2023-05-01T00:00:00.000"),
    ]) + "\n")
    bronze = jobs.taxi_bronze_job(lake, land, "tx.bronze_trips", "2023-01-01T00:00:00", "2023-04-30T23:59:59")
    assert bronze.count() == spark.table("tx.bronze_trips").count() == 4
    # another range over the same landed pages, and back
    assert jobs.taxi_bronze_job(lake, land, "tx.bronze_trips", "2023-05-01T00:00:00", "2023-05-31T00:00:00").count() == 1
    bronze = jobs.taxi_bronze_job(lake, land, "tx.bronze_trips", "2023-01-01T00:00:00", "2023-04-30T23:59:59")
    assert spark.table("tx.bronze_trips").count() == 4
    silver = jobs.taxi_silver_job(lake, bronze, "tx.silver_trips")
    assert silver.schema["trip_distance"].dataType.simpleString() == "double"
    counts = jobs.taxi_quality_job(lake, "tx.silver_trips", "tx.trips")
    assert counts == {"total": 4, "valid": 1, "invalid": 1, "unclassified": 1, "removed": 1}
    assert spark.table("tx.trips_valid").count() == 1
    assert spark.table("tx.trips_removed_distinct").count() == 1
    jobs.taxi_gold_job(lake, "tx.trips_valid", "tx.daily", "tx.zones")
    rep = jobs.taxi_reports(lake, "tx.daily", "tx.zones")
    top = rep["top_days_by_revenue"].collect()
    assert [(r["dia"], r["faturamento_total"]) for r in top] == [("2023-01-01", 12.0)]


def test_quality_job_with_empty_classes(spark, tmp_dir):
    lake = jobs.Lake(spark, tmp_dir + "/lake")
    jobs.create_layers(lake, ["tx_classes"])
    text = spark.createDataFrame([], jobs.TRIP_TEXT)
    jobs.taxi_silver_job(lake, text, "tx_classes.silver")
    counts = jobs.taxi_quality_job(lake, "tx_classes.silver", "tx_classes.trips")
    assert set(counts.values()) == {0}
    for _ in range(2):  # the second run repoints the tables
        jobs.taxi_quality_job(lake, "tx_classes.silver", "tx_classes.trips")
    names = [f.name for f in jobs.TRIP_TEXT.fields]
    assert spark.table("tx_classes.trips_removed").columns == names
    assert spark.table("tx_classes.trips_removed_distinct").columns == names
    valid = spark.table("tx_classes.trips_valid")
    assert valid.count() == 0 and len(valid.columns) == len(names) + 4


def test_taxi_bronze_range_needs_both_ends(spark, tmp_dir):
    with pytest.raises(ValueError):
        jobs.taxi_bronze_job(jobs.Lake(spark, tmp_dir), tmp_dir, "tx_half", lo="2023-01-01")


def test_taxi_bronze_with_nothing_landed(spark, tmp_dir):
    lake = jobs.Lake(spark, tmp_dir + "/lake")
    jobs.create_layers(lake, ["tx_empty"])
    land = tmp_dir + "/landing-empty"
    os.makedirs(land)
    bronze = jobs.taxi_bronze_job(lake, land, "tx_empty.bronze_trips")
    assert bronze.count() == 0 and bronze.columns == [f.name for f in jobs.TRIP_TEXT.fields]
