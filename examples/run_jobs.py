"""Run the three projects end to end on the test tables, as a user would.

    python examples/run_jobs.py /root/testdata/sf0.001

Input files are derived from the test tables (the price list as fixed-width text, the sales
extracts as ``;`` CSV, the trips as JSON pages); every table is written under the session's
shared checkpoint folder. Prints the three top-5 trip reports.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from strata.plans import jobs, sales, views  # noqa: E402
from strata.plans.prices import TEN_DIGIT  # noqa: E402
from strata.workspace import scratch_path  # noqa: E402


def main(sf_dir: str) -> None:
    spark = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.icu.caseMappings.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "example-lake")
    lake = jobs.Lake(spark, root)
    jobs.create_layers(lake, ["ex_bronze", "ex_silver", "ex_gold"])

    # price list: fixed-width text -> bronze price table
    price_txt = root + "/landing/prices"
    views.price_lines_from_part(views.table(spark, sf_dir, "part")).write.text(price_txt)
    prices = jobs.price_job(lake, price_txt, "ex_bronze.fa_preco_produto", TEN_DIGIT)
    print("price rows:", prices.count())

    # sales star schema: CSV extracts -> bronze tables -> silver -> gold
    extracts = {
        "di_produto": views.product_bronze_rows(views.table(spark, sf_dir, "part")),
        "di_regiao": views.region_bronze_rows(views.table(spark, sf_dir, "supplier"), views.table(spark, sf_dir, "nation")),
        "fa_venda": views.sales_bronze_rows(views.table(spark, sf_dir, "lineitem")),
    }
    for name, rows in extracts.items():
        path = f"{root}/landing/{name}"
        rows.write.option("header", True).option("sep", ";").csv(path)
        jobs.csv_bronze_job(lake, "ex_bronze", name, path)
    jobs.dimension_silver_job(lake, "ex_bronze.di_produto", "ex_silver.di_produto", sales.PRODUCT_COLUMNS, sales.PRODUCT_KEY)
    jobs.dimension_silver_job(lake, "ex_bronze.di_regiao", "ex_silver.di_regiao", sales.REGION_COLUMNS, sales.REGION_KEY)
    jobs.fact_silver_job(lake, "ex_bronze.fa_venda", "ex_silver.fa_venda")
    jobs.dimension_gold_job(lake, "ex_silver.di_produto", "ex_gold.di_produto", sales.PRODUCT_COLUMNS, sales.PRODUCT_KEY)
    jobs.dimension_gold_job(lake, "ex_silver.di_regiao", "ex_gold.di_regiao", sales.REGION_COLUMNS, sales.REGION_KEY)
    jobs.calendar_job(lake, "ex_gold.di_tempo")
    fact = jobs.fact_gold_job(lake, "ex_silver.fa_venda", "ex_gold.fa_venda")
    print("gold fact rows:", fact.count())

    # trips: JSON pages -> bronze -> typed silver -> quality classes -> marts -> reports
    pages = root + "/landing/trips"
    trips_text = views.raw_trips(spark, sf_dir)
    trips_text.write.json(pages)
    bronze = jobs.taxi_bronze_job(lake, pages, "ex_bronze.trips")
    jobs.taxi_silver_job(lake, bronze, "ex_silver.trips", views_contract())
    print("quality classes:", jobs.taxi_quality_job(lake, "ex_silver.trips", "ex_silver.trips"))
    jobs.taxi_gold_job(lake, "ex_silver.trips_valid", "ex_gold.taxi_daily", "ex_gold.taxi_zones", views.TRIP_SCALES)
    for name, report in jobs.taxi_reports(lake, "ex_gold.taxi_daily", "ex_gold.taxi_zones").items():
        print(name)
        report.show(truncate=False)
    spark.stop()


def views_contract():
    from pyspark.sql import types as T

    from strata.plans import taxi

    return taxi.trip_contract(T.TimestampNTZType())


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
