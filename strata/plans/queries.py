"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They wire the recipes in ``strata.plans`` to the test tables through the role views in
``strata.plans.views``. Names match ``strata.plans.oracle.ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import keys as _keys
from strata.operators import merge as _merge
from strata.operators import quality
from strata.operators import schema as _schema
from strata.operators import marts as _marts
from strata.operators.marts import rollup_fact
from strata.plans import jobs as _jobs
from strata.plans import prices as _prices
from strata.plans import sales as _sales
from strata.plans import taxi, views
from strata.sinks import tables as _sinks
from strata.sources import files as _files
from strata.sources import series as _series
from strata.sources import tables as _tables
from strata.streaming import landing as _landing
from strata.workspace import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---- trip quality -----------------------------------------------------------------------


@register
def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_filter(views.trips(spark, sf_dir), taxi.keep_rules())


@register
def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.valid_trips(views.trips(spark, sf_dir))


@register
def invalid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.invalid_trips(views.trips(spark, sf_dir))


@register
def unclassified_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.unclassified_trips(views.trips(spark, sf_dir))


@register
def removed_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.removed_trips_all(views.trips(spark, sf_dir))


@register
def removed_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.removed_trips_distinct(views.trips(spark, sf_dir))


@register
def removed_distinct_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The set difference over trips of which many are equal."""
    return taxi.removed_trips_distinct(views.repeated_trips(spark, sf_dir))


@register
def quality_report_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.trip_quality_report(views.repeated_trips(spark, sf_dir))


@register
def quality_report_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class counts where distances and totals may be NaN."""
    return taxi.trip_quality_report(views.mill_trips(spark, sf_dir, with_nan=True))


@register
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.trip_quality_report(views.trips(spark, sf_dir))


# ---- trip marts and reports -------------------------------------------------------------


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.valid_trips(views.trips(spark, sf_dir))


@register
def metrics_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.metrics_by_day(_valid(spark, sf_dir), views.TRIP_SCALES)


@register
def metrics_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.metrics_by_zone(_valid(spark, sf_dir), views.TRIP_SCALES)


MILL_SCALES = {c: 3 for c in views.TRIP_SCALES}


@register
def metrics_by_day_mills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of three decimals, some of them NaN (and so no valid trips)."""
    return taxi.metrics_by_day(taxi.valid_trips(views.mill_trips(spark, sf_dir, with_nan=True)), MILL_SCALES)


@register
def metrics_by_zone_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain ``round(sum)`` and ``round(avg)`` of doubles."""
    return taxi.metrics_by_zone(taxi.valid_trips(views.mill_trips(spark, sf_dir, with_nan=False)), exact=False)


@register
def top_days_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.top_days_by_revenue(metrics_by_day(spark, sf_dir))


@register
def top_zones_by_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.top_zones_by_trips(metrics_by_zone(spark, sf_dir))


@register
def top_zones_by_distance_tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.top_zones_by_distance_tip(metrics_by_zone(spark, sf_dir))


# ---- typed contract, parts, flags, time range --------------------------------------------

RUN_TS = "2024-01-01 00:00:00"
GOLD_RUN_TS = "2024-01-02 00:00:00"
TRIP_CONTRACT_NTZ = taxi.trip_contract(T.TimestampNTZType())


@register
def apply_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _schema.apply_schema(views.raw_trips(spark, sf_dir), TRIP_CONTRACT_NTZ)


@register
def schema_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rej = _schema.schema_rejects(views.raw_trips(spark, sf_dir), TRIP_CONTRACT_NTZ)
    return rej.select("DOLocationID", "payment_type", "VendorID", "trip_distance", "rejected_columns")


@register
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _schema.reject_counts(views.raw_trips(spark, sf_dir), TRIP_CONTRACT_NTZ)


@register
def pickup_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.pickup_parts(views.trips(spark, sf_dir))


@register
def normalize_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi.normalize_flag(views.trips(spark, sf_dir))


@register
def filter_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    return _files.filter_time_range(events, "ts", "2024-01-08T00:00:00", "2024-01-21T23:59:59")


# ---- sales fact, keys, calendar ------------------------------------------------------------


def _fact_silver_mem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales_silver_from_lineitem(views.table(spark, sf_dir, "lineitem"), RUN_TS)


@register
def fact_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_fact(_fact_silver_mem(spark, sf_dir), _sales.FACT_GRAIN, ["qtde_venda", "valor_venda"])


@register
def fact_rollup_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coarse grain: hundreds of rows per group."""
    return rollup_fact(_fact_silver_mem(spark, sf_dir), ["codigo_regiao"], ["qtde_venda", "valor_venda"])


@register
def fact_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales.gold_fact(_fact_silver_mem(spark, sf_dir), GOLD_RUN_TS, ntz=True)


@register
def fact_key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = fact_gold(spark, sf_dir)
    return _keys.key_collisions(
        gold, _sales.FACT_KEY, ["codigo_produto", "codigo_regiao", _sales.FACT_DATE_KEY]
    )


@register
def fact_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The concatenated key as text, which holds keys of any width."""
    gold = fact_gold(spark, sf_dir)
    grain = ["codigo_produto", "codigo_regiao", _sales.FACT_DATE_KEY]
    return gold.select(*grain, _keys.concat_key(grain, "string").alias("fact_key"))


@register
def fact_hash_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many facts there are, and how many different hash keys they have."""
    gold = fact_gold(spark, sf_dir)
    key = _keys.hash_key(["codigo_produto", "codigo_regiao", _sales.FACT_DATE_KEY])
    return gold.select(key.alias("fact_key")).agg(F.count("fact_key").alias("facts"), F.count_distinct("fact_key").alias("fact_keys"))


@register
def fact_padded_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = fact_gold(spark, sf_dir)
    return gold.select(
        "codigo_produto",
        "codigo_regiao",
        _sales.FACT_DATE_KEY,
        _keys.padded_key(["codigo_produto", "codigo_regiao", _sales.FACT_DATE_KEY], [10, 10, 8]).alias("fact_key"),
    )


@register
def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _series.calendar_over(views.table(spark, sf_dir, "lineitem"), "l_shipdate")
    return _sales.calendar_table(days, "day", GOLD_RUN_TS, ntz=True)


@register
def generate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series.series_over(views.table(spark, sf_dir, "events"), "ts", 3600, "hour")


# ---- table maintenance ---------------------------------------------------------------------


def _orders_versions(spark: SparkSession, sf_dir: str, null_keys: bool = False):
    """Yesterday's table (orders up to 1997) and today's extract (orders from 1997 on, with a
    new total); they overlap in 1997. With ``null_keys`` the low-priority orders carry no key."""
    o = views.table(spark, sf_dir, "orders")
    if null_keys:
        o = o.withColumn(
            "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderkey"))
        )
    since = lambda day: F.coalesce(F.col("o_orderdate") >= F.lit(day).cast("timestamp_ntz"), F.lit(False))
    target = o.filter(~since("1998-01-01"))  # undated orders belong to the old table
    source = o.filter(since("1997-01-01")).withColumn(
        "o_totalprice", F.col("o_totalprice") + F.lit(1.0)
    )
    return target, source


@register
def upsert_update_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = _orders_versions(spark, sf_dir)
    return _merge.upsert(t, s, ["o_orderkey"])


@register
def upsert_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = _orders_versions(spark, sf_dir)
    return _merge.insert_new(t, s, ["o_orderkey"])


@register
def upsert_repeated_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every target row twice: each copy takes the source's values."""
    t, s = _orders_versions(spark, sf_dir)
    return _merge.upsert(t.unionAll(t), s, ["o_orderkey"])


@register
def upsert_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = _orders_versions(spark, sf_dir, null_keys=True)
    return _merge.upsert(t, s, ["o_orderkey"])


@register
def refresh_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's table replaced by the whole orders with new totals."""
    t, _ = _orders_versions(spark, sf_dir)
    return _merge.refresh(t, views.table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)))


@register
def delete_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, _ = _orders_versions(spark, sf_dir)
    return _merge.delete_all(t)


# ---- file sources and sinks ----------------------------------------------------------------


def _price_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "price-list")
    views.price_lines_from_part(views.table(spark, sf_dir, "part")).write.text(path)
    return _files.scan_text(spark, path)


@register
def fixed_width_as_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prices.price_bronze(_price_lines(spark, sf_dir), _prices.AS_READ, RUN_TS, ntz=True)


@register
def fixed_width_ten_digit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prices.price_bronze(_price_lines(spark, sf_dir), _prices.TEN_DIGIT, RUN_TS, ntz=True)


@register
def fixed_width_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prices.price_rejects(_price_lines(spark, sf_dir), _prices.TEN_DIGIT)


def _csv_round_trip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.option("header", True).option("sep", ";").csv(path)
    return _files.scan_csv(spark, path, sep=";")


def _region_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.region_bronze_rows(views.table(spark, sf_dir, "supplier"), views.table(spark, sf_dir, "nation"))
    return _csv_round_trip(spark, rows, "region-csv")


def _product_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _csv_round_trip(spark, views.product_bronze_rows(views.table(spark, sf_dir, "part")), "product-csv")


@register
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _region_bronze(spark, sf_dir)


@register
def dim_product_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales.silver_dimension(_product_bronze(spark, sf_dir), _sales.PRODUCT_COLUMNS, _sales.PRODUCT_KEY, RUN_TS, ntz=True)


@register
def dim_region_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales.silver_dimension(_region_bronze(spark, sf_dir), _sales.REGION_COLUMNS, _sales.REGION_KEY, RUN_TS, ntz=True)


@register
def dim_product_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = dim_product_silver(spark, sf_dir)
    return _sales.gold_dimension(silver, _sales.PRODUCT_COLUMNS, _sales.PRODUCT_KEY, GOLD_RUN_TS, ntz=True)


@register
def dim_region_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = dim_region_silver(spark, sf_dir)
    return _sales.gold_dimension(silver, _sales.REGION_COLUMNS, _sales.REGION_KEY, GOLD_RUN_TS, ntz=True)


@register
def fact_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _csv_round_trip(spark, views.sales_bronze_rows(views.table(spark, sf_dir, "lineitem")), "sales-csv")
    return _sales.silver_fact(bronze, RUN_TS, ntz=True)


@register
def scan_json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = views.land_event_pages(spark, sf_dir, scratch_path(spark, "event-pages"))
    text = _files.scan_json_pages(spark, folder, views.EVENT_TEXT)
    return _schema.apply_schema(text, views.EVENT_CONTRACT)


@register
def union_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.event_pages_rows(views.table(spark, sf_dir, "events"))
    base = scratch_path(spark, "event-pages-split")
    rows.filter(~F.col("event_type").eqNullSafe("error")).write.json(base + "/a")
    rows.filter(F.col("event_type") == "error").drop("props").write.json(base + "/b")
    return _schema.apply_schema(_files.scan_pages(spark, [base + "/a", base + "/b"]), views.EVENT_CONTRACT)


@register
def union_page_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union by name of two data frames, the second without one column."""
    rows = views.event_pages_rows(views.table(spark, sf_dir, "events"))
    error = F.col("event_type").eqNullSafe("error")
    return _schema.apply_schema(_files.union_pages([rows.filter(~error), rows.filter(error).drop("props")]), views.EVENT_CONTRACT)


def _landing_with_broken_lines(spark: SparkSession, sf_dir: str) -> str:
    """The events as landed pages, and a page whose lines (of error events) were cut before their end."""
    folder = views.land_event_pages(spark, sf_dir, scratch_path(spark, "event-landing"))
    _cut_lines(views.table(spark, sf_dir, "events").filter("event_type = 'error'")).write.mode("append").text(folder)
    return folder


def _cut_lines(events: DataFrame) -> DataFrame:
    return events.select(F.concat(F.lit('{"event_id":"'), F.col("event_id").cast("string"), F.lit('"')))


@register
def landing_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of landed pages, some of whose lines are broken."""
    folder = _landing_with_broken_lines(spark, sf_dir)
    bronze = _landing.ingest_pages(spark, folder, views.EVENT_TEXT, scratch_path(spark, "event-bronze"))
    return _schema.apply_schema(bronze, views.EVENT_CONTRACT)


@register
def landing_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken lines of the same landing, kept beside the rows."""
    bronze = scratch_path(spark, "event-bronze")
    _landing.ingest_pages(spark, _landing_with_broken_lines(spark, sf_dir), views.EVENT_TEXT, bronze)
    return _landing.broken_lines(spark, bronze, views.EVENT_TEXT)


@register
def landing_unique_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that overlap, landed in two runs: each event once."""
    rows = views.event_pages_rows(views.table(spark, sf_dir, "events"))
    landing, bronze, ckpt = (scratch_path(spark, n) for n in ("event-overlap", "event-unique", "event-unique-checkpoint"))
    third = F.pmod(F.col("event_id").cast("bigint"), F.lit(3))
    for part in (third <= 1, third >= 1):
        rows.filter(part).write.mode("append").json(landing)
        got = _landing.ingest_pages(spark, landing, views.EVENT_TEXT, bronze, ckpt, unique_on=["event_id"], date_of="ts")
    return _schema.apply_schema(got, views.EVENT_CONTRACT)


@register
def landing_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed events of a time range, read from the partitions of its days."""
    bronze = scratch_path(spark, "event-days")
    folder = views.land_event_pages(spark, sf_dir, scratch_path(spark, "event-landing"))
    _landing.ingest_pages(spark, folder, views.EVENT_TEXT, bronze, date_of="ts")
    rows = _landing.rows_between(spark, bronze, views.EVENT_TEXT, "ts", "2024-01-08T00:00:00", "2024-01-21T23:59:59")
    return _schema.apply_schema(rows, views.EVENT_CONTRACT)


def _new_table(spark: SparkSession, role: str) -> tuple[str, str]:
    base = scratch_path(spark, role)
    return "strata_" + base.rsplit("/", 1)[-1].replace("-", "_"), base


def _read_and_drop(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The table's rows from its files; the catalog entry goes (its files stay, being external)."""
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return _sinks.read_location(spark, path, schema)


@register
def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External table, overwritten by a second load."""
    orders = views.table(spark, sf_dir, "orders")
    name, base = _new_table(spark, "orders-external")
    _sinks.overwrite_table(orders.withColumn("o_totalprice", F.lit(0.0)), name, base)
    _sinks.overwrite_table(orders, name, base)
    return _read_and_drop(spark, name, base)


@register
def overwrite_managed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Managed table in the default format, overwritten by a second load and read by name."""
    orders = views.table(spark, sf_dir, "orders")
    name, _ = _new_table(spark, "orders-managed")
    _sinks.overwrite_table(orders.limit(0), name)
    _sinks.overwrite_table(orders, name)
    return _tables.scan_table(spark, name)


@register
def scan_table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of a layer database, read with a column list (any case)."""
    gold = _tables.ensure_layers(spark, _tables.layer_names("strata"))[-1]
    name, base = _new_table(spark, "customer")
    _sinks.overwrite_table(views.table(spark, sf_dir, "customer"), f"{gold}.{name}", base)
    if not _tables.table_exists(spark, f"{gold}.{name}"):
        raise RuntimeError("the table was not made")
    got = _tables.scan_table(spark, f"{gold}.{name}", ["C_CUSTKEY", "c_name"]).toDF("c_custkey", "c_name")
    spark.sql(f"DROP TABLE {gold}.{name}")
    return got


@register
def scan_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables.scan_path(spark, f"{sf_dir}/supplier.parquet")


@register
def register_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region extract as an external CSV table, read by name."""
    name, base = _new_table(spark, "region-csv")
    rows = views.region_bronze_rows(views.table(spark, sf_dir, "supplier"), views.table(spark, sf_dir, "nation"))
    rows.write.option("header", True).option("sep", ";").csv(base)
    got = _files.register_csv(spark, spark.catalog.currentDatabase(), name, base)
    spark.sql(f"DROP TABLE {name}")  # the data frame has its files; the entry is not needed any more
    return got


def _maintained(spark: SparkSession, sf_dir: str, role: str, step) -> DataFrame:
    """Yesterday's orders as a table, changed by ``step(source, table, base)``."""
    target, source = _orders_versions(spark, sf_dir)
    name, base = _new_table(spark, role)
    _sinks.write_version(spark, target, name, base)
    path = step(source, name, base)
    return _read_and_drop(spark, name, path)


@register
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _maintained(spark, sf_dir, "orders-upsert", lambda s, t, b: _sinks.upsert_table(spark, s, t, ["o_orderkey"], b))


@register
def insert_new_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _maintained(spark, sf_dir, "orders-insert", lambda s, t, b: _sinks.insert_new_table(spark, s, t, ["o_orderkey"], b))


@register
def refresh_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full refresh of a table by the whole orders."""
    orders = views.table(spark, sf_dir, "orders")
    return _maintained(spark, sf_dir, "orders-refresh", lambda s, t, b: _sinks.refresh_table(spark, orders, t, b))


@register
def delete_then_insert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete all rows of the stored table, then insert the whole orders by key."""
    orders = views.table(spark, sf_dir, "orders")

    def step(_, table: str, base: str) -> str:
        _sinks.delete_all_table(spark, table, base)
        return _sinks.insert_new_table(spark, orders, table, ["o_orderkey"], base)

    return _maintained(spark, sf_dir, "orders-delete", step)


def _lake(spark: SparkSession, role: str) -> tuple[_jobs.Lake, str]:
    name, base = _new_table(spark, role)
    return _jobs.Lake(spark, base), name


def _taxi_bronze(spark: SparkSession, sf_dir: str) -> tuple[_jobs.Lake, str]:
    landed = scratch_path(spark, "trip-pages")
    raw = views.raw_trips(spark, sf_dir)
    views.land_pages(raw, landed)
    # pages of lines cut in the middle: trips of the seventh line
    cut = F.concat(F.lit('{"DOLocationID":"'), F.col("DOLocationID"), F.lit('","Ven')).alias("value")
    views.land_pages(raw.filter("payment_type = '7'").select(cut), landed)
    lake, name = _lake(spark, "bronze-trips")
    _jobs.taxi_bronze_job(lake, landed, name, "1995-01-01T00:00:00", "1996-12-31T23:59:59")
    return lake, name


def _drop_bronze(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW {name}")
    spark.sql(f"DROP TABLE {name}_landed")


@register
def taxi_bronze_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze job over landed pages with a pickup range; what its table holds, typed."""
    _, name = _taxi_bronze(spark, sf_dir)
    got = _schema.apply_schema(spark.table(name), TRIP_CONTRACT_NTZ)
    _drop_bronze(spark, name)
    return got


@register
def taxi_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken lines of the same job."""
    lake, name = _taxi_bronze(spark, sf_dir)
    _drop_bronze(spark, name)
    return _jobs.taxi_broken_lines(lake, name)


def _quality_job(spark: SparkSession, trips: DataFrame, role: str) -> str:
    lake, prefix = _lake(spark, role)
    trips.write.parquet(lake.path("silver"))
    lake.register(f"{prefix}_silver", lake.path("silver"), trips.schema)
    _jobs.taxi_quality_job(lake, f"{prefix}_silver", prefix)
    return prefix


@register
def quality_split_empty_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality job over trips without NULL tips, so that no trip is unclassified: rows per table."""
    trips = views.trips(spark, sf_dir).fillna(0.0, ["tip_amount"])
    prefix = _quality_job(spark, trips, "empty-class")
    tables = [*quality.CLASSES, "removed_distinct"]
    counts = [spark.table(f"{prefix}_{t}").agg(F.lit(t).alias("measure"), F.count("*").alias("rows")) for t in tables]
    return reduce(DataFrame.unionAll, counts)


@register
def quality_job_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The removed table of the quality job, with the input's columns."""
    prefix = _quality_job(spark, views.trips(spark, sf_dir), "removed-table")
    return spark.table(f"{prefix}_{quality.REMOVED}")


@register
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed lines of landed pages, kept as text: here error events cut before their end."""
    events = views.table(spark, sf_dir, "events")
    line = F.concat(F.lit('{"event_id":"'), F.col("event_id").cast("string"), F.lit('"'), F.when(F.col("event_type").eqNullSafe("error"), "").otherwise("}"))
    folder = scratch_path(spark, "broken-pages")
    events.select(line).write.text(folder)
    return _files.json_rejects(spark, folder, views.EVENT_TEXT)


@register
def lower_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = views.table(spark, sf_dir, "customer")
    return _schema.lower_columns(c.toDF(*[x.upper() for x in c.columns]))


@register
def price_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price-list job, run with half the list and then with the whole: its table holds the last."""
    whole, half = scratch_path(spark, "price-list"), scratch_path(spark, "price-list-half")
    lines = views.price_lines_from_part(views.table(spark, sf_dir, "part"))
    lines.write.text(whole)
    lines.filter(F.crc32("value") % 2 == 0).write.text(half)
    lake, name = _lake(spark, "price-table")
    _jobs.price_job(lake, half, name, _prices.AS_READ, GOLD_RUN_TS)
    got = _jobs.price_job(lake, whole, name, _prices.AS_READ, RUN_TS)
    return _taken(spark, got, name)


def _taken(spark: SparkSession, table: DataFrame, name: str, **stamps: str) -> DataFrame:
    """A job's table by its files, its catalog entry dropped, load stamps zone-free."""
    stamps = [f.name for f in table.schema.fields if isinstance(f.dataType, T.TimestampType)]
    got = _read_and_drop(spark, name, _sinks.table_location(spark, name))
    return got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else got


@register
def dim_product_silver_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver product job run twice: the second extract holds the even products, renamed."""
    lake, name = _lake(spark, "silver-product")
    bronze = _product_bronze(spark, sf_dir)
    even = bronze.filter(F.col("CODIGO_PRODUTO").cast("bigint") % 2 == 0).withColumn("DESCRICAO_PRODUTO", F.upper("DESCRICAO_PRODUTO"))
    for rows, ts in ((bronze, RUN_TS), (even, GOLD_RUN_TS)):
        rows.createOrReplaceTempView(f"{name}_bronze")
        got = _jobs.dimension_silver_job(lake, f"{name}_bronze", name, _sales.PRODUCT_COLUMNS, _sales.PRODUCT_KEY, ts)
    spark.catalog.dropTempView(f"{name}_bronze")
    return _taken(spark, got, name)


@register
def dim_region_gold_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold region job over the table of the silver job, run twice; the second run only stamps anew."""
    lake, name = _lake(spark, "gold-region")
    _region_bronze(spark, sf_dir).createOrReplaceTempView(f"{name}_bronze")
    _jobs.dimension_silver_job(lake, f"{name}_bronze", f"{name}_silver", _sales.REGION_COLUMNS, _sales.REGION_KEY, RUN_TS)
    for ts in (RUN_TS, GOLD_RUN_TS):
        got = _jobs.dimension_gold_job(lake, f"{name}_silver", name, _sales.REGION_COLUMNS, _sales.REGION_KEY, ts)
    spark.catalog.dropTempView(f"{name}_bronze")
    spark.sql(f"DROP TABLE {name}_silver")
    return _taken(spark, got, name)


@register
def fact_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver fact job (which replaces its table), then the gold job over that table, each run twice."""
    lake, name = _lake(spark, "gold-fact")
    rows = views.sales_bronze_rows(views.table(spark, sf_dir, "lineitem"))
    sold = _csv_round_trip(spark, rows, "sales-csv")
    for extract, ts in ((sold.filter("CODIGO_REGIAO % 2 = 0"), RUN_TS), (sold, GOLD_RUN_TS)):
        extract.createOrReplaceTempView(f"{name}_bronze")
        _jobs.fact_silver_job(lake, f"{name}_bronze", f"{name}_silver", ts)
        got = _jobs.fact_gold_job(lake, f"{name}_silver", name, ts)
    spark.catalog.dropTempView(f"{name}_bronze")
    spark.sql(f"DROP TABLE {name}_silver")
    return _taken(spark, got, name)


@register
def calendar_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar job for the years of the orders, run twice over ranges that overlap."""
    lake, name = _lake(spark, "gold-calendar")
    first, last = _series.year_bounds(views.table(spark, sf_dir, "orders"), "o_orderdate")
    _jobs.calendar_job(lake, name, f"{first}-01-01", f"{last}-01-01", RUN_TS)
    got = _jobs.calendar_job(lake, name, f"{first + 1}-01-01", f"{last + 1}-01-01", GOLD_RUN_TS)
    return _taken(spark, got, name)


@register
def taxi_silver_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver job over text trips, run twice: its table holds the typed contract."""
    lake, name = _lake(spark, "silver-trips")
    raw = views.raw_trips(spark, sf_dir)
    for rows in (raw.limit(0), raw):
        got = _jobs.taxi_silver_job(lake, rows, name, TRIP_CONTRACT_NTZ)
    return _taken(spark, got, name)


@register
def load_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load stamp of a run without a given time: one for all rows, and that of the run."""
    stamped = _schema.stamp(views.table(spark, sf_dir, "orders"), "loaded")
    now = F.current_timestamp()
    of_run = F.col("loaded").between(now - F.expr("INTERVAL 1 HOUR"), now)
    return stamped.agg(F.count("*").alias("rows"), F.count_if(of_run).alias("of_this_run"), F.count_distinct("loaded").alias("stamps"))


def _gold_loads(spark: SparkSession, sf_dir: str, role: str, key: str) -> DataFrame:
    """The marts kept by three loads (trips before 1995, later ones, and these once more)."""
    lake, name = _lake(spark, role)
    valid = _valid(spark, sf_dir)
    early = F.col(taxi.PICKUP) < F.lit("1995-01-01").cast("timestamp_ntz")
    daily, zones = f"{name}_daily", f"{name}_zones"
    for rows, load in ((valid.filter(early), "early"), (valid.filter(~early), "late"), (valid.filter(~early), "late")):
        _jobs.taxi_gold_increment_job(lake, rows, load, daily, zones, views.TRIP_SCALES)
    for mart in (daily, zones):
        spark.sql(f"DROP TABLE {mart}_state")
    taken = {taxi.DAY: daily, taxi.ZONE: zones}
    got = {k: _taken(spark, spark.table(mart), mart) for k, mart in taken.items()}
    return got[key]


@register
def taxi_gold_loads_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_loads(spark, sf_dir, "gold-loads-day", taxi.DAY)


@register
def taxi_gold_loads_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_loads(spark, sf_dir, "gold-loads-zone", taxi.ZONE)


@register
def taxi_gold_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold job over a stored table of valid trips, then its reports, told apart by name."""
    lake, name = _lake(spark, "gold-reports")
    _valid(spark, sf_dir).write.parquet(lake.path("valid"))
    spark.read.parquet(lake.path("valid")).createOrReplaceTempView(f"{name}_valid")
    _jobs.taxi_gold_job(lake, f"{name}_valid", f"{name}_daily", f"{name}_zones", views.TRIP_SCALES)
    reports = _jobs.taxi_reports(lake, f"{name}_daily", f"{name}_zones")
    keys = {"top_days_by_revenue": taxi.DAY}
    got = [
        df.select(F.lit(n).alias("report"), F.col(keys.get(n, taxi.ZONE)).cast("string").alias("of"), "total_corridas", "faturamento_total")
        for n, df in reports.items()
    ]
    _files.union_pages(got).write.parquet(lake.path("reports"))  # before the tables go: the reports read them
    for t in ("daily", "zones"):
        spark.sql(f"DROP TABLE {name}_{t}")
    spark.catalog.dropTempView(f"{name}_valid")
    return spark.read.parquet(lake.path("reports"))


def _written_split(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    trips = views.trips(spark, sf_dir)
    path = scratch_path(spark, "trip-split")
    _sinks.write_quality_split(taxi.classify_trips(trips), path)
    return path, trips


@register
def quality_split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid class read back from the one-write split (partition-pruned)."""
    path, trips = _written_split(spark, sf_dir)
    return _sinks.read_quality_class(spark, path, quality.VALID, taxi.clean_columns(trips))


@register
def quality_split_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invalid class read back from the one-write split."""
    path, trips = _written_split(spark, sf_dir)
    return _sinks.read_quality_class(spark, path, quality.INVALID, taxi.clean_columns(trips))


@register
def quality_split_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed class (all copies, input columns) read back from the one-write split."""
    path, trips = _written_split(spark, sf_dir)
    return _sinks.read_quality_class(spark, path, quality.REMOVED, trips.columns)


@register
def fact_gold_partitioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold fact kept in a table partitioned by month (0: undated) and whether it is recent: created
    from the sales shipped before 1999, then upserted with those shipped from July 1998 on, their
    quantities corrected. Only the touched partitions are rewritten; the table read back holds
    every group once, with the values and the stamp of its last load."""
    li = views.table(spark, sf_dir, "lineitem")
    day = F.to_date(F.col("l_shipdate"))

    def gold(rows: DataFrame, run_ts: str) -> DataFrame:
        g = _sales.gold_fact(views.sales_silver_from_lineitem(rows, RUN_TS), run_ts, ntz=True)
        month = F.expr(f"coalesce(`{_sales.FACT_DATE_KEY}` div 100, 0L)")  # yyyyMM
        return g.withColumns({"mes_venda": month, "recente": F.coalesce(F.col(_sales.FACT_DATE_KEY) >= 19980101, F.lit(False))})

    first = gold(li.filter(F.coalesce(day < F.lit("1999-01-01").cast("date"), F.lit(True))), RUN_TS)
    corrected = li.withColumn("l_quantity", F.col("l_quantity") * 2)
    second = gold(corrected.filter(day >= F.lit("1998-07-01").cast("date")), GOLD_RUN_TS)
    base = scratch_path(spark, "fact-partitioned")
    name = "strata_fact_" + base.rsplit("-", 1)[-1]
    parts = ["recente", "mes_venda"]
    keys = ["codigo_produto", "codigo_regiao", _sales.FACT_DATE_KEY, *parts]
    _sinks.upsert_partitioned_table(spark, first, name, keys, parts, base)
    _sinks.upsert_partitioned_table(spark, second, name, keys, parts, base)
    return spark.table(name)


# ---- merges of several writers, bucketed and skewed targets ------------------------------------


@register
def upsert_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's orders, merged at the same time with the corrected orders of 1997 and with the
    new ones: whichever is published second has seen the first."""
    target, source = _orders_versions(spark, sf_dir)
    name, base = _new_table(spark, "orders-two-writers")
    _sinks.write_version(spark, target, name, base)
    new = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(_sinks.upsert_table, spark, source.filter(x), name, ["o_orderkey"], base) for x in (new, ~new)]
        for run in runs:
            run.result()
    return _read_and_drop(spark, name, _sinks.table_location(spark, name))


@register
def upsert_bucketed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert of a table bucketed by its key, twice."""
    target, source = _orders_versions(spark, sf_dir)
    name, base = _new_table(spark, "orders-bucketed")
    for rows in (target, source.filter("o_orderpriority = '1-URGENT'"), source):
        path = _sinks.upsert_table(spark, rows, name, ["o_orderkey"], base, bucket_by=["o_orderkey"], buckets=8)
    return _read_and_drop(spark, name, path)


@register
def upsert_heavy_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target of which a third has one key: its rows are updated where they lie."""
    target, source = _orders_versions(spark, sf_dir)
    one_key = F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_orderkey")).cast("bigint")
    hot = source.agg(
        F.lit(0).cast("bigint").alias("o_orderkey"), F.min("o_custkey").alias("o_custkey"), F.lit("Z").alias("o_orderstatus"),
        F.lit(0.0).alias("o_totalprice"), F.min("o_orderdate").alias("o_orderdate"), F.lit("HOT").alias("o_orderpriority"),
    )
    source = source.filter("o_orderkey % 3 <> 0").unionByName(hot)
    name, base = _new_table(spark, "orders-heavy")
    _sinks.write_version(spark, target.withColumn("o_orderkey", one_key), name, base)
    path = _sinks.upsert_table(spark, source, name, ["o_orderkey"], base, heavy_share=1 / 64)
    return _read_and_drop(spark, name, path)


@register
def overwrite_default_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table overwritten in the session's default format, here ORC."""
    name, base = _new_table(spark, "orders-orc")
    key, orders = "spark.sql.sources.default", views.table(spark, sf_dir, "orders")
    before = spark.conf.get(key)
    spark.conf.set(key, "orc")
    try:
        for rows in (orders.limit(0), orders):
            _sinks.overwrite_table(rows, name, base)
    finally:
        spark.conf.set(key, before)
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).orc(base)


@register
def hash_key_null_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash keys of parts of which any may be NULL: as many keys as there are combinations."""
    part = lambda c, m: F.when(F.col("o_orderkey") % m == 0, F.lit(None)).otherwise(F.col(c))
    rows = views.table(spark, sf_dir, "orders").select(part("o_custkey", 2).alias("a"), part("o_custkey", 3).alias("b"), part("o_custkey", 5).alias("c"))
    keys = rows.select("a", "b", "c", _keys.hash_key(["a", "b", "c"]).alias("k"))
    return keys.agg(F.count_distinct("k").alias("keys"), F.count_distinct(F.struct("a", "b", "c")).alias("combinations"))


def _typed_split(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    path = scratch_path(spark, "typed-trips")
    return path, _sinks.write_typed_split(views.raw_trips(spark, sf_dir), TRIP_CONTRACT_NTZ, path)


@register
def typed_split_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good rows of the one-write split into typed and rejected trips."""
    return _sinks.read_typed(spark, _typed_split(spark, sf_dir)[0], TRIP_CONTRACT_NTZ)


@register
def typed_split_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected trips of the same split, with the texts that did not cast."""
    raw = F.col(_sinks.SPLIT_RAW)
    return _sinks.read_rejects(spark, _typed_split(spark, sf_dir)[0]).select(
        "DOLocationID", "payment_type", raw["VendorID"].alias("vendor_text"), raw["trip_distance"].alias("distance_text"),
        F.concat_ws(",", _sinks.SPLIT_ERRORS).alias("rejected_columns"),
    )


@register
def metrics_by_zone_order_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone mart of trips without declared scales: sums of doubles that do not depend on the order."""
    return taxi.metrics_by_zone(taxi.valid_trips(views.mill_trips(spark, sf_dir, with_nan=False)))


@register
def distinct_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users per event type, from sketches of two loads united, beside the exact count."""
    events = views.table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    loads = [_marts.distinct_state(events.filter(x), ["event_type"], ["user_id"], "users") for x in (early, ~early)]
    united = _marts.merge_distinct(loads[0].unionByName(loads[1]), ["event_type"], "users")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users_exact"))
    close = F.abs(F.col("users_estimate") - F.col("users_exact")) <= 0.02 * F.col("users_exact") + 1
    return united.join(exact, "event_type").select("event_type", "users_exact", close.alias("within_2_percent"))
