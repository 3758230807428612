"""End-to-end batch jobs, one per job of the rebuilt projects.

Each job reads its inputs (files or tables), applies a recipe from ``strata.plans`` and
writes its table through ``strata.sinks.tables`` (new version folder, then repoint). Names
of databases, tables, paths and run times are parameters; ``Lake`` only says where table
versions are stored.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators import quality
from strata.operators.schema import apply_schema
from strata.plans import prices, sales, taxi
from strata.sinks import tables as sinks
from strata.sources import files, series
from strata.sources.tables import ensure_layers, scan_table, table_exists
from strata.streaming import landing as landed


@dataclass(frozen=True)
class Lake:
    """A session plus the shared folder under which every table keeps its versions."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table.replace('.', '/')}"

    def register(self, table: str, location: str, schema: T.StructType) -> None:
        """Point ``table`` at Parquet files of a declared schema (the folder may hold none yet)."""
        s = self.spark
        if table_exists(s, table):
            known = s.table(table).schema
            if [(f.name, f.dataType) for f in known] != [(f.name, f.dataType) for f in schema]:
                raise ValueError(f"{table} has the columns {known.simpleString()}, given are {schema.simpleString()}")
            s.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            s.catalog.refreshTable(table)
        else:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            s.sql(f"CREATE TABLE {table} ({cols}) USING parquet LOCATION '{location}'")


def create_layers(lake: Lake, databases: Sequence[str]) -> list[str]:
    """The layer databases (e.g. bronze, silver, gold)."""
    return ensure_layers(lake.spark, databases)


# ---- price list ----------------------------------------------------------------------------


def price_job(
    lake: Lake, text_path: str, table: str, layout: prices.Layout, run_ts=None
) -> DataFrame:
    """Fixed-width file -> typed price table. A later run replaces all rows (delete, then
    insert-only merge on the product code = exactly the new file)."""
    df = prices.price_bronze(files.scan_text(lake.spark, text_path), layout, run_ts)
    sinks.refresh_table(lake.spark, df, table, lake.path(table))
    return lake.spark.table(table)


# ---- sales star schema ---------------------------------------------------------------------


def csv_bronze_job(lake: Lake, database: str, table: str, csv_path: str, sep: str = ";") -> DataFrame:
    """Schema-on-read table over a delimited extract (all columns text)."""
    return files.register_csv(lake.spark, database, table, csv_path, sep)


def dimension_silver_job(
    lake: Lake, bronze: str, silver: str, columns: tuple[str, ...], key: str, run_ts=None
) -> DataFrame:
    """Typed dimension, create-or-upsert on its key."""
    df = sales.silver_dimension(scan_table(lake.spark, bronze), columns, key, run_ts)
    sinks.upsert_table(lake.spark, df, silver, [key], lake.path(silver))
    return lake.spark.table(silver)


def dimension_gold_job(
    lake: Lake, silver: str, gold: str, columns: tuple[str, ...], key: str, run_ts=None
) -> DataFrame:
    df = sales.gold_dimension(scan_table(lake.spark, silver, list(columns)), columns, key, run_ts)
    sinks.upsert_table(lake.spark, df, gold, [key], lake.path(gold))
    return lake.spark.table(gold)


def fact_silver_job(lake: Lake, bronze: str, silver: str, run_ts=None) -> DataFrame:
    """Typed sales rows; every run fully refreshes the table (its product code is no key)."""
    df = sales.silver_fact(scan_table(lake.spark, bronze), run_ts)
    sinks.refresh_table(lake.spark, df, silver, lake.path(silver))
    return lake.spark.table(silver)


def fact_gold_job(
    lake: Lake,
    silver: str,
    gold: str,
    run_ts=None,
    keys: Sequence[str] = ("codigo_produto", "codigo_regiao", "id_data_venda"),
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rolled-up fact, create-or-upsert. The merge matches on the natural key by default,
    because the concatenated ``id_fa_venda`` can collide. With ``partition_by`` (e.g. the
    date key) the table is partitioned and a run rewrites only the partitions it touches."""
    df = sales.gold_fact(scan_table(lake.spark, silver), run_ts)
    if partition_by:
        sinks.upsert_partitioned_table(lake.spark, df, gold, list(keys), list(partition_by), lake.path(gold))
    else:
        sinks.upsert_table(lake.spark, df, gold, list(keys), lake.path(gold))
    return lake.spark.table(gold)


def calendar_job(
    lake: Lake, gold: str, start: str = sales.CALENDAR_START, stop: str = sales.CALENDAR_STOP, run_ts=None
) -> DataFrame:
    """Calendar dimension over [start, stop), create-or-upsert on ``id_data``."""
    days = series.calendar_days(lake.spark, start, stop)
    df = sales.calendar_table(days, "day", run_ts)
    sinks.upsert_table(lake.spark, df, gold, [sales.CALENDAR_KEY], lake.path(gold))
    return lake.spark.table(gold)


# ---- taxi trips ----------------------------------------------------------------------------

TRIP_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in taxi.TRIP_CONTRACT.fields])


def taxi_bronze_job(
    lake: Lake,
    landing: str,
    table: str,
    lo: str | None = None,
    hi: str | None = None,
    multiline: bool = False,
    unique_on: Sequence[str] | None = None,
) -> DataFrame:
    """New landed pages -> bronze (text), exactly once; optional pickup-time range.

    All landed rows stay in ``<table>_landed``, partitioned by pickup month, with the broken lines
    beside them (``taxi_broken_lines``). ``table`` is a view of the rows, or of those of the range, which reads
    only the range's months; another run may ask for another range, and nothing is copied.
    ``unique_on`` lands a row that pages repeat once (see ``ingest_pages``)."""
    if (lo is None) != (hi is None):
        raise ValueError("a range needs both ends")
    s, folder = lake.spark, lake.path(table) + "/landed"
    landed.ingest_pages(s, landing, TRIP_TEXT, folder, lake.path(table) + "/_landing", multiline, unique_on=unique_on, date_of=taxi.PICKUP)
    store = f"{table}_landed"
    lake.register(store, folder, landed.landed_schema(TRIP_TEXT))
    s.catalog.refreshTable(store)
    rule = f"{landed.LANDED_AS} = '{landed.ROW}'"
    if lo is not None:
        rule += f" AND {landed.dates_between(lo, hi)}"
        rule += f" AND try_cast({taxi.PICKUP} AS timestamp_ntz) BETWEEN TIMESTAMP_NTZ '{lo}' AND TIMESTAMP_NTZ '{hi}'"
    columns = ", ".join(f"`{n}`" for n in TRIP_TEXT.names)
    s.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {columns} FROM {store} WHERE {rule}")
    return s.table(table)


def taxi_broken_lines(lake: Lake, table: str) -> DataFrame:
    """The landed lines of ``taxi_bronze_job`` that are no trip at all."""
    return landed.broken_lines(lake.spark, lake.path(table) + "/landed", TRIP_TEXT)


def taxi_silver_job(lake: Lake, bronze: DataFrame | str, table: str, contract: T.StructType = taxi.TRIP_CONTRACT) -> DataFrame:
    """Text -> the typed contract (``try_cast``), overwrite."""
    src = scan_table(lake.spark, bronze) if isinstance(bronze, str) else bronze
    sinks.write_version(lake.spark, apply_schema(src, contract), table, lake.path(table))
    return lake.spark.table(table)


def taxi_quality_job(lake: Lake, silver: str, prefix: str) -> dict[str, int]:
    """All quality classes in one scan and one write; one table per class
    (``<prefix>_valid`` ...), plus ``<prefix>_removed_distinct``. A class without rows is an
    empty table; the removed tables have the input's columns. Returns the class counts."""
    s = lake.spark
    trips = scan_table(s, silver)
    base = f"{lake.path(prefix)}/split/v-{uuid.uuid4().hex}"
    classified = taxi.classify_trips(trips)
    counts = sinks.write_quality_split(classified, base)
    for cls in quality.CLASSES:
        columns = trips.columns if cls == quality.REMOVED else taxi.clean_columns(trips)
        lake.register(f"{prefix}_{cls}", f"{base}/quality_class={cls}", classified.select(*columns).schema)
    removed = s.table(f"{prefix}_{quality.REMOVED}").distinct()
    sinks.write_version(s, removed, f"{prefix}_removed_distinct", lake.path(prefix) + "/removed_distinct")
    return counts


def taxi_gold_job(lake: Lake, valid: str, daily: str, zones: str, scales: dict[str, int] | None = None) -> None:
    """Daily and pickup-zone marts from the valid trips."""
    v = scan_table(lake.spark, valid)
    sinks.write_version(lake.spark, taxi.metrics_by_day(v, scales), daily, lake.path(daily))
    sinks.write_version(lake.spark, taxi.metrics_by_zone(v, scales), zones, lake.path(zones))


def taxi_gold_increment_job(
    lake: Lake, valid: DataFrame, load: str, daily: str, zones: str, scales: dict[str, int] | None = None
) -> None:
    """Bring the marts up to date with one load of valid trips, without reading earlier loads.

    Each load leaves a small state per mart (a row per key, in ``<mart>_state``); a mart is
    the sum of the states. A load that is run again replaces its own state."""
    for key, mart in ((taxi.DAY, daily), (taxi.ZONE, zones)):
        state = taxi.mart_state_of(valid, key, scales)
        sinks.replace_slice(lake.spark, state, f"{mart}_state", "load", load, lake.path(f"{mart}_state"))
        states = scan_table(lake.spark, f"{mart}_state").drop("load")
        sinks.write_version(lake.spark, taxi.mart_of_states(states, key, scales), mart, lake.path(mart))


def taxi_reports(lake: Lake, daily: str, zones: str, k: int = taxi.TOP_K) -> dict[str, DataFrame]:
    """The three top-k reports, read from the written marts (no re-aggregation)."""
    d, z = scan_table(lake.spark, daily), scan_table(lake.spark, zones)
    return {
        "top_days_by_revenue": taxi.top_days_by_revenue(d, k),
        "top_zones_by_trips": taxi.top_zones_by_trips(z, k),
        "top_zones_by_distance_tip": taxi.top_zones_by_distance_tip(z, k),
    }
