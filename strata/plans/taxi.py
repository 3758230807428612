"""Trip pipeline: raw pages -> typed trips -> quality classes -> daily / zone marts -> top-5.

The trip contract, rule set and mart definitions are fixed values of the job being rebuilt;
they are collected here as data, and the operators in ``strata.operators`` do the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import date_label
from strata.operators import quality
from strata.operators.marts import Metric, mart_of_state, mart_state, merge_states, metrics_by, top_k

# --- fixed values: the trip contract (column names and types, in order) -----------------
TRIP_CONTRACT = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
    ]
)
TRIP_COLUMNS = [f.name for f in TRIP_CONTRACT.fields]
PICKUP = "tpep_pickup_datetime"
CHECK = "total_amount_check"
PARTS = ("pickup_year", "pickup_month", "pickup_day")
CLASS_COL = "quality_class"
# --- end fixed values ---------------------------------------------------------------------


def trip_contract(timestamp_type: T.DataType = T.TimestampType()) -> T.StructType:
    """The contract, optionally with zone-free timestamps (``TimestampNTZType``)."""
    return T.StructType(
        [
            T.StructField(f.name, timestamp_type if isinstance(f.dataType, T.TimestampType) else f.dataType)
            for f in TRIP_CONTRACT.fields
        ]
    )


def keep_rules() -> list[Column]:
    """Rows kept for analysis: pickup and vendor present, distance and passengers positive,
    fare not negative. NULL outcomes fail, and so does NaN, which compares as the largest number."""
    return [
        F.col(PICKUP).isNotNull(),
        F.col("VendorID").isNotNull(),
        F.col("trip_distance") > 0,
        F.col("passenger_count") > 0,
        F.col("fare_amount") >= 0,
        *[~F.isnan(c) for c in ("trip_distance", "passenger_count", "fare_amount")],
    ]


def total_covers_parts() -> Column:
    """Business rule: the total covers fare + tip + tolls + extra (NULL if any part is NULL or the
    total or the tip is no number)."""
    known = ~F.isnan("total_amount") & ~F.isnan("tip_amount")
    return F.when(
        known,
        F.col("total_amount") >= (F.col("fare_amount") + F.col("tip_amount") + F.col("tolls_amount") + F.col("extra")),
    )


def normalize_flag(df: DataFrame) -> DataFrame:
    """Upper-case the store-and-forward flag."""
    return df.withColumn("store_and_fwd_flag", F.upper(F.col("store_and_fwd_flag")))


def pickup_parts(df: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Add pickup year, month and day-of-month (int)."""
    return df.withColumns(
        {
            "pickup_year": F.year(F.col(ts)),
            "pickup_month": F.month(F.col(ts)),
            "pickup_day": F.dayofmonth(F.col(ts)),
        }
    )


def classify_trips(trips: DataFrame) -> DataFrame:
    """All trips with the derived columns, the rule column and ``quality_class``, one pass."""
    on_kept = {
        "store_and_fwd_flag": F.upper(F.col("store_and_fwd_flag")),
        "pickup_year": F.year(F.col(PICKUP)),
        "pickup_month": F.month(F.col(PICKUP)),
        "pickup_day": F.dayofmonth(F.col(PICKUP)),
    }
    return quality.classify(trips, keep_rules(), CHECK, total_covers_parts(), on_kept, CLASS_COL)


def clean_columns(trips: DataFrame) -> list[str]:
    return [*trips.columns, *PARTS, CHECK]


def clean_trips(trips: DataFrame) -> DataFrame:
    """Kept trips with the flag normalised, the pickup parts and the rule column."""
    kept = quality.quality_filter(trips, keep_rules())
    return pickup_parts(normalize_flag(kept)).withColumn(CHECK, total_covers_parts())


def trips_of_class(trips: DataFrame, cls: str) -> DataFrame:
    """One class, as a direct predicate so that the keep rules reach the Parquet scan.
    valid / invalid / unclassified carry the derived columns; removed keeps the input
    columns only (it is cut before derivation). ``classify_trips`` gives all classes at once."""
    if cls == quality.REMOVED:
        return quality.removed_all(trips, keep_rules())
    clean = clean_trips(trips)
    check = F.col(CHECK)
    pred = {quality.VALID: check, quality.INVALID: ~check, quality.UNCLASSIFIED: check.isNull()}[cls]
    return clean.filter(pred)


def valid_trips(trips: DataFrame) -> DataFrame:
    return trips_of_class(trips, quality.VALID)


def invalid_trips(trips: DataFrame) -> DataFrame:
    return trips_of_class(trips, quality.INVALID)


def unclassified_trips(trips: DataFrame) -> DataFrame:
    return trips_of_class(trips, quality.UNCLASSIFIED)


def removed_trips_all(trips: DataFrame) -> DataFrame:
    return quality.removed_all(trips, keep_rules())


def removed_trips_distinct(trips: DataFrame) -> DataFrame:
    return quality.removed_distinct(trips, keep_rules())


def trip_quality_report(trips: DataFrame) -> DataFrame:
    return quality.quality_report(classify_trips(trips), trips.columns, CLASS_COL)


# --- fixed values: mart definitions (output name, function, input column) ---------------
DAILY_METRICS = (
    ("total_corridas", "count", "VendorID"),
    ("distancia_total_km", "sum", "trip_distance"),
    ("distancia_media_km", "avg", "trip_distance"),
    ("faturamento_total", "sum", "total_amount"),
    ("ticket_medio", "avg", "total_amount"),
    ("gorjeta_media", "avg", "tip_amount"),
    ("passageiros_media", "avg", "passenger_count"),
)
ZONE_METRICS = (
    ("total_corridas", "count", "VendorID"),
    ("faturamento_total", "sum", "total_amount"),
    ("ticket_medio", "avg", "total_amount"),
    ("gorjeta_media", "avg", "tip_amount"),
    ("distancia_media_km", "avg", "trip_distance"),
    ("passageiros_media", "avg", "passenger_count"),
)
DAY = "dia"
ZONE = "PULocationID"
TOP_K = 5
# --- end fixed values ---------------------------------------------------------------------


def _spec(defs, scales: dict[str, int] | None) -> list[Metric]:
    scales = scales or {}
    return [Metric(n, fn, c, scales.get(c)) for n, fn, c in defs]


def metrics_by_day(valid: DataFrame, scales: dict[str, int] | None = None, exact: bool = True) -> DataFrame:
    """Daily mart keyed by ``dia`` (yyyy-MM-dd of pickup)."""
    with_day = valid.withColumn(DAY, date_label(F.col(PICKUP)))
    return metrics_by(with_day, [DAY], _spec(DAILY_METRICS, scales), exact)


def metrics_by_zone(valid: DataFrame, scales: dict[str, int] | None = None, exact: bool = True) -> DataFrame:
    """Mart keyed by pickup zone."""
    return metrics_by(valid, [ZONE], _spec(ZONE_METRICS, scales), exact)


def mart_state_of(valid: DataFrame, key: str, scales: dict[str, int] | None = None) -> DataFrame:
    """The mergeable state of the daily (``dia``) or the zone mart over some of the valid trips."""
    if key == DAY:
        valid = valid.withColumn(DAY, date_label(F.col(PICKUP)))
    return mart_state(valid, [key], _spec({DAY: DAILY_METRICS, ZONE: ZONE_METRICS}[key], scales))


def mart_of_states(states: DataFrame, key: str, scales: dict[str, int] | None = None) -> DataFrame:
    """The daily or the zone mart from the states of all loads."""
    return mart_of_state(merge_states(states, [key]), [key], _spec({DAY: DAILY_METRICS, ZONE: ZONE_METRICS}[key], scales))


def top_days_by_revenue(daily: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_k(daily, [F.col("faturamento_total").desc_nulls_last()], k, [DAY])


def top_zones_by_trips(zones: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_k(zones, [F.col("total_corridas").desc_nulls_last()], k, [ZONE])


def top_zones_by_distance_tip(zones: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_k(
        zones,
        [F.col("distancia_media_km").desc_nulls_last(), F.col("gorjeta_media").desc_nulls_last()],
        k,
        [ZONE],
    )
