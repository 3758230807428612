"""Generated sources: timestamp series and calendars, built on a distributed ``spark.range``.

Only the two bounds are scalars on the driver; the rows are generated in parallel.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_EPOCH = dt.datetime(1970, 1, 1)


def _as_datetime(v: dt.datetime | dt.date | str) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v).replace("T", " "))


def generate_series(
    spark: SparkSession,
    start: dt.datetime | dt.date | str,
    stop: dt.datetime | dt.date | str,
    step_seconds: int,
    name: str = "data",
) -> DataFrame:
    """Zone-free timestamps from ``start`` (inclusive) to ``stop`` (exclusive) every
    ``step_seconds`` seconds."""
    if step_seconds <= 0:
        raise ValueError("step must be positive")
    a, b = _as_datetime(start), _as_datetime(stop)
    span = (b - a).total_seconds()
    n = max(0, math.ceil(span / step_seconds))
    first = a.isoformat(sep=" ")
    return spark.range(0, n).select(
        F.expr(
            f"timestampadd(SECOND, id * {int(step_seconds)}, timestamp_ntz'{first}')"
        ).alias(name)
    )


def series_over(
    df: DataFrame, column: str, step_seconds: int, unit: str = "hour", name: str = "data"
) -> DataFrame:
    """Series covering a column's range: from its minimum truncated to ``unit`` up to its
    maximum (exclusive). One aggregate brings the two bounds to the driver."""
    bounds = df.agg(
        F.date_trunc(unit, F.min(column)).cast("timestamp_ntz").alias("lo"),
        F.max(column).cast("timestamp_ntz").alias("hi"),
    ).first()
    spark = df.sparkSession
    if bounds is None or bounds["lo"] is None:
        return generate_series(spark, _EPOCH, _EPOCH, step_seconds, name)
    return generate_series(spark, bounds["lo"], bounds["hi"], step_seconds, name)


def calendar_days(
    spark: SparkSession, start: dt.date | str, stop: dt.date | str, name: str = "day"
) -> DataFrame:
    """One DATE per day, ``start`` inclusive, ``stop`` exclusive. Days are counted as dates,
    so daylight-saving shifts cannot repeat or skip a day."""
    a = _as_datetime(start).date()
    b = _as_datetime(stop).date()
    n = max(0, (b - a).days)
    return spark.range(0, n).select(
        F.date_add(F.lit(a.isoformat()).cast("date"), F.col("id").cast("int")).alias(name)
    )


def calendar_over(df: DataFrame, column: str, name: str = "day") -> DataFrame:
    """Every day from a column's first to its last date, inclusive."""
    bounds = df.agg(
        F.min(F.to_date(F.col(column))).alias("lo"), F.max(F.to_date(F.col(column))).alias("hi")
    ).first()
    spark = df.sparkSession
    if bounds is None or bounds["lo"] is None:
        return calendar_days(spark, dt.date(1970, 1, 1), dt.date(1970, 1, 1), name)
    return calendar_days(spark, bounds["lo"], bounds["hi"] + dt.timedelta(days=1), name)


def year_bounds(df: DataFrame, column: str) -> tuple[int, int]:
    """First and last year of a date or time column (two scalars, one aggregate)."""
    return tuple(df.agg(F.year(F.min(column)), F.year(F.max(column))).first())
