"""Incremental landing of JSON pages with Structured Streaming.

A page fetcher drops files into a landing folder; each run picks up only the files not seen
before (tracked in the checkpoint), appends them to the bronze folder exactly once and stops
(``availableNow``). A lost executor only re-runs its tasks; a failed run resumes from the
checkpoint. The checkpoint lives in the session's shared checkpoint folder unless given.

Rows and broken lines are two partitions of one write, which the sink commits as a whole: every landed
line is in exactly one of them, whenever a run breaks off. Rows can also be partitioned by a
date, so that a time range reads its days only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.files import filter_time_range
from strata.workspace import scratch_path

#: Text of a broken line, kind of a landed line, and date of a row: the columns landing adds.
CORRUPT, LANDED_AS, LANDED_DATE = "_corrupt_record", "landed_as", "landed_date"
ROW, BROKEN = "row", "broken"
#: Leading characters of an ISO date that a partition of each grain holds.
GRAINS = {"year": 4, "month": 7, "day": 10}
_DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landed_schema(schema: T.StructType) -> T.StructType:
    """What the bronze folder holds: the declared columns and the three that landing adds."""
    return T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in (CORRUPT, LANDED_AS, LANDED_DATE)]])


def ingest_pages(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    bronze_path: str,
    checkpoint: str | None = None,
    multiline: bool = False,
    fmt: str = "parquet",
    unique_on: Sequence[str] | None = None,
    date_of: str | None = None,
    grain: str = "month",
    on_broken: str = "keep",
) -> DataFrame:
    """Land all new pages under ``landing`` in ``bronze_path``; return the rows landed so far.

    A line that is no object of the schema is kept as text beside the rows (``broken_lines``);
    with ``multiline`` that is the whole file. ``on_broken="fail"`` fails the run instead, and lands
    nothing of its batch until the page is mended. ``unique_on`` names the columns by which a row that
    a later page (or run) repeats, as paging by offset does, is known again: each is landed once, its key
    being kept on disk in the stream's state for good; equal broken lines count as repeated too.
    ``date_of`` names a text or time column whose year, month or day (``grain``) partitions the rows, so
    that ``rows_between`` reads few; a grain should hold many megabytes, as every batch writes files for each.
    ``unique_on`` and ``date_of`` stay what they were on the first run of a checkpoint.
    """
    if on_broken not in ("keep", "fail"):
        raise ValueError(f"on_broken is keep or fail, not {on_broken!r}")
    if bad := {CORRUPT, LANDED_AS, LANDED_DATE} & {n.lower() for n in schema.names}:
        raise ValueError(f"columns {sorted(bad)} are made by landing")
    ckpt = checkpoint or scratch_path(spark, "landing-checkpoint")
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(marked).option("multiLine", multiline)
    mode = "PERMISSIVE" if on_broken == "keep" else "FAILFAST"
    stream = reader.option("mode", mode).option("columnNameOfCorruptRecord", CORRUPT).json(landing)
    broken = F.col(CORRUPT).isNotNull()
    if unique_on is not None:
        # a broken line holds NULL in every column, so it meets only its equals
        names = {n.lower(): n for n in schema.names}
        stream = stream.dropDuplicates([*[names[n.lower()] for n in unique_on], CORRUPT])
    day = F.lit(None).cast("string")
    if date_of:
        day = F.substring(F.col(date_of).try_cast("timestamp_ntz").try_cast("date").cast("string"), 1, GRAINS[grain])
    lines = stream.withColumns({LANDED_AS: F.when(broken, BROKEN).otherwise(ROW), LANDED_DATE: day})
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, _DISK_STATE)
    try:
        query = (
            lines.writeStream.format(fmt)
            .option("checkpointLocation", ckpt)
            .option("path", bronze_path)
            .partitionBy(LANDED_AS, LANDED_DATE)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(provider, before) if before else spark.conf.unset(provider)
    query.awaitTermination()
    return landed_rows(spark, bronze_path, schema, fmt)


def _landed(spark: SparkSession, bronze_path: str, schema: T.StructType, kind: str, fmt: str) -> DataFrame:
    return _written(spark, landed_schema(schema), fmt, bronze_path).filter(F.col(LANDED_AS) == kind)


def landed_rows(spark: SparkSession, bronze_path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows landed so far, in the declared columns."""
    return _landed(spark, bronze_path, schema, ROW, fmt).select(*schema.names)


def broken_lines(spark: SparkSession, bronze_path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """``(corrupt_line)``: the landed lines that are no object of the schema."""
    return _landed(spark, bronze_path, schema, BROKEN, fmt).select(F.col(CORRUPT).alias("corrupt_line"))


def dates_between(lo: str, hi: str) -> str:
    """SQL: whether a date partition, of whatever grain, can hold times from ``lo`` to ``hi``."""
    day = lambda t: f"left('{dt.datetime.fromisoformat(t).date().isoformat()}', length({LANDED_DATE}))"
    return f"{LANDED_DATE} BETWEEN {day(lo)} AND {day(hi)}"


def rows_between(
    spark: SparkSession, bronze_path: str, schema: T.StructType, date_of: str, lo: str, hi: str, fmt: str = "parquet"
) -> DataFrame:
    """Landed rows with ``lo <= date_of <= hi`` (times, both ends inclusive); only the
    partitions that can hold such times are read."""
    rows = _landed(spark, bronze_path, schema, ROW, fmt).filter(dates_between(lo, hi))
    return filter_time_range(rows, date_of, lo, hi).select(*schema.names)


def _written(spark: SparkSession, schema: T.StructType, fmt: str, path: str) -> DataFrame:
    """What a stream has written below ``path`` so far."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # nothing landed yet: an empty source is an empty table with the declared schema
        return spark.createDataFrame([], schema)


def stream_quality_split(
    spark: SparkSession,
    bronze_path: str,
    text_schema: T.StructType,
    classify,
    out_path: str,
    checkpoint: str | None = None,
    contract: T.StructType | None = None,
    class_col: str = "quality_class",
    fmt: str = "parquet",
) -> DataFrame:
    """Incremental silver step: new bronze files -> typed contract -> one-pass classes,
    appended to ``out_path`` partitioned by class, exactly once, then stop (``availableNow``).

    The split is per row (no state), so each micro-batch is classified on its own; counts that
    need all rows (the distinct removed rows) are computed on the output as a batch job.
    A folder of ``ingest_pages`` gives its rows, not its broken lines.
    ``classify`` maps a typed DataFrame to one with ``class_col`` (e.g. ``taxi.classify_trips``).
    """
    from strata.operators.schema import apply_schema

    ckpt = checkpoint or scratch_path(spark, "quality-checkpoint")
    kind = T.StructType([*text_schema.fields, T.StructField(LANDED_AS, T.StringType())])
    rows = spark.readStream.schema(kind).format(fmt).load(bronze_path)
    rows = rows.filter(F.coalesce(F.col(LANDED_AS), F.lit(ROW)) == ROW).select(*text_schema.names)
    typed = apply_schema(rows, contract) if contract is not None else rows
    classified = classify(typed)
    query = (
        classified.writeStream.format(fmt)
        .option("checkpointLocation", ckpt)
        .option("path", out_path)
        .partitionBy(class_col)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _written(spark, classified.schema, fmt, out_path)
