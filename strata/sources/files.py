"""File sources: text lines, fixed-width records, delimited files, JSON pages.

All parsing is column expressions over a distributed scan; no rows pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One string column ``value`` per line."""
    return spark.read.text(path if isinstance(path, str) else list(path))


@dataclass(frozen=True)
class Field:
    """A fixed-width field: 1-based ``start``, ``length`` characters; ``rtrim`` trailing blanks."""

    name: str
    start: int
    length: int
    rtrim: bool = False


@dataclass(frozen=True)
class Layout:
    name: str
    fields: tuple[Field, ...]


def field_column(value: Column, f: Field) -> Column:
    c = F.substring(value, f.start, f.length)
    return F.rtrim(c) if f.rtrim else c


def parse_fixed_width(df: DataFrame, layout: Layout, value_col: str = "value") -> DataFrame:
    """Slice each line into the layout's fields (one projection)."""
    v = F.col(value_col)
    return df.select(*[field_column(v, f).alias(f.name) for f in layout.fields])


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ";",
    header: bool = True,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Delimited file(s) as read by schema-on-read: header names, every column a string
    unless a schema is given. A UTF-8 byte-order mark and CRLF line ends are accepted."""
    reader = spark.read.option("header", header).option("sep", sep).option("encoding", "UTF-8")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path if isinstance(path, str) else list(path))


def register_csv(
    spark: SparkSession, database: str, table: str, path: str, sep: str = ";", header: bool = True
) -> DataFrame:
    """External table over a delimited file (``CREATE TABLE IF NOT EXISTS ... USING csv``)."""
    esc = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` USING csv "
        f"OPTIONS (path '{esc}', header '{str(header).lower()}', delimiter '{sep}')"
    )
    return spark.table(f"`{database}`.`{table}`")


def scan_json_pages(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    multiline: bool = False,
) -> DataFrame:
    """All landed JSON pages in one scan with a declared schema.

    A key absent from a page (or from every row of a page) reads as NULL. ``multiline=True``
    reads files holding one JSON array of objects (one task per file); the default reads
    JSON Lines, which splits large files across tasks. A malformed page fails the read;
    ``json_rejects`` lists such lines.
    """
    reader = spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST")
    return reader.json(path if isinstance(path, str) else list(path))


def json_rejects(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """``(corrupt_line)``: the lines of JSON Lines pages that are no object of that schema."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    marked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    bad = lines.select("value", parsed["_corrupt_record"].alias("bad")).filter(F.col("bad").isNotNull())
    return bad.select(F.col("value").alias("corrupt_line"))


def scan_pages(spark: SparkSession, pages: Sequence[str], multiline: bool = False) -> DataFrame:
    """The union by name of JSON pages whose columns are not declared: one job finds the columns of all
    pages, one scan reads them, so the plan is the same for any number of pages."""
    if not pages:
        raise ValueError("no pages")
    return spark.read.option("multiLine", multiline).option("mode", "FAILFAST").json(list(pages))


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns missing from a page are filled with NULL."""
    if not pages:
        raise ValueError("no pages")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame with the declared schema (a source that delivered nothing)."""
    return spark.createDataFrame([], schema)


def filter_time_range(df: DataFrame, column: str, lo: str, hi: str) -> DataFrame:
    """Rows with ``lo <= column <= hi``, compared as timestamps (both ends inclusive).

    Text columns and bounds are read as zone-free timestamps; a timestamp column keeps its
    own type. Comparing as timestamps keeps ``...23:59:59.000`` that a text comparison drops.
    """
    dtype = df.schema[column].dataType
    kind = dtype if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else T.TimestampNTZType()
    value = F.col(column) if dtype == kind else F.col(column).try_cast(kind)
    return df.filter(value.between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)))
