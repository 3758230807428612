"""Views that give the test tables the roles of the rebuilt jobs' inputs.

The jobs' own inputs (an API of taxi trips, CSV extracts, a fixed-width price list) are not
available, so each role is played by a projection of a given table. No view filters rows (the
region view adds each supplier's nation name by key), so every query built on them reads the
whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Scale (decimal places) of the trip view's measures; total_amount is a product of two
# two-place numbers, so it carries four.
TRIP_SCALES = {"trip_distance": 2, "fare_amount": 2, "tip_amount": 2, "passenger_count": 2, "total_amount": 4}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Trip role: one trip per line item, columns in contract order."""
    return lineitem.select(
        F.col("l_suppkey").alias("VendorID"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        (F.col("l_shipdate") + F.expr("INTERVAL 30 MINUTES")).alias("tpep_dropoff_datetime"),
        (F.col("l_linenumber") % 7).cast("double").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.lit(1.0).alias("RatecodeID"),
        F.lower(F.col("l_returnflag")).alias("store_and_fwd_flag"),
        F.col("l_partkey").alias("PULocationID"),
        F.col("l_orderkey").alias("DOLocationID"),
        F.col("l_linenumber").cast("bigint").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.lit(0.0).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.expr("nullif(l_discount, 0.0)").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        (F.col("l_extendedprice") * (F.lit(1.0) + F.col("l_tax")) - F.lit(500.0)).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(0.0).alias("airport_fee"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_lineitem(table(spark, sf_dir, "lineitem"))


def mill_trips(spark: SparkSession, sf_dir: str, with_nan: bool) -> DataFrame:
    """Trips whose distance has three decimals and whose other measures are whole quarters, so that
    any order of summing gives the same; with ``with_nan`` third lines carry no distance (NaN) and
    fourth lines no total."""
    t = trips(spark, sf_dir)
    line, nan = F.col("payment_type"), F.lit(float("nan"))
    distance, total = F.col("trip_distance") / 8, F.col("trip_distance") * 4
    return t.withColumns(
        {
            "trip_distance": F.when(line == 3, nan).otherwise(distance) if with_nan else distance,
            "fare_amount": F.col("trip_distance") * 2,
            "tip_amount": F.when(line % 2 == 0, F.lit(0.25)).otherwise(F.lit(1.5)),
            "total_amount": F.when(line == 4, nan).otherwise(total) if with_nan else total,
        }
    )


def repeated_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips told apart by vendor, zone, line and flag only, so that many rows are equal."""
    now = F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")
    t = trips(spark, sf_dir)
    return t.withColumns(
        {
            "VendorID": F.when(F.col("payment_type") == 6, F.lit(None)).otherwise(F.col("VendorID") % 3),
            "tpep_pickup_datetime": now,
            "tpep_dropoff_datetime": now,
            "trip_distance": F.lit(2.0),
            "PULocationID": F.col("PULocationID") % 5,
            "DOLocationID": F.lit(0).cast("bigint"),
            "fare_amount": F.lit(10.0),
            "tip_amount": F.lit(1.0),
            "total_amount": F.lit(12.0),
        }
    )


def raw_trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Trips as an API delivers them: every value text, ISO times with a ``T``. Some values
    are malformed on purpose so that casts have something to reject: a unit suffix on the
    distance of first lines of returned items (flag ``n``, payment type 1) and a letter
    prefix on the vendor of seventh lines. The vendor of second lines is a whole number with a
    decimal point, which is no reject."""
    t = trips_from_lineitem(lineitem)
    out = []
    for c in t.columns:
        v = F.col(c)
        if c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
            # zone-free text of the wall-clock time, ISO form with a T
            s = F.replace(v.cast("string"), F.lit(" "), F.lit("T"))
        elif c == "trip_distance":
            bad = (F.col("store_and_fwd_flag") == "n") & (F.col("payment_type") == 1)
            s = F.when(bad, F.concat(v.cast("string"), F.lit(" mi"))).otherwise(v.cast("string"))
        elif c == "VendorID":
            bad = F.col("payment_type") == 7
            s = F.when(bad, F.concat(F.lit("V"), v.cast("string"))).otherwise(v.cast("string"))
            s = F.when(F.col("payment_type") == 2, F.concat(v.cast("string"), F.lit(".0"))).otherwise(s)
        else:
            s = v.cast("string")
        out.append(s.alias(c))
    return t.select(*out)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips_from_lineitem(table(spark, sf_dir, "lineitem"))


def sales_bronze_rows(lineitem: DataFrame) -> DataFrame:
    """Sales extract role: text columns with upper-case header names; date as dd/MM/yyyy."""
    return lineitem.select(
        F.col("l_partkey").cast("string").alias("CODIGO_PRODUTO"),
        F.col("l_suppkey").cast("string").alias("CODIGO_REGIAO"),
        F.date_format(F.to_date(F.col("l_shipdate")), "dd/MM/yyyy").alias("DATA_VENDA"),
        F.col("l_quantity").cast("bigint").cast("string").alias("QTDE_VENDA"),
        F.col("l_extendedprice").cast("string").alias("VALOR_VENDA"),
    )


def product_bronze_rows(part: DataFrame) -> DataFrame:
    """Product extract role: code, description, short code (brand)."""
    return part.select(
        F.col("p_partkey").cast("string").alias("CODIGO_PRODUTO"),
        F.col("p_name").alias("DESCRICAO_PRODUTO"),
        F.col("p_brand").alias("SIGLA_PRODUTO"),
    )


def region_bronze_rows(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Region extract role: supplier code and name, with its nation's name as country."""
    n = nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return supplier.join(n, "s_nationkey", "left").select(
        F.col("s_suppkey").cast("string").alias("CODIGO_REGIAO"),
        F.col("s_name").alias("DESCRICAO_REGIAO"),
        F.col("n_name").alias("NOME_PAIS"),
    )


def _fitting(value, width: int):
    """Text of at most ``width`` characters; a longer one fails instead of being cut."""
    return F.when(F.length(value) > width, F.raise_error(F.concat(F.lit(f"longer than {width}: "), value))).otherwise(value)


def price_lines_from_part(part: DataFrame) -> DataFrame:
    """Price-list role: one 136-character record per part.

    Code (10, zero-padded), 5 blanks, description (101, blank-padded), update date as
    DDMMYYYY (2020-12-01 plus ``p_size`` days), price as 10 characters of cents (promo parts
    carry the letter ``L`` in place of the first digit), 2 blanks. The records of size 7 are cut
    before the price, as by a broken transfer. Values that do not fit their field fail.
    """
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string")
    lead = F.when(F.col("p_type") == "PROMO", F.lit("L")).otherwise(F.lit("0"))
    desc = F.concat_ws(" ", F.upper(F.col("p_name")), F.col("p_brand"), F.col("p_type"))
    day = F.date_add(F.lit("2020-12-01").cast("date"), F.col("p_size"))
    record = F.concat(
        F.lpad(_fitting(F.col("p_partkey").cast("string"), 10), 10, "0"),
        F.lit(" " * 5),
        F.rpad(_fitting(desc, 101), 101, " "),
        F.date_format(day, "ddMMyyyy"),
        lead,
        F.lpad(_fitting(cents, 9), 9, "0"),
        F.lit(" " * 2),
    )
    return part.select(F.when(F.col("p_size") == 7, F.substring(record, 1, 124)).otherwise(record).alias("value"))


def event_pages_rows(events: DataFrame) -> DataFrame:
    """Events as text, the way a paged JSON API delivers them."""
    return events.select(*[F.col(c).cast("string").alias(c) for c in events.columns])


#: Records of a page, the most that the trips' API gives in one request.
PAGE_RECORDS = 50_000


def land_pages(rows: DataFrame, folder: str) -> None:
    """Add rows to a landing folder as pages of JSON lines (a DataFrame of one text column: the lines as they
    are), compressed, which takes a tenth of the text; pages are small, because one task reads a compressed one whole."""
    writer = rows.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", PAGE_RECORDS)
    if rows.columns == ["value"]:
        writer.text(folder)
    else:
        writer.json(folder)


# Contract of the events role (zone-free times, as stored in the test table).
EVENT_CONTRACT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
EVENT_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in EVENT_CONTRACT.fields])


def land_event_pages(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Land the events as JSON pages in ``folder``: one write of all non-error events, and
    one of the error events without the ``props`` key (a page whose rows all lack a field)."""
    rows = event_pages_rows(table(spark, sf_dir, "events"))
    rows.filter(~F.col("event_type").eqNullSafe("error")).write.mode("append").json(folder)
    rows.filter(F.col("event_type") == "error").drop("props").write.mode("append").json(folder)
    return folder


def sales_silver_from_lineitem(lineitem: DataFrame, run_ts: str, ntz: bool = True) -> DataFrame:
    """Typed sales rows (the silver table's role) straight from the line items."""
    kind = "timestamp_ntz" if ntz else "timestamp"
    return lineitem.select(
        F.col("l_partkey").cast("bigint").alias("codigo_produto"),
        F.col("l_suppkey").cast("bigint").alias("codigo_regiao"),
        F.to_date(F.col("l_shipdate")).alias("data_venda"),
        F.col("l_quantity").cast("bigint").alias("qtde_venda"),
        F.col("l_extendedprice").cast("float").alias("valor_venda"),
        F.lit(run_ts).cast(kind).alias("data_atualizacao"),
    )
