"""Price list: fixed-width text -> typed bronze price table.

Two layouts are offered because the record layout is not documented. ``as_read`` reads the
fields exactly where the original job sliced them (its price slice starts one character late,
so ``0000006272`` reads as 627.20, and its description keeps 45 untrimmed characters);
``ten_digit`` reads what the data show: a 101-character description and a 10-digit price with
two implied decimals at characters 125-134. Which one is right is for the data owner to say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.schema import lower_columns, stamp
from strata.sources.files import Field, Layout, parse_fixed_width

# --- fixed values: price-list record layouts (1-based start, length) ---------------------
AS_READ = Layout(
    "as_read",
    (
        Field("CD_PRODUTO", 1, 10),
        Field("DS_PRODUTO", 16, 45),
        Field("DIA", 117, 2),
        Field("MES", 119, 2),
        Field("ANO", 121, 4),
        Field("PRECO_PRODUTO", 126, 10),
    ),
)
TEN_DIGIT = Layout(
    "ten_digit",
    (
        Field("CD_PRODUTO", 1, 10),
        Field("DS_PRODUTO", 16, 101, rtrim=True),
        Field("DIA", 117, 2),
        Field("MES", 119, 2),
        Field("ANO", 121, 4),
        Field("PRECO_PRODUTO", 125, 10),
    ),
)
LAYOUTS = {AS_READ.name: AS_READ, TEN_DIGIT.name: TEN_DIGIT}
DATE_FORMAT = "dd-MM-yyyy"
PRICE_TYPE = "decimal(15,2)"
KEY = "cd_produto"
# --- end fixed values ---------------------------------------------------------------------


def price_fields(lines: DataFrame, layout: Layout) -> DataFrame:
    """Text fields of each record: code, description, ``dd-MM-yyyy`` date text, price text."""
    p = parse_fixed_width(lines, layout)
    return p.select(
        "CD_PRODUTO",
        "DS_PRODUTO",
        F.concat(F.col("DIA"), F.lit("-"), F.col("MES"), F.lit("-"), F.col("ANO")).alias("ATUALIZACAO"),
        "PRECO_PRODUTO",
    )


def price_value(text: F.Column) -> F.Column:
    """Eight whole digits, a point, two decimals; blanks trimmed; NULL if not a number."""
    return F.concat(F.substring(text, 1, 8), F.lit("."), F.substring(text, 9, 2)).try_cast(PRICE_TYPE)


def price_bronze(lines: DataFrame, layout: Layout, run_ts=None, ntz: bool = False) -> DataFrame:
    """Typed price rows with lower-case names: text fields, ``vl_preco_produto``,
    ``dt_atualizacao`` and the load stamp ``dt_inclusao``."""
    df = price_fields(lines, layout)
    df = df.withColumns(
        {
            "vl_preco_produto": price_value(F.col("PRECO_PRODUTO")),
            "dt_atualizacao": F.try_to_date(F.col("ATUALIZACAO"), DATE_FORMAT),
        }
    )
    return lower_columns(stamp(df, "dt_inclusao", run_ts, ntz))


def price_rejects(lines: DataFrame, layout: Layout) -> DataFrame:
    """Records whose price or date text does not parse, with the failing field names. A record
    that ends before its price field does has no price that can be trusted and is one too."""
    df = price_fields(lines, layout)
    width = next(f.length for f in layout.fields if f.name == "PRECO_PRODUTO")
    price = F.col("PRECO_PRODUTO")
    bad_price = (F.length(price) < width) | ((F.trim(price) != "") & price_value(price).isNull())
    bad_date = F.try_to_date(F.col("ATUALIZACAO"), DATE_FORMAT).isNull()
    reason = F.concat_ws(
        ",",
        F.when(bad_price, F.lit("vl_preco_produto")),
        F.when(bad_date, F.lit("dt_atualizacao")),
    )
    return lower_columns(df.withColumn("REJECTED_COLUMNS", reason)).filter(F.col("rejected_columns") != "")
