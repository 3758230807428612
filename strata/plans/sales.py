"""Sales star schema: CSV bronze -> typed silver -> gold dimensions, calendar and fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import date_key, date_part_long
from strata.operators.keys import concat_key
from strata.operators.schema import select_columns, stamp

# --- fixed values: table columns, keys and text formats of the star schema ---------------
PRODUCT_COLUMNS = ("codigo_produto", "descricao_produto", "sigla_produto")
PRODUCT_KEY = "codigo_produto"
REGION_COLUMNS = ("codigo_regiao", "descricao_regiao", "nome_pais")
REGION_KEY = "codigo_regiao"
SALE_COLUMNS = ("codigo_produto", "codigo_regiao", "data_venda", "qtde_venda", "valor_venda")
FACT_GRAIN = ("codigo_produto", "codigo_regiao", "data_venda")
FACT_KEY = "id_fa_venda"
FACT_DATE_KEY = "id_data_venda"
CALENDAR_KEY = "id_data"
STAMP = "data_atualizacao"
CALENDAR_STAMP = "dt_data_update"
SALE_DATE_FORMAT = "dd/MM/yyyy"
CALENDAR_START = "2000-01-01"
CALENDAR_STOP = "2030-01-01"
# --- end fixed values ---------------------------------------------------------------------

RunTs = dt.datetime | str | None


def silver_dimension(
    bronze: DataFrame, columns: tuple[str, ...], key: str, run_ts: RunTs = None, ntz: bool = False
) -> DataFrame:
    """Project the dimension's columns, stamp the load, read the key as bigint."""
    df = stamp(select_columns(bronze, columns), STAMP, run_ts, ntz)
    return df.withColumn(key, F.col(key).try_cast("bigint"))


def gold_dimension(
    silver: DataFrame, columns: tuple[str, ...], key: str, run_ts: RunTs = None, ntz: bool = False
) -> DataFrame:
    """Same columns as silver with a fresh load stamp."""
    return silver_dimension(silver, columns, key, run_ts, ntz)


def silver_fact(
    bronze: DataFrame, run_ts: RunTs = None, ntz: bool = False, value_type: str = "float"
) -> DataFrame:
    """Typed sales rows: codes and quantity bigint, date from dd/MM/yyyy, value ``value_type``
    (float as recorded; ``decimal(15,2)`` avoids float rounding)."""
    df = stamp(select_columns(bronze, SALE_COLUMNS), STAMP, run_ts, ntz)
    return df.withColumns(
        {
            "codigo_produto": F.col("codigo_produto").try_cast("bigint"),
            "codigo_regiao": F.col("codigo_regiao").try_cast("bigint"),
            "qtde_venda": F.col("qtde_venda").try_cast("bigint"),
            "data_venda": F.try_to_date(F.col("data_venda"), SALE_DATE_FORMAT),
            "valor_venda": F.col("valor_venda").try_cast(value_type),
        }
    )


def gold_fact(silver: DataFrame, run_ts: RunTs = None, ntz: bool = False) -> DataFrame:
    """Roll up to (product, region, date), add the date key and the concatenated fact key, which is
    NULL where its digits do not fit a bigint; the product, region and date key stay the fact's key."""
    g = silver.groupBy(*FACT_GRAIN).agg(
        F.sum("qtde_venda").alias("qtde_venda"), F.sum("valor_venda").alias("valor_venda")
    )
    g = stamp(g, STAMP, run_ts, ntz)
    g = g.withColumn(FACT_DATE_KEY, date_key(F.col("data_venda")))
    g = g.withColumn(FACT_KEY, concat_key(["codigo_produto", "codigo_regiao", FACT_DATE_KEY], too_long="null"))
    return g.drop("data_venda")


def calendar_table(days: DataFrame, day_col: str = "day", run_ts: RunTs = None, ntz: bool = False) -> DataFrame:
    """Calendar dimension from a DATE column: ``data`` (midnight), yyyyMMdd key, day, month,
    year and ``MMyyyy`` (read as a number, so January 2000 is 12000)."""
    kind = "timestamp_ntz" if ntz else "timestamp"
    d = F.col(day_col)
    df = days.select(
        d.cast(kind).alias("data"),
        date_key(d).alias(CALENDAR_KEY),
        date_part_long(d, "dd").alias("dia"),
        date_part_long(d, "MM").alias("mes"),
        date_part_long(d, "yyyy").alias("ano"),
        date_part_long(d, "MMyyyy").alias("mesano"),
    )
    return stamp(df, CALENDAR_STAMP, run_ts, ntz)
