"""Sales star schema: silver and gold fact, keys, calendar (FIXTURES §4, §5)."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from strata.operators import keys
from strata.plans import sales
from strata.sources import series

# A 14-row sales extract made by rule: products 101, 104, ..., regions 201, 204, ...,
# quantity 100 + 17 i, value = 999 x quantity, all (product, region, date) triples distinct.
SALES = [
    (str(101 + 3 * (i % 7)), str(201 + 3 * (i % 4)), f"{1 + 2 * i:02d}/{1 + i // 3:02d}/2021", str(100 + 17 * i))
    for i in range(14)
]
QTY_TOTAL = sum(100 + 17 * i for i in range(14))  # 2947


def _bronze(spark):
    rows = [(p, r, d, q, str(999 * int(q))) for p, r, d, q in SALES]
    return spark.createDataFrame(rows, "CODIGO_PRODUTO string, CODIGO_REGIAO string, DATA_VENDA string, QTDE_VENDA string, VALOR_VENDA string")


def test_silver_fact_types(spark):
    silver = sales.silver_fact(_bronze(spark), "2024-01-01 00:00:00")
    assert silver.columns == ["codigo_produto", "codigo_regiao", "data_venda", "qtde_venda", "valor_venda", "data_atualizacao"]
    assert [f.dataType.simpleString() for f in silver.schema.fields] == ["bigint", "bigint", "date", "bigint", "float", "timestamp"]
    assert silver.filter(F.col("qtde_venda") == 168).first()["data_venda"] == dt.date(2021, 2, 9)


def test_gold_fact(spark):
    gold = sales.gold_fact(sales.silver_fact(_bronze(spark)))
    assert gold.columns == ["codigo_produto", "codigo_regiao", "qtde_venda", "valor_venda", "data_atualizacao", "id_data_venda", "id_fa_venda"]
    agg = gold.agg(F.count("*").alias("n"), F.sum("qtde_venda").alias("q"), F.sum("valor_venda").alias("v")).first()
    assert (agg["n"], agg["q"], agg["v"]) == (14, QTY_TOTAL, 999.0 * QTY_TOTAL)
    first = gold.filter((F.col("codigo_produto") == 101) & (F.col("codigo_regiao") == 201)).first()
    assert (first["id_data_venda"], first["id_fa_venda"]) == (20210101, 10120120210101)


def test_key_collision_detected(spark):
    df = spark.createDataFrame([(1, 12, 20210101), (11, 2, 20210101), (3, 4, 20210101)], "p long, r long, d long")
    df = df.withColumn("k", keys.concat_key(["p", "r", "d"]))
    col = keys.key_collisions(df, "k", ["p", "r", "d"]).collect()
    assert [(c["k"], c["natural_keys"], c["rows"]) for c in col] == [(11220210101, 2, 2)]
    fast = keys.key_collisions(df, "k", ["p", "r", "d"], natural_unique=True).collect()
    assert [(c["k"], c["natural_keys"], c["rows"]) for c in fast] == [(11220210101, 2, 2)]
    padded = df.select(keys.padded_key(["p", "r", "d"], [10, 10, 8]).alias("k")).distinct().count()
    assert padded == 3


def test_calendar(spark):
    days = series.calendar_days(spark, sales.CALENDAR_START, sales.CALENDAR_STOP)
    cal = sales.calendar_table(days, run_ts="2024-01-01 00:00:00")
    assert cal.columns == ["data", "id_data", "dia", "mes", "ano", "mesano", "dt_data_update"]
    agg = cal.agg(F.count("*").alias("n"), F.min("id_data").alias("lo"), F.max("id_data").alias("hi"), F.countDistinct("id_data").alias("d")).first()
    assert (agg["n"], agg["lo"], agg["hi"], agg["d"]) == (10958, 20000101, 20291231, 10958)
    first = cal.filter(F.col("id_data") == 20000101).first()
    assert (first["dia"], first["mes"], first["ano"], first["mesano"]) == (1, 1, 2000, 12000)


def test_calendar_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        days = series.calendar_days(spark, sales.CALENDAR_START, sales.CALENDAR_STOP)
        cal = sales.calendar_table(days)
        assert cal.select("id_data").distinct().count() == 10958
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_generate_series_bounds(spark):
    s = series.generate_series(spark, "2023-01-01 00:00:00", "2023-01-01 03:00:00", 3600)
    assert [r["data"] for r in s.orderBy("data").collect()] == [dt.datetime(2023, 1, 1, h) for h in range(3)]


def test_hash_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, 12, 20210101), (11, 2, 20210101)], "p long, r long, d long")
    a = [r[0] for r in df.select(keys.hash_key(["p", "r", "d"])).collect()]
    b = [r[0] for r in df.select(keys.hash_key(["p", "r", "d"])).collect()]
    assert a == b and a[0] != a[1]


# Line items of which the second and third make fact keys of 19 and 20 digits that no bigint holds;
# the first two rows are one fact, which shares its key with the fact of the fifth.
WIDE_ITEMS = [
    (112, 1, "1998-08-02", 4.0, 10.5), (112, 1, "1998-08-02", 3.0, 2.25), (999999, 99999, "1998-08-03", 5.0, 8.0),
    (1199999, 59999, "1998-01-05", 6.0, 7.5), (11, 21, "1998-08-02", 1.0, 1.0), (1199999, 59999, None, 2.0, 3.0),
]


def _equals_sql(spark, tmp_dir, name):
    """Whether a query over the wide line items gives what its SQL does."""
    import __spark_entry__ as e
    from tests.oracle_harness import compare, duck

    rows = [(1, p, s, 1, q, x, 0.0, 0.0, "N", "O", d and dt.datetime.fromisoformat(d)) for p, s, d, q, x in WIDE_ITEMS]
    kind = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(tmp_dir + "/items")
    os.makedirs(tmp_dir + "/sf")
    os.rename(glob.glob(tmp_dir + "/items/*.parquet")[0], tmp_dir + "/sf/lineitem.parquet")
    return compare(spark, duck(tmp_dir + "/sf"), name, tmp_dir + "/sf", e.queries()[name], e.oracle_sql()[name])


def test_gold_fact_keeps_facts_whose_key_is_too_long(spark, tmp_dir):
    assert _equals_sql(spark, tmp_dir, "fact_gold") == (True, "5 rows")
    wide = spark.createDataFrame([(1199999, 59999, dt.date(2021, 1, 1), 2, 3.0)], "codigo_produto long, codigo_regiao long, data_venda date, qtde_venda long, valor_venda float")
    row = sales.gold_fact(wide).first()
    assert (row["codigo_produto"], row["qtde_venda"], row["id_data_venda"], row["id_fa_venda"]) == (1199999, 2, 20210101, None)


def test_partitioned_gold_fact_keeps_facts_whose_key_is_too_long(spark, tmp_dir):
    assert _equals_sql(spark, tmp_dir, "fact_gold_partitioned_upsert") == (True, "5 rows")


def test_fact_jobs_keep_facts_whose_key_is_too_long(spark, tmp_dir):
    assert _equals_sql(spark, tmp_dir, "fact_jobs") == (True, "5 rows")


def test_key_collisions_of_facts_whose_key_is_too_long(spark, tmp_dir):
    assert _equals_sql(spark, tmp_dir, "fact_key_collisions") == (True, "2 rows")
