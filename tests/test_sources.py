"""File sources: fixed-width, CSV, JSON pages, time range, union."""

import datetime as dt
import decimal
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import prices
from strata.sources import files

D = decimal.Decimal


def _line(code, desc, ddmmyyyy, price10):
    line = code + " " * 5 + desc.ljust(101) + ddmmyyyy + price10 + " " * 2
    assert len(line) == 136
    return line


# Own copies of three records in the price-list layout (FIXTURES §1 cases).
LINES = [
    _line("0000318978", "PAPER TOWEL DOUBLE 230 MINI PACK OF EIGHT WITH EIGHT UNITS EACH", "18122020", "0000006272"),
    _line("0000176099", "SOAP POWDER SUN YELLOW", "17122020", "0000000737"),
    _line("0000176100", "SOAP POWDER SUN YELLOW LARGE", "17122020", "L000000073"),
]


def _write_lines(tmp_dir):
    p = os.path.join(tmp_dir, "prices.txt")
    with open(p, "w") as fh:
        fh.write("\n".join(LINES) + "\n")
    return p


def test_fixed_width_as_read(spark, tmp_dir):
    lines = files.scan_text(spark, _write_lines(tmp_dir))
    out = {r["cd_produto"]: r for r in prices.price_bronze(lines, prices.AS_READ, "2024-01-01 00:00:00").collect()}
    assert out["0000318978"]["vl_preco_produto"] == D("627.20")
    assert out["0000176099"]["vl_preco_produto"] == D("73.70")
    assert out["0000176100"]["vl_preco_produto"] == D("7.30")
    assert out["0000318978"]["dt_atualizacao"] == dt.date(2020, 12, 18)
    assert out["0000318978"]["atualizacao"] == "18-12-2020"
    assert len(out["0000318978"]["ds_produto"]) == 45
    assert prices.price_rejects(lines, prices.AS_READ).count() == 0


def test_fixed_width_ten_digit(spark, tmp_dir):
    lines = files.scan_text(spark, _write_lines(tmp_dir))
    bronze = prices.price_bronze(lines, prices.TEN_DIGIT)
    assert bronze.columns == ["cd_produto", "ds_produto", "atualizacao", "preco_produto", "vl_preco_produto", "dt_atualizacao", "dt_inclusao"]
    out = {r["cd_produto"]: r for r in bronze.collect()}
    assert out["0000318978"]["vl_preco_produto"] == D("62.72")
    assert out["0000176099"]["vl_preco_produto"] == D("7.37")
    assert out["0000176100"]["vl_preco_produto"] is None
    assert out["0000176099"]["ds_produto"] == "SOAP POWDER SUN YELLOW"
    rej = prices.price_rejects(lines, prices.TEN_DIGIT).collect()
    assert [(r["cd_produto"], r["rejected_columns"]) for r in rej] == [("0000176100", "vl_preco_produto")]


def test_record_cut_before_the_price_is_a_reject(spark):
    cut = spark.createDataFrame([(LINES[0][:124],), (LINES[0][:130],), (LINES[0],)], "value string")
    rej = prices.price_rejects(cut, prices.TEN_DIGIT).collect()
    assert [r["rejected_columns"] for r in rej] == ["vl_preco_produto", "vl_preco_produto"]


def test_parse_is_distributed(spark, tmp_dir):
    lines = files.scan_text(spark, _write_lines(tmp_dir))
    plan = prices.price_bronze(lines, prices.TEN_DIGIT)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in plan and "Exchange" not in plan


def test_csv_with_bom_and_crlf(spark, tmp_dir):
    p = os.path.join(tmp_dir, "produto.csv")
    with open(p, "wb") as fh:
        fh.write("﻿CODIGO_PRODUTO;DESCRICAO_PRODUTO;SIGLA_PRODUTO\r\n101;ZINC;ZI\r\n104;COPPER;CO\r\n".encode())
    df = files.scan_csv(spark, p)
    assert df.columns == ["CODIGO_PRODUTO", "DESCRICAO_PRODUTO", "SIGLA_PRODUTO"]
    assert all(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
    assert [tuple(r) for r in df.collect()] == [("101", "ZINC", "ZI"), ("104", "COPPER", "CO")]


def test_register_csv_table(spark, tmp_dir):
    p = os.path.join(tmp_dir, "regiao.csv")
    with open(p, "w") as fh:
        fh.write("CODIGO_REGIAO;DESCRICAO_REGIAO;NOME_PAIS\n201;SOUTH;BRAZIL\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS strata_test_bronze")
    t = files.register_csv(spark, "strata_test_bronze", "di_regiao", p)
    assert t.select("codigo_regiao").first()[0] == "201"  # case-insensitive names


SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("VendorID", "fare_amount", "airport_fee")])


def test_json_pages_missing_key(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pages")
    os.makedirs(d)
    with open(os.path.join(d, "page-0.json"), "w") as fh:
        fh.write('[{"VendorID": "1", "fare_amount": "10.0", "airport_fee": "1.25"}, {"VendorID": "2", "fare_amount": "5"}]')
    with open(os.path.join(d, "page-1.json"), "w") as fh:
        fh.write('[{"VendorID": "3", "fare_amount": "7.5"}]')
    out = files.scan_json_pages(spark, d, SCHEMA, multiline=True)
    assert sorted(tuple(r) for r in out.collect()) == [("1", "10.0", "1.25"), ("2", "5", None), ("3", "7.5", None)]


def test_union_pages_fills_missing(spark):
    a = spark.createDataFrame([("1", "1.25")], "VendorID string, airport_fee string")
    b = spark.createDataFrame([("2",)], "VendorID string")
    out = files.union_pages([a, b])
    assert sorted(tuple(r) for r in out.collect()) == [("1", "1.25"), ("2", None)]


def test_empty_source_has_schema(spark):
    e = files.empty_like(spark, SCHEMA)
    assert e.count() == 0 and e.schema == SCHEMA


def test_time_range_edges(spark):
    df = spark.createDataFrame(
        [("2023-01-01T00:00:00.000",), ("2023-04-30T23:59:59.000",), ("2023-04-30T23:59:59.500",), ("2022-12-31T23:59:59",)],
        "t string",
    )
    out = files.filter_time_range(df, "t", "2023-01-01T00:00:00", "2023-04-30T23:59:59")
    assert sorted(r["t"] for r in out.collect()) == ["2023-01-01T00:00:00.000", "2023-04-30T23:59:59.000"]
    ts = df.select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert files.filter_time_range(ts, "t", "2023-01-01T00:00:00", "2023-04-30T23:59:59").count() == 2
