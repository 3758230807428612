"""Fact keys that survive wide parts."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.operators import keys


def test_wide_keys_are_never_null_or_cut(spark):
    df = spark.createDataFrame([(12345678, 1234567, 20210101), (12345679, 1234567, 20210101)], "p long, r long, d long")
    parts = ["p", "r", "d"]
    with pytest.raises(PySparkException, match="does not fit bigint"):
        df.select(keys.concat_key(parts)).collect()
    for kind in ("decimal(38,0)", "string"):
        got = {str(r[0]) for r in df.select(keys.concat_key(parts, kind)).collect()}
        assert got == {"12345678123456720210101", "12345679123456720210101"}
    assert df.select(keys.concat_key([F.lit(None).cast("long"), "p"])).first()[0] is None


def test_padded_key_refuses_overlong_values_and_missing_widths(spark):
    df = spark.createDataFrame([(12345678901, 1)], "a long, b long")
    with pytest.raises(PySparkException, match="longer than 10"):
        df.select(keys.padded_key(["a", "b"], [10, 3])).collect()
    with pytest.raises(ValueError):
        keys.padded_key(["a", "b"], [10])
    assert df.select(keys.padded_key(["a", "b"], [12, 3])).first()[0] == "012345678901001"


def test_exact_sums_detect_what_they_cannot_hold(spark):
    from strata.functions.exact import exact_sum
    from strata.operators.marts import Metric, metrics_by

    small = spark.createDataFrame([(0.004,)] * 3, "x double")
    assert metrics_by(small, [], [Metric("s", "sum", "x")]).first()[0] == 0.01
    assert small.agg(exact_sum("x", 3)).first()[0] == 0.01
    for rows in ([(float("nan"),)], [(9e16,), (9e16,)]):
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            try:
                with pytest.raises(PySparkException):
                    spark.createDataFrame(rows, "x double").agg(exact_sum("x", 2)).collect()
            finally:
                spark.conf.unset("spark.sql.ansi.enabled")


def test_hash_key_tells_null_parts_apart(spark):
    from strata.operators.keys import hash_key

    rows = [(1, None, 2), (None, 1, 2), (1, 2, None), (None, None, None), (1, 2, 2), (0, None, 0)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    assert df.select(hash_key(["a", "b", "c"]).alias("k")).distinct().count() == len(rows)
