"""Declared schemas, rejects, renames, stamps."""

import datetime as dt

from pyspark.sql import types as T

from strata.operators import schema

CONTRACT = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("pickup", T.TimestampNTZType()),
        T.StructField("fare", T.DoubleType()),
        T.StructField("flag", T.StringType()),
    ]
)


def _raw(spark):
    return spark.createDataFrame(
        [
            ("1", "2023-01-01T00:00:00.000", "10.5", "n"),
            ("x1", "2023-01-02T10:00:00", "abc", "y"),
            (None, "not a time", None, None),
        ],
        "vendorid string, PICKUP string, fare string, flag string",
    )


def test_apply_schema_casts_and_nulls(spark):
    out = schema.apply_schema(_raw(spark), CONTRACT)
    assert out.schema == CONTRACT
    rows = [tuple(r) for r in out.collect()]
    assert rows[0] == (1, dt.datetime(2023, 1, 1), 10.5, "n")
    assert rows[1] == (None, dt.datetime(2023, 1, 2, 10), None, "y")
    assert rows[2] == (None, None, None, None)


def test_rejects_name_failing_columns(spark):
    rej = {r["vendorid"]: r["rejected_columns"] for r in schema.schema_rejects(_raw(spark), CONTRACT).collect()}
    assert rej == {"x1": "VendorID,fare", None: "pickup"}
    counts = {r["column"]: r["rejects"] for r in schema.reject_counts(_raw(spark), CONTRACT).collect()}
    assert counts == {"VendorID": 1, "pickup": 1, "fare": 1, "flag": 0}


def test_missing_column_policy(spark):
    df = spark.createDataFrame([("1",)], "vendorid string")
    out = schema.apply_schema(df, CONTRACT, missing="null")
    assert out.first()["fare"] is None
    try:
        schema.apply_schema(df, CONTRACT)
        raise AssertionError("expected a missing-column error")
    except ValueError:
        pass


def test_lower_and_stamp(spark):
    df = spark.createDataFrame([(1, "a")], "CD_PRODUTO long, Ds_Produto string")
    out = schema.lower_columns(df)
    assert out.columns == ["cd_produto", "ds_produto"]
    st = schema.stamp(out, "dt_inclusao", "2024-01-01 00:00:00", ntz=True)
    assert st.first()["dt_inclusao"] == dt.datetime(2024, 1, 1)
    live = schema.stamp(out, "dt_inclusao")
    assert isinstance(live.schema["dt_inclusao"].dataType, T.TimestampType)


def test_cast_columns_in_place(spark):
    df = spark.createDataFrame([("101", "3", "x")], "codigo string, qtde string, nome string")
    out = schema.cast_columns(df, {"CODIGO": "bigint", "qtde": T.LongType()})
    assert out.columns == ["codigo", "qtde", "nome"]
    assert tuple(out.first()) == (101, 3, "x")


def test_whole_numbers_with_a_point(spark):
    rows = ["1.0", " -2. ", "+3.000", "4.5", "x.0", "", None, "12345678901234567890.0", "7"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, n string")
    kind = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("n", T.LongType())])
    assert [r.n for r in schema.apply_schema(df, kind).orderBy("i").collect()] == [1, -2, 3, None, None, None, None, None, 7]
    assert sorted(r.i for r in schema.schema_rejects(df, kind).collect()) == [3, 4, 5, 7]
    assert [r.n for r in schema.cast_columns(df, {"n": "bigint"}).orderBy("i").collect()][:4] == [1, -2, 3, None]


def test_typed_split_casts_once_and_loses_nothing(spark, tmp_dir):
    from pyspark.sql import types as T

    from strata.operators.schema import cast_with_errors
    from strata.sinks import tables

    rows = [("1", "2.5", "a"), (" 7.0 ", "x", "b"), ("9.5", None, None), (None, "1e3", "c"), ("99999999999999999999", "", "d"), ("+3.", "NaN", "e")]
    df = spark.createDataFrame(rows, "K string, v string, s string")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("s", T.StringType())])
    got = [(r.k, str(r.v), r.s, r.cast_errors) for r in cast_with_errors(df, schema).collect()]
    assert got == [
        (1, "2.5", "a", []), (7, "None", "b", ["v"]), (None, "None", None, ["k"]), (None, "1000.0", "c", []), (None, "None", "d", ["k", "v"]), (3, "nan", "e", []),
    ]
    counts = tables.write_typed_split(df, schema, tmp_dir + "/split")
    assert counts == {"rows": 6, "rejected": 3, "k": 2, "v": 2, "s": 0}
    good = tables.read_typed(spark, tmp_dir + "/split", schema)
    assert good.columns == ["k", "v", "s"] and sorted(r.s for r in good.collect()) == ["a", "c", "e"]
    bad = tables.read_rejects(spark, tmp_dir + "/split")
    assert {(r.s, r.cast_raw.k, r.cast_raw.v) for r in bad.collect()} == {("b", " 7.0 ", "x"), (None, "9.5", None), ("d", "99999999999999999999", "")}
    assert len(df.sparkSession.read.parquet(tmp_dir + "/split").collect()) == 6


def test_rejects_are_cast_once_and_rules_stay_pushed(spark):
    from strata.plans import queries

    sf = "/root/testdata/sf0.001"
    plan = queries.schema_rejects(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    # the filter reads the reason and stays above the casts
    assert plan.index("Filter") < plan.index("monotonically_increasing_id") and plan.count("Filter") == 1
    scan = queries.valid_trips(spark, sf)._jdf.queryExecution().executedPlan().collectLeaves().head()
    pushed = scan.metadata().get("PushedFilters").get()
    for rule in ("IsNotNull(l_suppkey)", "IsNotNull(l_shipdate)", "GreaterThan(l_quantity,0.0)", "GreaterThanOrEqual(l_extendedprice,0.0)"):
        assert rule in pushed
