"""Plan guards over every registered query: no cross joins, no Python in the data path."""

import pytest

import __spark_entry__ as entry_mod
from tests.test_entry import OPTIONAL

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


@pytest.mark.parametrize("name", [n for n in sorted(entry_mod.queries()) if not OPTIONAL.match(n)])
def test_plan_has_no_cross_join_or_python(spark, name):
    df = entry_mod.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in FORBIDDEN:
        assert word not in plan, f"{name}: {word}"


NO_SHUFFLE = [
    "quality_filter", "valid_trips", "invalid_trips", "unclassified_trips", "removed_all",
    "apply_schema", "schema_rejects", "pickup_parts", "normalize_flag", "filter_time_range",
    "fixed_width_as_read", "fixed_width_ten_digit", "fixed_width_rejects", "scan_csv",
    "dim_product_silver", "fact_silver", "scan_json_pages", "lower_columns",
]


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_row_level_queries_do_not_shuffle(spark, name):
    plan = entry_mod.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, name
