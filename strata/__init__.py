"""strata: layered (bronze / silver / gold) table recipes as plain Spark DataFrame functions.

Every public function takes and returns DataFrames (or Columns); I/O happens only in
``strata.sources``, ``strata.sinks`` and ``strata.streaming``. Nothing is collected to the driver.
"""

from strata.functions.exact import exact_avg, exact_sum
from strata.operators.keys import concat_key, hash_key, key_collisions, padded_key
from strata.operators.marts import Metric, metrics_by, rollup_fact, top_k
from strata.operators.merge import DuplicateMatchError, delete_all, insert_new, refresh, upsert
from strata.operators.quality import (
    add_rule,
    classify,
    quality_filter,
    quality_report,
    removed_all,
    removed_distinct,
    split_by_rule,
)
from strata.operators.schema import apply_schema, cast_columns, lower_columns, reject_counts, schema_rejects, stamp
from strata.sources.files import (
    filter_time_range,
    parse_fixed_width,
    register_csv,
    scan_csv,
    scan_json_pages,
    scan_text,
    union_pages,
)
from strata.sources.series import calendar_days, generate_series
from strata.sources.tables import ensure_layers, scan_path, scan_table

__version__ = "0.1.0"

__all__ = [
    "DuplicateMatchError",
    "Metric",
    "add_rule",
    "apply_schema",
    "calendar_days",
    "cast_columns",
    "classify",
    "concat_key",
    "delete_all",
    "ensure_layers",
    "exact_avg",
    "exact_sum",
    "filter_time_range",
    "generate_series",
    "hash_key",
    "insert_new",
    "key_collisions",
    "lower_columns",
    "metrics_by",
    "padded_key",
    "parse_fixed_width",
    "quality_filter",
    "quality_report",
    "refresh",
    "register_csv",
    "reject_counts",
    "removed_all",
    "removed_distinct",
    "rollup_fact",
    "scan_csv",
    "scan_json_pages",
    "scan_path",
    "scan_table",
    "scan_text",
    "schema_rejects",
    "split_by_rule",
    "stamp",
    "top_k",
    "union_pages",
    "upsert",
]
