"""Declared schemas: typed projection with reject capture, renames and load stamps.

Casts are ``try_cast``: a value that does not parse becomes NULL (as casts did before ANSI
mode) and the row is reported by ``schema_rejects`` instead of failing the job. Text of a whole
number with a decimal point (``1.0``) reads as that number; a real fraction is a reject.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _resolve(df: DataFrame, name: str) -> str:
    """Column name in ``df`` matching ``name`` case-insensitively."""
    lower = {c.lower(): c for c in df.columns}
    try:
        return lower[name.lower()]
    except KeyError:
        raise ValueError(f"column {name!r} not in {df.columns}") from None


#: A whole number, blanks around it and zeros behind a point allowed.
_WHOLE = r"^[\x00-\x20\x7F]*([+-]?[0-9]+)(?:\.0*)?[\x00-\x20\x7F]*\z"


def try_typed(raw: Column, source: T.DataType, target: T.DataType) -> Column:
    """``try_cast``; for text read as an integral type also ``1.0``, which ``try_cast`` refuses.

    Text that is no whole number never reaches the cast: a failing ``try_cast`` to an integral type
    costs about 9 microseconds (it makes an error and drops it), the pattern a tenth of one."""
    if isinstance(source, T.StringType) and isinstance(target, T.IntegralType):
        return F.nullif(F.regexp_extract(raw, _WHOLE, 1), F.lit("")).try_cast(target)
    return raw.try_cast(target)


def _typed(df: DataFrame, field: T.StructField, missing: str) -> Column:
    lower = {c.lower(): c for c in df.columns}
    src = lower.get(field.name.lower())
    if src is None:
        if missing == "null":
            return F.lit(None).cast(field.dataType).alias(field.name)
        raise ValueError(f"column {field.name!r} not in {df.columns}")
    if df.schema[src].dataType == field.dataType:
        return F.col(src).alias(field.name)
    return try_typed(F.col(src), df.schema[src].dataType, field.dataType).alias(field.name)


def apply_schema(df: DataFrame, schema: T.StructType, missing: str = "error") -> DataFrame:
    """Project ``df`` to ``schema``: names and order from the schema, values ``try_cast``.

    Names resolve case-insensitively; ``missing="null"`` fills absent columns with NULL.
    """
    return df.select(*[_typed(df, f, missing) for f in schema.fields])


def _cast_columns(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with the casts beside its columns, and for each cast column whether a present value failed.

    Each value is cast once, in a projection of its own; the conditions read its results."""
    cast = [(f"__strata_t{i}", f, _resolve(df, f.name)) for i, f in enumerate(schema.fields)]
    cast = [(t, f, src) for t, f, src in cast if df.schema[src].dataType != f.dataType]
    wide = df.withColumns({t: try_typed(F.col(src), df.schema[src].dataType, f.dataType) for t, f, src in cast})
    return wide, {f.name: F.col(t).isNull() & F.col(src).isNotNull() for t, f, src in cast}


def _once(value: Column) -> Column:
    """``value``, kept from being copied into filters below its projection: a pushed filter would
    make every cast anew, in one method too large for the JIT (measured: 10.4 s for 2.9 s)."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def schema_rejects(
    df: DataFrame, schema: T.StructType, reason_col: str = "rejected_columns"
) -> DataFrame:
    """Input rows with at least one present value that does not cast, plus the failing
    column names (comma-separated, schema order)."""
    wide, failed = _cast_columns(df, schema)
    if not failed:
        return df.withColumn(reason_col, F.lit("")).where(F.lit(False))
    reason = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in failed.items()])
    return wide.select(*df.columns, _once(reason).alias(reason_col)).filter(F.col(reason_col) != "")


def reject_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One aggregate pass: ``(column, rejects)`` for every schema column."""
    wide, failed = _cast_columns(df, schema)
    counts = wide.agg(*[F.count_if(failed[f.name] if f.name in failed else F.lit(False)).alias(f.name) for f in schema.fields])
    stack = ", ".join(f"'{f.name}', `{f.name}`" for f in schema.fields)
    return counts.selectExpr(f"stack({len(schema.fields)}, {stack}) as (column, rejects)")


def cast_with_errors(df: DataFrame, schema: T.StructType, errors_col: str = "cast_errors", missing: str = "error") -> DataFrame:
    """``apply_schema`` plus the names of the columns whose present value does not cast, as an array
    (empty for a good row), each value cast once: one projection casts, the next compares."""
    given = {c.lower(): c for c in df.columns}
    absent = [f.name.lower() not in given for f in schema.fields]
    raw = [F.lit(True) if gone else F.col(given[f.name.lower()]).isNull() for f, gone in zip(schema.fields, absent)]
    cast = df.select(
        *[_typed(df, f, missing).alias(f"t{i}") for i, f in enumerate(schema.fields)], *[r.alias(f"n{i}") for i, r in enumerate(raw)]
    )
    failed = [F.when(F.col(f"t{i}").isNull() & ~F.col(f"n{i}"), F.lit(f.name)) for i, f in enumerate(schema.fields)]
    return cast.select(*[F.col(f"t{i}").alias(f.name) for i, f in enumerate(schema.fields)], _once(F.array_compact(F.array(*failed))).alias(errors_col))


def cast_columns(df: DataFrame, types: dict[str, T.DataType | str]) -> DataFrame:
    """In-place ``try_cast`` of named columns (order kept)."""
    resolved = {_resolve(df, c): t for c, t in types.items()}  # keep the table's own names
    kind = lambda t: T.DataType.fromDDL(t) if isinstance(t, str) else t
    return df.withColumns({c: try_typed(F.col(c), df.schema[c].dataType, kind(t)) for c, t in resolved.items()})


def lower_columns(df: DataFrame) -> DataFrame:
    """All column names in lower case (one projection)."""
    return df.toDF(*[c.lower() for c in df.columns])


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project named columns, resolving names case-insensitively and keeping the given names."""
    return df.select(*[F.col(_resolve(df, c)).alias(c) for c in columns])


def stamp(
    df: DataFrame,
    name: str,
    run_ts: dt.datetime | str | None = None,
    ntz: bool = False,
) -> DataFrame:
    """Load stamp column: ``current_timestamp()`` by default, or a fixed run time so that a
    run is reproducible. ``ntz=True`` gives a zone-free timestamp."""
    kind = "timestamp_ntz" if ntz else "timestamp"
    if run_ts is None:
        value = F.current_timestamp().cast(kind)
    else:
        text = run_ts.isoformat(sep=" ") if isinstance(run_ts, dt.datetime) else str(run_ts)
        value = F.lit(text).cast(kind)
    return df.withColumn(name, value)
