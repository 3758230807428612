"""Differential check: a registered Spark query against its DuckDB oracle SQL.

Compares column names (sorted), row count and the multiset of rows (exact values).
Usable from tests and as a script: ``python tests/oracle_harness.py /root/testdata/sf0.01 [names]``;
``HARNESS_TZ=America/Sao_Paulo`` runs the Spark side under another session time zone.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        return (2, repr(float(v)))
    if isinstance(v, int):
        return (2, repr(float(v)) if abs(v) < 2**53 else str(v))
    if isinstance(v, decimal.Decimal):
        return (3, str(v.normalize()) if v == v else "nan")
    if isinstance(v, dt.datetime):
        return (4, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (5, v.isoformat())
    return (6, str(v))


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str, fn, sql: str) -> tuple[bool, str]:
    sdf = fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = _rows(s_rows, s_cols), _rows(d_rows, d_cols)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(x != y for x, y in zip(a, b))} rows), e.g. {diff}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(e.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("HARNESS_TZ", "UTC"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = e.queries(), e.oracle_sql()
    bad = 0
    for n in names:
        if n not in oracle:
            df = qs[n](spark, sf_dir)
            print(f"{n:32s} NO-ORACLE rows={df.count()}")
            continue
        try:
            ok, msg = compare(spark, con, n, sf_dir, qs[n], oracle[n])
        except Exception as ex:  # report and continue
            ok, msg = False, f"ERROR {type(ex).__name__}: {str(ex)[:400]}"
        bad += not ok
        print(f"{n:32s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
