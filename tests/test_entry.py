"""Driver contract and the differential check of every registered query against DuckDB."""

import re

import pytest

import __spark_entry__ as entry_mod
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
#: Queries of the optional corpus operators have tests of their own.
OPTIONAL = re.compile(r"op\d+_|pipeline$")


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 5
    assert df.columns[0] == "dia"


def test_every_query_has_oracle_or_is_listed():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert not [n for n in set(q) - set(o) if not OPTIONAL.match(n)]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in sorted(entry_mod.queries()) if not OPTIONAL.match(n)])
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF, entry_mod.queries()[name], entry_mod.oracle_sql()[name])
    assert ok, msg
