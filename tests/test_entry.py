"""Driver contract: entry() and every registered query against its oracle (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF
from tidemark.sources.tables import TABLES


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert set(df.columns) == {"day", "metric", "value"}
    assert df.count() > 0


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        return round(x, 9) if isinstance(x, float) and not math.isnan(x) else x
    return sorted((tuple(repr(v(r[i])) for i in order) for r in rows))


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _norm(got, df.columns) == _norm(res.fetchall(), cols)
