"""The driver contract: entry, queries and oracle agree at sf0.001."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans.bindings import TABLES
from tests.conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["movie_id", "title", "avg_rating", "n_ratings"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 46


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _bag(cols, rows_):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows_)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(dcols, cur.fetchall())
