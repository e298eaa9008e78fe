"""Registered queries vs their DuckDB SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tillstream.sources.tables import TABLES

from support import SF001

sys_tools = __import__("tools.check_oracle", fromlist=["digest"])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert sys_tools.digest(df.columns, rows)[0] == sys_tools.digest(rel.columns, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "storeID", "totalSale"]


def test_every_query_has_an_oracle():
    own = {**E.BATCH_QUERIES, **E.STREAM_QUERIES}
    assert set(own) <= set(E.oracle_sql())
