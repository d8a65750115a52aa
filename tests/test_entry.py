"""Driver contract: entry() runs; every query matches its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest, rows_of


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "nu_sum_items_price" in df.columns


def test_every_lakehouse_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    # queries without SQL come from the optional subpackage alone and are tested there
    assert set(E.queries()) - set(E._QUERIES) == set(E.llm.QUERIES if E.llm else ())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.sql(E.oracle_sql()[name])
    d = rows_of(res.columns, res.fetchall())
    assert sorted(df.columns) == sorted(res.columns)
    assert digest(s) == digest(d), (list((s - d).items())[:2], list((d - s).items())[:2])
