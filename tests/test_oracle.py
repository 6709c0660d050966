"""Every registered query against its DuckDB SQL (the driver's check), at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from reelhouse.plans.registry import registered
from tools.oracle_check import TABLES, digest, plan_problems


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(registered()) <= set(E.oracle_sql())


def assert_scalable_plan(df):
    """No banned node (products, Python evaluation), and every exchange into
    one partition carries only partial aggregates, never the rows themselves."""
    assert plan_problems(df) == []


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    assert_scalable_plan(df)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(list(df.columns), srows) == digest(dcols, drows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["genre_name", "avg_rating"] and df.count() > 0
