"""Every registered query against its DuckDB oracle on the smallest driver
tables (the driver repeats this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from finlake.queries import ORACLE_SQL, QUERIES
from finlake.plans.driver_tables import TABLES
from tools.check_oracle import key, norm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "fiscal_type" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sdf.columns
    srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = [tuple(norm(v) for v in r) for r in res.fetchall()]
    assert sorted(cols) == sorted(dcols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    dorder = [dcols.index(cols[i]) for i in order]
    s = sorted((tuple(r[i] for i in order) for r in srows), key=key)
    d = sorted((tuple(r[i] for i in dorder) for r in drows), key=key)
    assert len(s) == len(d)
    assert s == d
