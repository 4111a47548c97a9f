"""The SQL of the queries that have one, against Spark on the smallest driver tables."""

import duckdb
import pytest
from finlake.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in res.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == want


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
