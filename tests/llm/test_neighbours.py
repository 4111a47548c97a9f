import math

import numpy as np
from finlake.llm import neighbours as N


def brute(rows, queries, k=10):
    """rows: {(id, vector)}, queries: {id: vector} -> {query: [(score, id)]} by plain comparison."""
    out = {}
    for q, v in queries.items():
        near = sorted((math.dist(v, w), i) for i, w in rows if i != q)
        out[q] = near[:k]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 3, 0.5) for i, v in rows], "vec_id long, embedding array<double>, block int, score double")


def test_recall_on_driver_tables(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {(r.vec_id, tuple(float(x) for x in r.embedding)) for r in vectors.collect()}
    queries = {i: v for i, v in rows if i % 100 == 0}
    want = brute(rows, queries)
    got = {}
    for r in N.nearest(vectors, vectors.filter("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert set(got) == set(queries)
    hits = 0
    exact = dict(rows)
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, 11))
        assert found == sorted(found, key=lambda x: (x[1], x[2]))
        assert all(math.isclose(s, math.dist(exact[q], exact[i]), rel_tol=1e-12) for _, s, i in found)
        hits += len({i for _, _, i in found} & {i for _, i in want[q]})
    assert hits >= 0.9 * 10 * len(queries)


def test_odd_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (0, [1.0, 0.0])]
    odd = [(4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 1.0, 1.0]), (None, [1.0, 0.0])]
    vectors = frame(spark, rows + odd + [(2, [0.0, 1.0])])
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in N.nearest(vectors, vectors.filter("vec_id in (0, 6, 7)")).collect()]
    assert sorted(got) == [(0, 1, 3, 0.0), (0, 2, 1, round(2**0.5, 9)), (0, 3, 2, round(2**0.5, 9))]
    assert N.nearest(vectors.limit(0), vectors).count() == 0
    assert N.nearest(vectors, vectors.limit(0)).count() == 0


def test_many_blocks_and_copies(spark, monkeypatch):
    monkeypatch.setattr(N, "VECTOR_BLOCK", 50)
    monkeypatch.setattr(N, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(200)]
    rows += [(1000 + i, rows[7][1]) for i in range(100)]
    vectors = frame(spark, rows)
    queries = {i: tuple(v) for i, v in rows if i % 20 == 0 or i == 7}
    want = brute({(i, tuple(v)) for i, v in rows}, queries)
    got = {}
    for r in N.nearest(vectors, vectors.filter("vec_id % 20 = 0 or vec_id = 7")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert [i for _, i in sorted(got[7])] == list(range(1000, 1010))
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in queries)
    assert hits >= 0.9 * 10 * len(queries)
