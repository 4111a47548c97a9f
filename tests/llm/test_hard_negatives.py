import math

import numpy as np
import pytest
from brute import hard_negatives
from finlake.llm import hard_negatives as H


def whole(v):
    return tuple(math.floor(256 * float(np.float32(x))) for x in v)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def clustered():
    """Vectors around a few centres of several labels, so that bounds cut cells off."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 8)) * 2
    return [(i, int(rng.integers(3)), [float(np.float32(x)) for x in centres[i % 12] + 0.05 * rng.standard_normal(8)]) for i in range(900)]


def frame(spark, rows):
    rows = [(*r, 1, "x") for r in rows]
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, cell int, query_id string").repartition(4)


def test_matches_brute_force_in_rounds(spark, clustered, monkeypatch):
    for name, value in {"CELL": 16, "BLOCK": 7, "BUDGET": 40, "PART": 3, "GROWTH": 3, "VISITS": 5, "SAMPLE": 300}.items():
        monkeypatch.setattr(H, name, value)
    out = H.mine(frame(spark, clustered), "vec_id % 50 = 0")
    want = hard_negatives([(i, label, whole(v)) for i, label, v in clustered], range(0, 900, 50))
    assert got(out) == want and want
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_searches_stop_before_all_cells(clustered):
    """The heap gives cells by falling bounds, each once, and every member is below its cell's bound."""
    x = np.array([whole(v) for _, _, v in clustered], np.float64)
    words = [H.fit_codebook(x[:, :4], 10), H.fit_codebook(x[:, 4:], 10)]
    code, away = zip(*(H.nearest_code(p, w) for p, w in zip((x[:, :4], x[:, 4:]), words)))
    cell = code[0] * 10 + code[1]
    radii = [np.array([a[c == i].max(initial=0) for i in range(10)]) for c, a in zip(code, away)]
    sizes = np.bincount(cell, minlength=100)
    index = H.Index(words, radii, sizes, sizes)
    stopped = 0
    for q in x[::100]:
        cells, popped, rest, seen = [], 0, np.inf, []
        best = np.sort(x @ q)[::-1][4]
        while rest > -np.inf:
            more, popped, bound = index.visit(q, popped, 30)
            assert all(sizes[c] for c in more)
            cells += more
            unseen = ~np.isin(cell, cells)
            assert not unseen.any() or (x[unseen] @ q).max() <= bound <= rest + 1
            rest = bound
            seen.append(best > rest)
        assert sorted(cells) == np.flatnonzero(sizes).tolist()
        stopped += seen[0] or seen[len(seen) // 2]
    assert stopped >= 5


def test_odd_rows_ties_and_signs(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.5, 0.5]), (2, 2, [0.5, 0.1]), (3, 2, [0.5, 0.1]), (4, 3, [0.45, -1.0]), (5, 1, [-1.0, 0.0])]
    rows += [(6, 2, [0.0, 0.0]), (7, 1, [0.0, 3.0]), (100, 2, [-1.0, -0.25]), (100, 2, [-1.0, -0.25])]
    odd = [(8, 1, None), (9, 1, [nan, 1.0]), (10, 2, [inf, 0.0]), (11, 2, [None, 1.0]), (12, None, [1.0, 0.0]), (None, 1, [1.0, 0.0]), (13, 2, [1.0])]
    out = got(H.mine(frame(spark, rows + odd + rows[:3]), "vec_id % 100 = 0"))
    assert out == hard_negatives([(i, label, whole(v)) for i, label, v in set((i, label, tuple(v)) for i, label, v in rows)], [0, 100])
    assert (0, 1, 1, 2, 128 * 256, 128 * 256) in out and (0, 1, 2, 3, 128 * 256, 128 * 256) in out  # ties by id
    assert {r[5] for r in out if r[4] == 0} <= {0}
    assert got(H.mine(frame(spark, rows).limit(0), "true")) == [] and got(H.mine(frame(spark, rows), "false")) == []
    with pytest.raises(Exception, match="too large"):
        H.mine(frame(spark, [*rows, (20, 1, [1e30, 0.0])]), "true").collect()


def test_one_vector_in_a_third_of_the_rows(spark, clustered, monkeypatch):
    for name, value in {"CELL": 30, "BLOCK": 20, "BUDGET": 100}.items():
        monkeypatch.setattr(H, name, value)
    rows = clustered[:200] + [(1000 + i, i % 2, clustered[0][2]) for i in range(100)]
    want = hard_negatives([(i, label, whole(v)) for i, label, v in rows], [0, 100, 1000])
    assert got(H.mine(frame(spark, rows), "vec_id in (0, 100, 1000)")) == want
