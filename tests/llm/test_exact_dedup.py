import random

import pytest
from brute import exact_copies
from finlake.llm import exact_dedup as X

FIELDS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def got(df):
    return sorted((tuple(r[c] for c in FIELDS) for r in df.collect()), key=str)


def corpus():
    rng = random.Random(5)
    docs = [(i, f"Text {rng.randrange(60)} " + "é" * rng.randrange(3)) for i in range(300)]
    docs += [(1000 + i, "The Same Text" if i % 2 else "the same text") for i in range(200)]
    docs += [(2000 + i, "a prefix that many texts begin with, " + str(i % 7)) for i in range(100)]
    return docs


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_matches_brute_force(spark, keep):
    docs = corpus() + [(3000, None), (3001, ""), (3002, "x" * 300_000), (3003, "X" * 300_000), (3004, "x" * 300_001)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got(X.copies(df, keep=keep)) == sorted(exact_copies(docs, keep), key=str)


def test_group_over_many_partitions(spark, monkeypatch):
    """One text in most rows: the sort cuts it, the sizes and the kept row are still one group's."""
    monkeypatch.setattr(X, "PART_BYTES", 400)
    docs = [(i, "SAME") for i in range(3000)] + [(5000 + i, f"other {i}") for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    written, real = [], X.materialize
    monkeypatch.setattr(X, "materialize", lambda *a: written.append(real(*a)) or written[-1])
    assert got(X.copies(df, keep="largest")) == sorted(exact_copies(docs, "largest"), key=str)
    # no partition holds the whole group
    assert written[0].filter("n > 1").groupBy("part").count().count() > 4


def test_null_ids_repeated_rows_and_empty(spark):
    docs = [(None, "a"), (7, "A"), (7, "a"), (None, "b"), (None, "b"), (3, None), (2, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    rows = {(r.doc_id, r.keep_id, r.group_size) for r in X.copies(df).collect()}
    assert rows == {(None, 7, 3), (7, 7, 3), (None, None, 2), (3, 2, 2), (2, 2, 2)}
    assert X.copies(df).filter("kept").count() == 3
    assert X.copies(df.limit(0)).count() == 0


def test_other_columns_are_untouched(spark):
    names = ["doc_id", "text", "row", "norm", "a.b", "rest", "edge", "part"]
    rows = [(1, "x", 9, "n", 0.5, [1], "e", 3), (2, "X", 8, "m", 1.5, [2], "f", 4), (3, "y", 7, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `row` int, norm string, `a.b` double, rest array<int>, edge string, part int")
    out = X.drop_copies(df)
    assert out.columns == names and out.dtypes == df.dtypes
    assert sorted(map(tuple, out.collect())) == [rows[0], rows[2]]
    assert [r.doc_id for r in X.drop_copies(df, keep="largest").filter("text = 'X'").collect()] == [2]
