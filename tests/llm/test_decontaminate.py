import random

import brute
from finlake.llm import decontaminate as D

FIELDS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def got(df):
    return sorted((tuple(r[c] for c in FIELDS) for r in df.collect()), key=str)


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1, 7) for i, t in docs], "doc_id long, text string, row string, pos int, `len` int")
    return d, spark.createDataFrame(items, "item_id long, text string")


def test_matches_brute_force(spark):
    rng = random.Random(5)
    vocab = ["a", "b", "É", "cat", "12", "Z"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 9, 10, 14, 30])))) for i in range(12)]
    items += [(20, items[3][1]), (21, None), (22, "..."), (None, "a b"), (23, "unique words in a short item")]
    docs = [(i, "-".join(rng.choice(vocab) for _ in range(rng.randrange(80)))) for i in range(40)]
    docs += [(50, None), (51, ""), (52, "x. " + items[5][1].upper() + " y"), (52, "x. " + items[5][1].upper() + " y")]
    docs += [(None, items[5][1]), (60, "some " + "UNIQUE words, in a short item!" * 3)]
    d, i = frames(spark, docs, items)
    assert got(D.contamination(d, i)) == sorted(brute.decontaminate(docs, items), key=str)


def test_shuffle_join_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    rng = random.Random(6)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(12))) for i in range(5)]
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(60)) + " " + items[i % 5][1]) for i in range(20)]
    d, i = frames(spark, docs, items)
    assert got(D.contamination(d, i)) == sorted(brute.decontaminate(docs, items), key=str)


def test_empty_tables(spark):
    d, i = frames(spark, [], [(1, "a b c")])
    assert D.contamination(d, i).count() == 0
    d, i = frames(spark, [(1, "a b c")], [])
    assert got(D.contamination(d, i)) == [(1, 3, 0, 0, brute.sha(""), False)]


def test_items_without_id_and_with_text_ids(spark):
    docs = [(1, "x one two three y"), (2, "four five"), (3, "none of them")]
    d, _ = frames(spark, docs, [])
    items = [(None, "one two three"), ("i-2", "four five"), ("i-10", "four five")]
    found = got(D.contamination(d, spark.createDataFrame(items, "item_id string, text string")))
    assert found == sorted(brute.decontaminate(docs, items), key=str)
    assert [(f[0], f[2], f[3], f[5]) for f in found] == [(1, 3, 0, True), (2, 2, 2, True), (3, 0, 0, False)]
