import random
import zlib

import numpy as np

from finlake.llm import toxicity as T


def data(spark, n=600, seed=1):
    rng = random.Random(seed)
    bad = ["grumble", "snarkx", "vilepqr", "fouluu"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 7 == 0
        ws = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 120))]
        if toxic:
            for _ in range(4):
                ws.insert(rng.randrange(len(ws)), rng.choice(bad) + rng.choice(["", "a", "bb"]))
        docs.append((i, " ".join(ws), "l", 1))
        if i % 3:
            labels.append((i, int(toxic), 1))
    d = spark.createDataFrame(docs, "doc_id long, text string, score string, predicted int")
    return d, spark.createDataFrame(labels, "doc_id long, toxic int, quality int"), {i: i % 7 == 0 for i in range(n)}


def test_held_out_accuracy_and_folds(spark):
    docs, labels, truth = data(spark)
    model = T.train(docs, labels)
    rows = T.score(docs, model).collect()
    assert len(rows) == 600
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    kept = {r.doc_id for r in T.keep_clean(docs, model).collect()}
    assert kept == {r.doc_id for r in rows if not r.predicted}
    assert T.keep_clean(docs, model).columns == docs.columns


def test_held_out_labels_are_never_used(spark):
    from pyspark.sql import functions as F

    docs, labels, _ = data(spark)
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.train(docs, labels), T.train(docs, flipped)
    assert a.bias == b.bias and (a.features == b.features).all() and (a.weights == b.weights).all()


def test_driver_tables(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = T.score(docs, T.train(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    clean, toxic = ([r for r in rows if r.toxic == mark] for mark in (0, 1))
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.88 * len(toxic)


def test_a_label_is_no_vote():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.15
    # a third of the toxic rows hold each of 12 voters, every third voter is there twice, few clean rows hold one
    x = np.where(truth[:, None], rng.random((4000, 12)) < 0.33, rng.random((4000, 12)) < 0.004)
    x = np.concatenate([x, x[:, ::3]], axis=1)
    marks = truth.copy()
    wrong = np.flatnonzero(truth & (x[:, :12].sum(axis=1) >= 3))[:20]
    marks[wrong] = False
    posterior = T.label_model(T.votes(x, np.zeros((4000, 0), bool), marks), marks)
    assert (posterior[wrong] > 0.5).all()  # the votes say otherwise than the label
    silent = marks & ~x.any(axis=1)
    assert (posterior[silent] < 0.5).all()
    assert np.mean((posterior > 0.5) == truth) > 0.98
    same = np.unique(x, axis=0, return_inverse=True)[1]
    assert all(np.ptp(posterior[same == g]) < 1e-5 for g in np.unique(same))
    assert np.allclose(T.label_model(x[:, :0], marks), marks.mean())


def test_many_weak_voters_do_not_move_the_class():
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.1
    lexicon = np.where(truth[:, None], rng.random((4000, 10)) < 0.4, rng.random((4000, 10)) < 0.001)
    # a language in which toxic rows are more frequent: its 150 words say little each, and much together
    language = rng.random(4000) < np.where(truth, 0.5, 0.3)
    common = np.where(language[:, None], rng.random((4000, 150)) < 0.3, rng.random((4000, 150)) < 0.02)
    x, none = np.concatenate([lexicon, common], axis=1), np.zeros((4000, 0), bool)
    posterior = T.posteriors(x, none, truth)
    assert np.mean(posterior[truth] > 0.5) > 0.95 and np.mean(posterior[~truth] > 0.5) < 0.02
    # voters of one strength alone, and none at all
    weak = T.posteriors(common, none, truth)
    assert len(weak) == 4000 and np.allclose(weak, T.label_model(T.votes(common, none, truth), truth))
    assert np.allclose(T.posteriors(x[:, :0], none, truth), truth.mean())


def test_nulls_and_missing_labels(spark):
    docs, labels, _ = data(spark, 60)
    odd = spark.createDataFrame([(None, "grumble"), (1000, None), (1001, ""), (1001, ""), (1002, "é " * 50000)], "doc_id long, text string")
    model = T.train(docs, labels)
    rows = T.score(odd, model).collect()
    assert len(rows) == 5 and all(r.predicted == 0 for r in rows if r.doc_id in (1000, 1001))
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    none = T.train(docs, labels.limit(0))
    assert all(r.score < 1e-6 for r in T.score(docs, none).collect())
    only = T.train(docs, labels.filter("toxic = 0"))
    assert all(r.score < 1e-6 for r in T.score(docs, only).collect())
    assert T.score(docs.limit(0), model).count() == 0
    assert T.train(docs.limit(0), labels).bias == T.train(docs, labels.limit(0)).bias


def test_repeated_ids_do_not_grow_the_sample(spark):
    docs, labels, _ = data(spark, 60)
    again = docs.unionByName(docs.filter("doc_id < 9")).unionByName(docs.filter("doc_id < 9").selectExpr("doc_id", "text || ' more' text", "score", "predicted"))
    one, many = (T.training_rows(d, labels) for d in (docs, again))
    assert many.count() == one.count()
    assert T.training_rows(again, labels, 10).count() == 10
