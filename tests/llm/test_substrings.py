import random

import brute
from pyspark.sql import functions as F

from finlake.llm import chunks, substrings


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 5, "c") for i, t in docs], "doc_id long, text string, chunk int, places string")


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "Éa", "x.", "dog"])
    passage = [word() for _ in range(70)]
    docs = []
    for i in range(n):
        ws = [word() + str(rng.randrange(40)) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            a, b = sorted(rng.randrange(71) for _ in range(2))
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = passage[a:b]
        docs.append((rng.randrange(10_000), rng.choice([" ", "\n", "\t "]).join(ws)))
    docs += [(20_000 + i, docs[0][1]) for i in range(20)]  # a group of copies
    docs += [(30_000, "z " * 400), (30_001, "z " * 19), (30_002, None), (30_003, ""), (30_004, " \n ")]
    docs += [docs[3], docs[3], (None, docs[5][1]), (None, "u v w " * 20)]
    return docs


def check(spark, docs):
    rows = substrings.dedup_digest(frame(spark, docs)).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)
    assert got == sorted(brute.substring_words(docs), key=str)


def test_matches_brute_force(spark):
    check(spark, corpus(1))


def test_matches_brute_force_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(chunks, "BUCKET_BYTES", 5000)
    check(spark, corpus(2))
    check(spark, corpus(3, 20))


def test_texts_keep_everything_else(spark):
    line = " ".join(f"w{i}" for i in range(30))
    docs = [(1, "start  here\n" + line + "\nend of  it"), (2, "other\t" + line + " tail"), (3, "clean  text\n"), (4, None)]
    out = substrings.dedup_texts(frame(spark, docs))
    assert out.columns == ["doc_id", "text", "chunk", "places"]
    texts = {r.doc_id: (r.text, r.chunk, r.places) for r in out.collect()}
    assert texts[1][0] == docs[0][1] and texts[2][0] == "other\ttail" and texts[3][0] == docs[2][1] and texts[4][0] is None
    assert all(v[1:] == (5, "c") for v in texts.values())


def test_no_repeated_rows(spark):
    check(spark, list({d: None for d in corpus(4)}))


def hot_corpus():
    hot = (None, "start " + " ".join(f"h{i}" for i in range(45)) + " end")
    cut = (7, " ".join(f"h{i}" for i in range(5, 40)) + " tail")
    return corpus(5, 20) + [hot] * 60 + [cut] * 30 + [(8, cut[1])] * 9


def test_rows_that_share_id_and_text_are_one(spark, monkeypatch):
    docs = hot_corpus()
    monkeypatch.setattr(chunks, "SPLIT_ROWS", 4)
    monkeypatch.setattr(chunks, "MAX_SPLIT", 30)
    df = frame(spark, docs)
    found = chunks.plan(df)
    assert found.repeats and found.rows == len(docs)
    one = {(r.doc_id, r.text): r.copies for r in chunks.distinct_rows(df, found).collect()}
    assert one == {d: docs.count(d) for d in docs}
    check(spark, docs)


def test_repeated_rows_are_cut_alike(spark, monkeypatch):
    docs = hot_corpus()
    single = list({d: None for d in docs})
    cut = substrings.dedup_texts(frame(spark, single).withColumn("whole", F.col("text"))).collect()
    expect = {(r.doc_id, r.whole): r.text for r in cut}
    assert any(k[1] != v for k, v in expect.items())
    for split in (4, 100_000):
        monkeypatch.setattr(chunks, "SPLIT_ROWS", split)
        rows = [(i, t, n, f"v{n}", n, "p") for n, (i, t) in enumerate(docs)]
        df = spark.createDataFrame(rows, "doc_id long, text string, id int, `a.b` string, copies int, piece string")
        out = substrings.dedup_texts(df)
        assert out.columns == df.columns
        got = sorted(tuple(r) for r in out.select("id", "doc_id", "text", "`a.b`", "copies", "piece").collect())
        assert got == [(n, i, expect[i, t], f"v{n}", n, "p") for n, (i, t) in enumerate(docs)]


def test_tasks_follow_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 300)
    monkeypatch.setattr(chunks, "BUCKET_BYTES", 400)
    monkeypatch.setattr(chunks, "PER_TASK", 1)
    df = frame(spark, list({d: None for d in corpus(6)}))
    found = chunks.plan(df)
    assert found.chunks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert chunks.spread(chunks.chunked(df, found.chunks), "chunk", found.chunks).rdd.getNumPartitions() == found.chunks
    check(spark, list({d: None for d in corpus(6)}))


def test_empty(spark):
    assert substrings.dedup_digest(frame(spark, [])).count() == 0
    assert substrings.dedup_texts(frame(spark, [])).count() == 0


def test_packing_round_trip():
    import numpy as np

    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.int64).astype(np.uint64) * np.uint64(2))
    assert (chunks.unpack64(chunks.pack64(values)) == values).all()
    assert len(chunks.unpack64(chunks.pack64(values[:0]))) == 0


def test_cut_texts_are_not_broadcast(spark, tmp):
    spark.range(50).selectExpr("id doc_id", "repeat('a b ', 100) text", "2L copies", "'a' new_text").write.parquet(f"{tmp}/changed")
    docs = spark.range(50).selectExpr("id doc_id", "repeat('a b ', 100) text", "'x' lang")
    changed = spark.read.parquet(f"{tmp}/changed")
    df = chunks.to_all_rows(docs.union(docs), changed, chunks.Plan(1, 1, 100, True), "doc_id", "text")
    assert [(r.text, r.lang) for r in df.collect()] == [("a", "x")] * 100
    plan = df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert "SortMergeJoin" in plan  # what is broadcast is the few pairs to be split
