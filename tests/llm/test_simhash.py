import random

import brute
import numpy as np
from pyspark.sql import functions as F
from finlake.llm import components, simhash
from finlake.llm.components import connected_components


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 5, "k") for i, t in docs], "doc_id long, text string, fp int, root string")


def corpus():
    rng = random.Random(3)
    docs = []
    for i in range(40):
        ws = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 300))]
        docs.append((i * 3, " ".join(ws)))
        for j in range(rng.randrange(4)):
            edit = list(ws)
            edit[rng.randrange(len(ws))] = "E"
            docs.append((1000 - i * 7 - j, rng.choice([" ", "\n"]).join(edit).upper()))
    return docs + [(2000, None), (2001, ""), (2002, "one"), (2003, "ONE"), (2004, "a b"), (None, "one"), (2004, "a b"), (None, "lonely words here")]


def test_matches_brute_force(spark):
    docs = corpus()
    rows = simhash.near_duplicates(frame(spark, docs)).collect()
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows), key=str)
    want = brute.simhash(docs)
    assert got == sorted(want, key=str)
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})  # some links are not copies


def test_links_of_planted_fingerprints(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = set(base)
    for b in base:
        for _ in range(3):
            x = b
            for bit in rng.sample(range(64), rng.randrange(1, 5)):
                x ^= 1 << bit
            prints.add(x)
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    df = spark.createDataFrame(signed, "fp long")
    for bits in (1, 2, 3, 4):
        got = {frozenset((r.x % 2**64, r.y % 2**64)) for r in simhash.links(df, bits).collect()}
        ps = sorted(prints)
        want = {frozenset((a, b)) for i, a in enumerate(ps) for b in ps[i + 1 :] if (a ^ b).bit_count() <= bits}
        assert got == want


def test_keep_one(spark):
    docs = corpus()
    kept = simhash.keep_one(frame(spark, docs))
    assert kept.columns == ["doc_id", "text", "fp", "root"]
    ids = [r.doc_id for r in kept.collect()]
    want = {c for _, _, c in brute.simhash(docs)}
    assert sorted(x for x in ids if x is not None) == sorted(x for x in want if x is not None)
    assert ids.count(None) == 1


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "x long, y long")
    got = {r.node: r.root for r in connected_components(df, "x", "y").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]


def test_links_do_not_broadcast_what_an_explode_makes_larger(spark, tmp):
    # written, so that sizes are known and below the limit of a broadcast, as on the real table
    spark.range(300).select(F.col("id").alias("fp")).write.parquet(f"{tmp}/prints")
    plan = final_plan(simhash.links(spark.read.parquet(f"{tmp}/prints"), 2))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_rounds_broadcast_by_counted_links(spark, tmp, monkeypatch):
    spark.range(1, 50).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b")).write.parquet(f"{tmp}/links")
    links = spark.read.parquet(f"{tmp}/links")
    assert "BroadcastHashJoin" in final_plan(components._round(links, 49))
    monkeypatch.setattr(components, "BROADCAST_LINKS", 48)
    plan = final_plan(components._round(links, 49))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    got = connected_components(links, "a", "b").collect()
    assert sorted((r.node, r.root) for r in got) == [(i, 0) for i in range(50)]
