import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from finlake.operators.lookup import MergeError, lookup_join, prefetch_key_stats
from tests.conftest import rows

SCHEMA_L = "k string, a long, shared string"
SCHEMA_R = "k string, b long, shared string"


def test_null_keys_match_null_keys(spark):
    left = spark.createDataFrame([("x", 1, "l1"), (None, 2, "l2"), ("y", 3, "l3")], SCHEMA_L)
    right = spark.createDataFrame([("x", 10, "r1"), (None, 20, "r2")], SCHEMA_R)
    out = lookup_join(left, right, "k", how="left")
    assert out.columns == ["k", "a", "shared_x", "b", "shared_y"]
    assert rows(out) == [("x", 1, "l1", 10, "r1"), ("y", 3, "l3", None, None), (None, 2, "l2", 20, "r2")]


def test_null_key_left_only_stays_unmatched(spark):
    left = spark.createDataFrame([(None, 2, "l2")], SCHEMA_L)
    right = spark.createDataFrame([("x", 10, "r1")], SCHEMA_R)
    assert rows(lookup_join(left, right, "k"), "b") == [(None,)]


def test_duplicate_right_key_raises(spark):
    left = spark.createDataFrame([("x", 1, "l")], SCHEMA_L)
    right = spark.createDataFrame([("x", 10, "a"), ("x", 11, "b")], SCHEMA_R)
    with pytest.raises(MergeError, match="not unique"):
        lookup_join(left, right, "k", validate="many_to_one")


def test_duplicate_null_right_key_raises(spark):
    left = spark.createDataFrame([("x", 1, "l")], SCHEMA_L)
    right = spark.createDataFrame([(None, 10, "a"), (None, 11, "b")], SCHEMA_R)
    with pytest.raises(MergeError):
        lookup_join(left, right, "k", validate="many_to_one")


def test_one_to_one_checks_left(spark):
    left = spark.createDataFrame([("x", 1, "l"), ("x", 2, "m")], SCHEMA_L)
    right = spark.createDataFrame([("x", 10, "a")], SCHEMA_R)
    with pytest.raises(MergeError, match="left"):
        lookup_join(left, right, "k", validate="one_to_one")


def test_left_on_right_on_keeps_both_keys_and_custom_suffixes(spark):
    left = spark.createDataFrame([("c1", "n1"), ("c2", "n2")], "code string, shared string")
    right = spark.createDataFrame([("c1", "r1")], "cc string, shared string")
    out = lookup_join(left, right, left_on="code", right_on="cc", suffixes=("_native", "_cc"))
    assert out.columns == ["code", "shared_native", "cc", "shared_cc"]
    assert rows(out) == [("c1", "n1", "c1", "r1"), ("c2", "n2", None, None)]


def test_inner_drops_unmatched(spark):
    left = spark.createDataFrame([("x", 1, "l"), ("z", 2, "m")], SCHEMA_L)
    right = spark.createDataFrame([("x", 10, "a")], SCHEMA_R)
    assert rows(lookup_join(left, right, "k", how="inner"), "k") == [("x",)]


def test_broadcast_only_when_measured_small(spark):
    left = spark.range(100).select(F.col("id").alias("k"))
    right = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plan = lookup_join(left, right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    spark.conf.set("finlake.broadcast.maxBytes", "1")
    try:
        right2 = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
        plan = lookup_join(left, right2, "k")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    finally:
        spark.conf.unset("finlake.broadcast.maxBytes")


def test_hot_key_split_keeps_every_row(spark):
    """One key (and the null key) hold most rows; with a tiny hot-key
    threshold they go through the broadcast branch, the rest shuffle."""
    spark.conf.set("finlake.broadcast.maxBytes", "1")
    spark.conf.set("finlake.skew.hotKeyRows", "50")
    spark.conf.set("finlake.skew.mode", "split")
    try:
        left = spark.range(1000).select(
            F.when(F.col("id") % 3 == 0, F.lit(None))
            .when(F.col("id") % 3 == 1, F.lit(7))
            .otherwise(F.col("id") % 40)
            .cast("long")
            .alias("k"),
            F.col("id"),
        )
        right = spark.createDataFrame(
            [(None, "null")] + [(i, f"v{i}") for i in range(40)], "k long, v string"
        )
        out = lookup_join(left, right, "k")
        assert out.count() == 1000
        got = dict((r["id"], r["v"]) for r in out.collect())
        for i in (0, 1, 2, 5, 998):
            k = None if i % 3 == 0 else (7 if i % 3 == 1 else i % 40)
            assert got[i] == ("null" if k is None else f"v{k}")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan
    finally:
        spark.conf.unset("finlake.broadcast.maxBytes")
        spark.conf.unset("finlake.skew.hotKeyRows")
        spark.conf.unset("finlake.skew.mode")


def test_matches_pandas_merge_on_random_frames(spark):
    rnd = random.Random(7)
    keys = [None, "a", "b", "c", "d"]
    lp = pd.DataFrame({"k": [rnd.choice(keys) for _ in range(200)], "x": range(200)})
    rp = pd.DataFrame({"k": keys[:4], "y": [10, 11, 12, 13]})
    expect = lp.merge(rp, on="k", how="left", validate="many_to_one")
    left = spark.createDataFrame(lp.astype(object).where(lp.notna(), None), "k string, x long")
    right = spark.createDataFrame(rp.astype(object).where(rp.notna(), None), "k string, y long")
    got = lookup_join(left, right, "k").toPandas().sort_values("x").reset_index(drop=True)
    exp = expect.sort_values("x").reset_index(drop=True)
    assert list(got["y"].astype("float")) == list(exp["y"].astype("float").fillna(float("nan"))) or all(
        (a == b) or (pd.isna(a) and pd.isna(b)) for a, b in zip(got["y"], exp["y"])
    )


def test_prefetch_measures_once(spark):
    a = spark.range(5).withColumnRenamed("id", "k")
    b = spark.range(3).withColumnRenamed("id", "k")
    prefetch_key_stats([(a, ["k"]), (b, ["k"])])
    assert a.__dict__["_finlake_key_stats"][("k",)].rows == 5
    assert b.__dict__["_finlake_key_stats"][("k",)].rows == 3


def test_large_side_is_cut_to_the_keys_in_use(spark):
    """The dimension is over the limit, its rows that the facts use are not: same rows, no fact shuffle."""
    facts = spark.createDataFrame([(f"k{i % 5}" if i % 7 else None, i, "f") for i in range(300)], SCHEMA_L)
    dim = spark.createDataFrame([(f"k{i}" if i else None, i, "d" * 50) for i in range(2000)], SCHEMA_R)
    want = {how: rows(lookup_join(facts, dim, "k", how=how)) for how in ("left", "inner")}
    before = {k: spark.conf.get(k, None) for k in ("finlake.broadcast.maxBytes", "finlake.lookup.reduce")}

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    try:
        spark.conf.set("finlake.broadcast.maxBytes", "4000")
        for how in want:
            out = lookup_join(facts, dim, "k", how=how)
            assert rows(out) == want[how]
            assert "BroadcastHashJoin" in plan(out) and "SortMergeJoin" not in plan(out)
        # switched off, or with more keys in use than fit: a sort-merge join
        spark.conf.set("finlake.lookup.reduce", "false")
        assert "SortMergeJoin" in plan(lookup_join(facts, dim, "k"))
        spark.conf.set("finlake.lookup.reduce", "true")
        many = facts.withColumn("k", F.concat(F.lit("k"), F.col("a").cast("string")))
        out = lookup_join(many, dim, "k")
        assert "SortMergeJoin" in plan(out) and out.count() == 300
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_reduced_gold_plan_shuffles_no_facts(spark):
    from finlake.queries import QUERIES

    out = QUERIES["gold_actuals_reduced"](spark, "/root/testdata/sf0.01")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
