import random

import pytest
from pyspark.sql import functions as F

from finlake.operators.filldown import fill_down, fill_down_exact, with_ordinal, with_row_number
from finlake.operators.hierarchy import hierarchy_paths, widen_levels
from finlake.session import conf_override
from tests.conftest import rows


def _wbs(spark, data):
    return spark.createDataFrame(data, "ord long, code string, name string, level long")


def _values():
    lvl1 = F.col("level") == 1
    return {"parent_code": F.when(lvl1, F.col("code")), "parent_name": F.when(lvl1, F.col("name"))}


def test_filldown_edge_rows(spark):
    df = _wbs(
        spark,
        [
            (1, "A0", "before", 2),  # above the first level-1 row: stays null
            (2, "A1", "one", 1),
            (3, "A2", "x", 2),
            (4, "B1", None, 1),  # level-1 row with a null name inherits the name above
            (5, "B2", "y", 2),
        ],
    )
    out = fill_down(df, "ord", _values())
    assert rows(out, "ord", "parent_code", "parent_name") == [
        (1, None, None),
        (2, "A1", "one"),
        (3, "A1", "one"),
        (4, "B1", "one"),
        (5, "B1", "one"),
    ]


@pytest.mark.parametrize("bucket_rows", [3, 7, 50])
def test_bucketed_filldown_equals_single_window(spark, bucket_rows):
    rnd = random.Random(bucket_rows)
    data = []
    ord_ = 0
    for i in range(400):
        ord_ += rnd.choice([1, 1, 2, 17])  # sparse ordinals
        level = 1 if rnd.random() < 0.05 else 2
        name = None if rnd.random() < 0.2 else f"n{i}"
        data.append((ord_, f"c{i}", name, level))
    df = _wbs(spark, data).repartition(5)  # shuffled input, ordinal kept
    got = fill_down(df, "ord", _values(), bucket_rows=bucket_rows)
    exp = fill_down_exact(df, "ord", _values())
    assert rows(got, "ord", "parent_code", "parent_name") == rows(exp, "ord", "parent_code", "parent_name")


def test_with_ordinal_orders_like_sort(spark):
    df = spark.createDataFrame([(f"f{i % 3}", i) for i in range(30)], "f string, i long").repartition(4)
    o = with_ordinal(df, ["f", "i"])
    got = [(r["f"], r["i"]) for r in o.orderBy("__ord").collect()]
    assert got == sorted(got)


def _nodes(spark, data):
    return spark.createDataFrame(data, "ID long, ID2 long, Text string")


def test_hierarchy_paths_and_levels(spark):
    df = _nodes(
        spark,
        [
            (1, 0, "Root"),  # parent 0 = root
            (2, None, "Other root"),  # null parent = root
            (3, 1, "Child"),
            (4, 3, "a > b"),  # text holding the separator
            (5, 4, "Leaf"),
            (0, None, "zero"),  # ID 0: empty path, level 0
        ],
    )
    h = hierarchy_paths(df)
    assert rows(h, "ID", "Hierarchy", "Level") == [
        (0, "", 0),
        (1, "Root", 0),
        (2, "Other root", 0),
        (3, "Root > Child", 1),
        (4, "Root > Child > a > b", 2),
        (5, "Root > Child > a > b > Leaf", 3),
    ]
    w = widen_levels(h)
    assert [c for c in w.columns if c.startswith("Level ") and c.endswith("Text")] == [
        f"Level {i} Text" for i in range(5)
    ]
    r5 = w.filter("ID = 5").collect()[0]
    assert (r5["Level 0 Text"], r5["Level 2 Text"], r5["Level 4 Text"]) == ("Root", "a", "Leaf")
    r1 = w.filter("ID = 1").collect()[0]
    assert r1["Level 1 Text"] is None


def test_hierarchy_deep_chain(spark):
    n = 300
    df = _nodes(spark, [(i, i - 1 if i > 1 else 0, f"t{i}") for i in range(1, n + 1)])
    h = hierarchy_paths(df)
    last = h.filter(f"ID = {n}").collect()[0]
    assert last["Level"] == n - 1
    assert last["Hierarchy"].split(" > ") == [f"t{i}" for i in range(1, n + 1)]


def test_hierarchy_missing_parent_raises(spark):
    with pytest.raises(KeyError):
        hierarchy_paths(_nodes(spark, [(1, 0, "r"), (2, 9, "orphan")]))


def test_hierarchy_cycle_raises(spark):
    with pytest.raises(ValueError, match="cycle"):
        hierarchy_paths(_nodes(spark, [(1, 0, "r"), (2, 3, "a"), (3, 2, "b")]))


def test_hierarchy_duplicate_ids_raise(spark):
    from finlake.operators.lookup import MergeError

    with pytest.raises(MergeError):
        hierarchy_paths(_nodes(spark, [(1, 0, "r"), (2, 1, "a"), (2, 1, "b")]))


def test_hierarchy_shuffle_path_equals_broadcast_path(spark):
    data = [(i, (i - 1) // 3 if i > 1 else 0, f"t{i}") for i in range(1, 120)]
    expect = rows(hierarchy_paths(_nodes(spark, data)), "ID", "Hierarchy", "Level")
    spark.conf.set("finlake.broadcast.maxBytes", "0")
    try:
        got = hierarchy_paths(_nodes(spark, data))
        assert rows(got, "ID", "Hierarchy", "Level") == expect
    finally:
        spark.conf.unset("finlake.broadcast.maxBytes")


def test_row_numbers_follow_the_order(spark):
    rng = random.Random(4)
    ids = list(range(5000))
    rng.shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "ID long").repartition(7)
    # small partitions stay apart, so that the counts of several partitions are added
    with conf_override(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        got = rows(with_row_number(df, ["ID"], "n"), "n", "ID")
    assert sorted(got) == [(i + 1, i) for i in range(5000)]


def test_row_numbers_of_ties_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, 9), (2, 9), (2, 9), (1, 9)], "ID long, n int")
    out = with_row_number(df, ["ID"], "n")
    assert out.columns == ["ID", "n"]
    assert rows(out, "n", "ID") == [(1, None), (2, 1), (3, 2), (4, 2)]
    assert with_row_number(df.limit(0), ["ID"], "n").count() == 0
