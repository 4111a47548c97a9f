"""Connected components of a link table by alternating star contraction.

Large-star moves every larger neighbour of a node to the node's smallest
neighbour, small-star does the same for the smaller ones; repeated, each
component becomes a star around its smallest node in O(log^2 n) rounds. All
rounds are joins and map-side-combined minima over the link table; every round
is written to shared storage, nothing is collected but two numbers. One of them
is the number of links: the minima are a broadcast while there are at most
``BROADCAST_LINKS``, and a shuffle join beyond. Spark's own choice would rest on
the size of the written files, and links compress many times over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize

MAX_ROUNDS = 60
#: Links up to which minima (at most two for a link) are broadcast.
BROADCAST_LINKS = 100_000


def _round(links: DataFrame, n: int) -> DataFrame:
    """One large-star and one small-star step on ``n`` links (a > b)."""
    joinable = F.broadcast if n <= BROADCAST_LINKS else lambda df: df.hint("merge")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    large = (
        both.join(joinable(least), both["a"] == least["u"])
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )
    least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    small = large.join(joinable(least), large["a"] == least["u"])
    return (
        small.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): every node that has a link, with the smallest node of its component."""
    pair = links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
    state = materialize(pair.filter("a <> b").distinct(), "components-0")
    seen = None
    for i in range(1, MAX_ROUNDS):
        mark = state.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if mark["n"] == 0 or mark == seen:
            break
        seen = mark
        state = materialize(_round(state, mark["n"]), f"components-{i}")
    else:
        raise RuntimeError("components did not settle")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
