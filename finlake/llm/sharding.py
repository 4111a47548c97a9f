"""Sharding by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a prime-sized table (offset
and step from a hash of its name). Shards take turns claiming their next free
slot until the table is full, so every shard owns the same number of slots give
or take one, and removing a shard moves few rows other than its own. A row's
slot is a hash of its key modulo the table size; the table, whose size is a
parameter and does not grow with the data, is broadcast.

Defined cases: a null key has the slot of the empty string; equal keys share a
shard; empty input gives an empty result; other columns pass through untouched
by ``shard_rows`` unless they are named slot or shard (then they are replaced).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65537
N_SHARDS = 64


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(name: str, size: int) -> tuple[int, int]:
    """Offset and step of a shard's permutation; any step in 1..size-1 visits all slots of a prime table."""
    h = hashlib.md5(name.encode()).digest()
    return int.from_bytes(h[:8], "big") % size, int.from_bytes(h[8:], "big") % (size - 1) + 1


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> shard number, filled by turns; at most ``size`` entries, built in O(size log size)."""
    if not _is_prime(size):
        raise ValueError(f"table size {size} is not a prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct, at least one and at most the table size")
    owner = [-1] * size
    place = [preference(s, size) for s in shards]
    at = [offset for offset, _ in place]
    filled = 0
    while True:
        for i, (_, step) in enumerate(place):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step) % size
            owner[at[i]] = i
            filled += 1
            if filled == size:
                return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % size).cast("int")


def shard_rows(df: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with its slot and shard name; no shuffle."""
    table = lookup_table(shards, size)
    spark = df.sparkSession
    placed = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(table)], "__slot int, shard string")
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]
    keyed = df.select(*rest, slot_of(F.col(f"`{key}`"), size).alias("slot"))
    return keyed.join(F.broadcast(placed), keyed["slot"] == placed["__slot"]).drop("__slot")


def write_shards(df: DataFrame, key: str, shards: list[str], path: str, size: int = TABLE_SIZE) -> None:
    """One folder per shard, ``shard=<name>``, with files of the advisory partition size.

    Rows are rebalanced by shard, so a file holds one shard and the number of files
    follows the data, not tasks times shards; a large shard is split over several
    tasks. Empty in: no shard folders. A table that is there is replaced."""
    placed = shard_rows(df, key, shards, size)
    placed.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
