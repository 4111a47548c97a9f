"""Best-fit packing of documents into sequences of several permitted lengths.

Documents become pieces of at most the largest permitted length. Pieces are
dealt by a hash of their row number to groups of about ``group_tokens`` tokens
(the number of groups follows the corpus, a group's size does not, and no id,
null or repeated, makes a group larger), and each group is packed on its own by best-fit decreasing over all permitted lengths
together:

* a piece goes to the open bin whose free room fits it most tightly;
* if none fits, a bin is opened with the permitted length that costs least per
  token it can still be filled with (its own piece plus the pieces left that
  are small enough for its remaining room);
* when all pieces are placed, every bin shrinks to the shortest permitted
  length that holds its contents.

Defined cases: an empty or null text has one row with no bin (bin_id null,
capacity null, 0 tokens); a text of any length is cut into pieces, all packed;
ties are broken by document id, then piece; a repeated row is packed as often as
it occurs; null ids are packed like others; other columns are ignored; empty
input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize
from .textops import SPACE_WORDS, slices, utf8, words

CAPACITIES = (256, 512, 1024, 2048)
#: What a sequence costs beside its length, in tokens (per-sequence overhead).
OVERHEAD = 16
GROUP_TOKENS = 2_000_000


def opening_length(size: int, capacities: tuple[int, ...], overhead: int, left_by_size: list[int]) -> int:
    """The permitted length that costs least per token it can hold.

    ``left_by_size[i]`` is the volume still to place in pieces of at most
    ``capacities[i]`` tokens (rounded up to a permitted length).
    """
    best, best_cost = 0, float("inf")
    for c in capacities:
        if c < size:
            continue
        room = c - size
        filler = 0
        for i, limit in enumerate(capacities):
            if limit <= room:
                filler = left_by_size[i]
        if capacities[0] > room:  # only pieces below the smallest length can fit
            filler = min(left_by_size[0], room) // 2
        cost = (c + overhead) / (size + min(room, filler))
        if cost < best_cost - 1e-12:
            best, best_cost = c, cost
    return best


def pack_group(
    sizes: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD
) -> tuple[list[int], list[int], list[int]]:
    """Pack ``sizes`` (descending). Returns each piece's bin and offset, and the final bin lengths."""
    capacities = tuple(sorted(capacities))
    volume = [0] * len(capacities)
    for s in sizes:
        for i, c in enumerate(capacities):
            if s <= c:
                volume[i] += s
    rooms: dict[int, list[int]] = {}
    open_rooms = 0  # bit r is set while some bin has r tokens of room
    filled: list[int] = []
    length: list[int] = []
    bins, offsets = [], []
    for s in sizes:
        for i, c in enumerate(capacities):
            if s <= c:
                volume[i] -= s
        fitting = open_rooms >> s
        if fitting:
            room = s + (fitting & -fitting).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                open_rooms &= ~(1 << room)
        else:
            b = len(filled)
            length.append(opening_length(s, capacities, overhead, volume))
            filled.append(0)
            room = length[b]
        bins.append(b)
        offsets.append(filled[b])
        filled[b] += s
        room -= s
        if room:
            rooms.setdefault(room, []).append(b)
            open_rooms |= 1 << room
    final = [next(c for c in capacities if c >= f) for f in filled]
    return bins, offsets, final


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) with whitespace-separated words as tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = utf8(part.column("text"))
                _, _, first = words(data, offsets, SPACE_WORDS)
                n = pa.array(np.diff(first).astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), n], ["doc_id", "n_tokens"])

    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(count, "doc_id long, n_tokens long")


OUT = "doc_id long, piece int, start long, n_tokens long, bin_id string, capacity int, bin_offset long"


def pack_documents(
    lengths: DataFrame,
    capacities: tuple[int, ...] = CAPACITIES,
    overhead: int = OVERHEAD,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Pack rows of (doc_id, n_tokens); one result row per piece.

    ``start`` is the piece's first token in its document, ``bin_offset`` its
    first token in the bin, ``capacity`` the bin's final permitted length.
    """
    capacities = tuple(sorted(set(capacities)))
    if not capacities or capacities[0] < 1:
        raise ValueError("permitted lengths must be positive")
    top = capacities[-1]
    numbered = lengths.select("doc_id", "n_tokens", F.monotonically_increasing_id().alias("row"))
    lengths = materialize(numbered, "pack-lengths")  # row numbers are settled by being written
    total = lengths.agg(F.sum("n_tokens")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))

    # a document longer than a group is spread: pieces, not documents, are dealt
    pieces = (
        lengths.select(
            "doc_id",
            "row",
            F.col("n_tokens").alias("doc_tokens"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.col("n_tokens") - 1), F.lit(top).cast("long"))).alias("start"),
        )
        .withColumn("n_tokens", F.least(F.lit(top), F.col("doc_tokens") - F.col("start")))
        .withColumn("piece", (F.col("start") / top).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
        .select("part", "doc_id", "piece", "start", "n_tokens")
    )

    def pack(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        # longest first; ties by document id (null last), then piece
        table = table.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        sizes = table.column("n_tokens").to_pylist()
        bins, offsets, final = pack_group([s for s in sizes if s], capacities, overhead)
        empty = len(sizes) - len(bins)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "piece": table.column("piece"),
                "start": table.column("start"),
                "n_tokens": table.column("n_tokens"),
                "bin_id": pa.array([f"{part:x}-{b}" for b in bins] + [None] * empty, pa.string()),
                "capacity": pa.array([final[b] for b in bins] + [None] * empty, pa.int32()),
                "bin_offset": pa.array(offsets + [None] * empty, pa.int64()),
            }
        )

    return pieces.groupBy("part").applyInArrow(pack, OUT)
