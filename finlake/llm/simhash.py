"""SimHash near-duplicates by multi-index hashing.

Fingerprint: 64 bits, bit i is 1 if set in over half the XXH64 hashes (seed 42)
of the document's word shingles (repeats included, A-Z lower-cased). Two
fingerprints link when they differ in at most ``max_bits`` bits.

Search: only distinct fingerprints take part (copies of one text share one).
The fingerprint is cut into segments; if two fingerprints are close, some
segment differs in at most ``max_bits // segments`` bits. Every fingerprint is
stored under each of its segments, and looks up each member of the small Hamming
ball around each of its segments; what it fetches is verified on all 64 bits. A
flip is only enumerated from 0 to 1, so a pair meets from one side. Links are
at most the members of a 64-bit ball per fingerprint, not pairs of documents.

Defined cases: a null or empty text has no words and fingerprint zero, linked
like any other; a text shorter than a shingle is one shingle; repeated rows each
get a result row; a row with a null id never names a component (the component is
null if no member has an id); other columns are ignored; empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import materialize
from .textops import slices

BITS = 64
#: Hashes turned into bit counts at a time (64 bytes each).
BLOCK = 1 << 18


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 (seed 42) of every shingle of ``size`` words joined by one space."""
    from xxhash import xxh64_intdigest

    ws = text.lower().split()  # bytes: A-Z and ASCII white space only
    if len(ws) <= size:
        return [xxh64_intdigest(b" ".join(ws), 42)] if ws else []
    line = b" ".join(ws)
    ends = list(accumulate([len(w) + 1 for w in ws]))
    return [xxh64_intdigest(line[s : e - 1], 42) for s, e in zip([0, *ends], ends[size - 1 :])]


def majority(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits set in over half of each document's hashes, as uint64."""
    n = np.diff(offsets)
    counts = np.zeros((len(n), BITS), np.int64)
    for low in range(0, len(hashes), BLOCK):
        high = min(low + BLOCK, len(hashes))
        bits = np.unpackbits(hashes[low:high].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        docs = np.searchsorted(offsets, np.arange(low, high), side="right") - 1
        first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
        counts[docs[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    return np.packbits(2 * counts > n[:, None], axis=1, bitorder="little").reshape(-1, 8).copy().view("<u8").ravel()


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): one row per input row."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = pc.fill_null(part.column("text").cast(pa.large_binary()), b"")
                lists = [shingle_hashes(t.as_py(), shingle) for t in texts]
                offsets = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)
                hashes = np.fromiter((h for x in lists for h in x), np.uint64, int(offsets[-1]))
                fps = majority(hashes, offsets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(fps)], ["doc_id", "text_hash", "fp"]
                )

    text = F.col(text_col).cast("string")
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return two.mapInArrow(emit, "doc_id long, text_hash long, fp long")


def ball(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``width`` bits."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _segments(max_bits: int) -> tuple[int, int, int]:
    """(segments, width, radius): two segments of 32 bits up to 3 bits, then more of fewer bits."""
    n = 2 if max_bits <= 3 else 4
    return n, BITS // n, max_bits // n


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """(x, y): pairs of distinct fingerprints (column fp) that differ in 1 to ``max_bits`` bits."""
    n, width, radius = _segments(max_bits)

    def keyed(i: int, segment: Column) -> Column:
        # the segment's number and its bits in one value
        return F.xxhash64(F.lit(i), segment)

    def segment(i: int) -> Column:
        return F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1))

    table = prints.select(F.col("fp").alias("y"), F.explode(F.array(*[keyed(i, segment(i)) for i in range(n)])).alias("key"))
    masks = F.array(*[F.lit(m).cast("long") for m in ball(width, radius)])
    probes = (
        prints.select("fp", F.posexplode(F.array(*[segment(i) for i in range(n)])).alias("i", "part"))
        .select("fp", "i", "part", F.explode(masks).alias("mask"))
        .filter(F.col("part").bitwiseAND(F.col("mask")) == 0 if radius == 1 else F.lit(True))
        .select(F.col("fp").alias("x"), F.xxhash64("i", F.col("part").bitwiseXOR(F.col("mask"))).alias("key"))
    )
    close = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))).between(1, max_bits)
    # Spark sizes a table after an explode like the one before it, so it would broadcast the probes, dozens for each
    # fingerprint: a sort-merge join, whatever the sizes look like
    return probes.hint("merge").join(table, (probes["key"] == table["key"]) & close).select("x", "y").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: doc_id, text_hash, fp, root (a fingerprint that names the group), fingerprint (16 hex digits), component_id."""
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    members = connected_components(links(prints.select("fp"), max_bits), "x", "y")
    grouped = (
        prints.join(members, prints["fp"] == members["node"], "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    )
    of_root = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(
        grouped.join(of_root, "root").select(F.col("fp").alias("print"), "root", "component_id"), "simhash-groups"
    )
    return rows.join(named, rows["fp"] == named["print"], "left").select(
        "doc_id", "text_hash", "fp", "root", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One document of each group: the one with the smallest doc_id (an input row
    without id only if the whole group has none; then the smallest text hash), all
    columns as they were, whatever their names; of rows that share id and text, one."""
    found = near_duplicates(docs, shingle, max_bits)
    # ids and hashes without nulls, so that grouping and join need one shuffle of the rows
    number, no_id = F.coalesce("doc_id", F.lit(0)).alias("number"), F.col("doc_id").isNull().alias("no_id")
    keepers = (
        found.groupBy("root")
        .agg(F.min(F.struct(no_id, number, "text_hash")).alias("k"))
        .select("k.no_id", "k.number", F.col("k.text_hash").alias("text_hash"))
        .distinct()
    )
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    doc_id = F.col("doc_id").cast("long")
    keyed = docs.select(
        doc_id.isNull().alias("no_id"),
        F.coalesce(doc_id, F.lit(0)).alias("number"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        whole,
    )
    key = ["no_id", "number", "text_hash"]
    # equal rows meet as one per task
    one = keyed.groupBy(*key).agg(F.first("row").alias("row"))
    return one.join(keepers, key, "left_semi").select("row.*")
