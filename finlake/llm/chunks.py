"""Documents in chunks that can be rebuilt exactly, for operators that need several passes.

A chunk is the set of documents whose (id, text) hash to it, sorted by id (null
last) and text, so every pass, also one repeated after a lost executor, sees
the same documents in the same order and may refer to a place in a chunk by its
number. The number of chunks follows the size of the corpus; a chunk holds about
``CHUNK_BYTES`` of text, or one document if that is longer, and is worked on a few
MB at a time. Rows that share id and text would all hash to one chunk; they are
counted first and go as one row, whose result all of them get (``distinct_rows``).

What a chunk sends to other chunks goes by hash range ("bucket") as packed
arrays, one row per chunk and bucket, after being made unique within the chunk;
so a string that a third of all documents share reaches its bucket once per
chunk, not once per document.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize

CHUNK_BYTES = 4 << 20
#: Text bytes whose hashes meet in one bucket.
BUCKET_BYTES = 8 << 20
#: Beyond these counts chunks and buckets grow instead, up to 16 times their
#: size, so that what a chunk sends to a bucket does not become a single hash.
MANY_CHUNKS, MANY_BUCKETS, GROWTH = 1_000_000, 500_000, 16
#: Most chunks or buckets that one task works on, one after the other.
PER_TASK = 16
#: Repeated rows: rows of one (id, text) that one task writes at a time, and the
#: most pairs with so many rows that they are broadcast to be split.
SPLIT_ROWS, MAX_SPLIT = 100_000, 10_000
LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Plan:
    """Chunks and buckets of a corpus, its rows, and whether some share id and text."""

    chunks: int
    buckets: int
    rows: int
    repeats: bool


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int | None = None) -> Plan:
    """The plan of a corpus, from one pass over its ids, text sizes and text hashes.

    Two texts with one hash only make ``repeats`` true without need."""
    doc_id, text = _id_and_text(id_col, text_col)
    keyed = docs.select(doc_id.alias("doc_id"), F.xxhash64(text).alias("h"), F.octet_length(text).alias("size"))
    pairs = keyed.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    found = pairs.agg(F.sum("size").alias("total"), F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    total = found["total"] or 0

    def parts(size: int, many: int) -> int:
        size = max(size, min(GROWTH * size, total // many))
        return max(1, -(-total // size))

    chunks, buckets = parts(chunk_bytes or CHUNK_BYTES, MANY_CHUNKS), parts(BUCKET_BYTES, MANY_BUCKETS)
    return Plan(chunks, buckets, found["rows"] or 0, (found["most"] or 0) > 1)


def _id_and_text(id_col: str, text_col: str) -> tuple[Column, Column]:
    return F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")


def distinct_rows(docs: DataFrame, corpus: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, copies): rows that share id and text as one, counted before they are shuffled.

    They are the same places, so one of them decides for all. Where no rows are
    repeated, nothing is grouped or written."""
    doc_id, text = _id_and_text(id_col, text_col)
    slim = docs.select(doc_id.alias("doc_id"), text.alias("text"))
    if not corpus.repeats:
        return slim.withColumn("copies", F.lit(1).cast("long"))
    return materialize(slim.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies")), "distinct-rows")


def all_copies(found: DataFrame, corpus: Plan) -> DataFrame:
    """Every row as often as its ``copies`` say (column dropped); many copies come from many tasks."""
    rest = [c for c in found.columns if c != "copies"]
    if not corpus.repeats:
        return found.select(*rest)
    copies, piece = F.col("copies"), F.col("piece")
    last = F.floor((copies - 1) / SPLIT_ROWS).cast("long")
    pieces = found.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    # a number of partitions is given, so that small pieces are not put together again
    tasks = max(_default_tasks(found), -(-corpus.rows // (PER_TASK * SPLIT_ROWS)))
    pieces = pieces.repartition(tasks, *rest, "piece")
    size = F.least(F.lit(SPLIT_ROWS).cast("long"), copies - piece * SPLIT_ROWS)
    return pieces.select(*rest, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("copy")).drop("copy")


def to_all_rows(docs: DataFrame, changed: DataFrame, corpus: Plan, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the texts of ``changed`` (doc_id, text, copies, new_text) in place of their own.

    Pairs with more than ``SPLIT_ROWS`` rows, ``MAX_SPLIT`` of them at most, are
    split by the partition a row is read from, which is the same in a repeated task."""
    limit = max(SPLIT_ROWS, -(-corpus.rows // MAX_SPLIT))
    changed = changed.select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.col("text").alias("whole"), "copies", "new_text"
    )
    wide = changed.filter(F.col("copies") > limit).groupBy(F.col("id").alias("wide_id"), F.col("h").alias("wide_h"))
    wide = F.broadcast(wide.agg(F.ceil(F.max("copies") / limit).cast("int").alias("split")))
    is_wide = lambda df: df["id"].eqNullSafe(wide["wide_id"]) & (df["h"] == wide["wide_h"])
    split = F.coalesce(wide["split"], F.lit(1))

    doc_id, text = _id_and_text(id_col, text_col)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest")
    rows = docs.select(doc_id.alias("id"), F.xxhash64(text).alias("h"), text.alias("text"), rest, F.spark_partition_id().alias("read"))
    rows = rows.join(wide, is_wide(rows), "left").select(
        rows["id"], rows["h"], "text", "rest", F.pmod(F.col("read"), split).alias("piece")
    )
    news = changed.join(wide, is_wide(changed), "left").select(
        changed["id"], changed["h"], "whole", "new_text", F.explode(F.sequence(F.lit(0), split - 1)).alias("piece")
    )
    same_pair = rows["id"].eqNullSafe(news["id"]) & (rows["h"] == news["h"]) & (rows["text"] == news["whole"])
    found = same_pair & (rows["piece"] == news["piece"])
    # texts written compressed, then exploded: Spark would size them far too low for a broadcast
    joined = rows.join(news.hint("merge"), found, "left").select(F.coalesce("new_text", "text").alias("text"), "rest")
    return joined.select(*[F.col("text").alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns])


def chunked(docs: DataFrame, chunks: int, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] | bool = False) -> DataFrame:
    """(chunk, doc_id, text[, ...]): ``carry`` names columns that go along; True: all but the text, as one struct ``rest``."""
    doc_id, text = _id_and_text(id_col, text_col)
    key = F.pmod(F.xxhash64(doc_id, text), F.lit(chunks))
    if carry is True:
        more = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest")]
    else:
        more = [F.col(c) for c in carry or ()]
    return docs.select(key.cast("int").alias("chunk"), doc_id.alias("doc_id"), text.alias("text"), *more)


class Chunk:
    """The documents of a chunk in their fixed order."""

    def __init__(self, table: pa.Table):
        keyed = table.append_column("h", pc.fill_null(table.column("text"), ""))
        order = pc.sort_indices(keyed, sort_keys=[("doc_id", "ascending"), ("h", "ascending")], null_placement="at_end")
        self.table = table.take(order).combine_chunks()
        self.number = self.table.column("chunk")[0].as_py() if len(table) else None
        self.ids = self.table.column("doc_id")
        #: Rank of a document among all: its id, null last.
        self.rank = np.asarray(pc.fill_null(self.ids, LAST), dtype=np.int64)

    @property
    def texts(self) -> pa.Array:
        column = self.table.column("text")
        return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the upper 32 bits: sorted hashes give sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def by_bucket(sorted_hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket numbers, slice bounds) of an ascending array of hashes."""
    owner = bucket_of(sorted_hashes, buckets).astype(np.int64)
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    return owner[cuts], np.r_[cuts, len(owner)]


def pack48(values: np.ndarray) -> bytes:
    """Lower 48 bits of each value as six byte planes, highest first (sorted values then compress well)."""
    planes = values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return planes.T.tobytes()


def unpack48(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 2:] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)


def _default_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, key: str, groups: int) -> DataFrame:
    """``df`` by ``key``, in more tasks than the session's default where a task would get more than ``PER_TASK`` groups."""
    tasks = -(-groups // PER_TASK)
    return df.repartition(tasks, key) if tasks > _default_tasks(df) else df


def per_chunk(docs: DataFrame, other: DataFrame | None, work: Callable, schema: str, chunks: int) -> DataFrame:
    """Run ``work(chunk)`` or, with messages to chunks, ``work(chunk, messages)`` once per chunk."""
    docs = spread(docs, "chunk", chunks)
    if other is None:
        return docs.groupBy("chunk").applyInArrow(lambda table: work(Chunk(table)), schema)

    def both(table: pa.Table, messages: pa.Table) -> pa.Table:
        return work(Chunk(table), messages)

    return docs.groupBy("chunk").cogroup(spread(other, "chunk", chunks).groupBy("chunk")).applyInArrow(both, schema)


def per_bucket(sent: DataFrame, work: Callable, schema: str, buckets: int) -> DataFrame:
    """Run ``work(table)`` once per bucket."""
    return spread(sent, "bucket", buckets).groupBy("bucket").applyInArrow(work, schema)


# --- which hashes occur at a second place ------------------------------------

REPEATED, INDEXED = np.uint64(1), np.uint64(2)
BLOB = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary())])


def pack64(values: np.ndarray) -> bytes:
    """Sorted values as the runs (value, count) of their high 16 bits and 48 low bits each."""
    high = (values >> np.uint64(48)).astype(np.uint16)
    cut = np.flatnonzero(np.r_[True, high[1:] != high[:-1]][: len(high)])
    count = np.diff(np.r_[cut, len(high)]).astype(np.uint32)
    return np.uint32(len(cut)).tobytes() + high[cut].tobytes() + count.tobytes() + pack48(values)


def unpack64(blob: bytes) -> np.ndarray:
    n = int(np.frombuffer(blob, np.uint32, 1)[0])
    high = np.frombuffer(blob, np.uint16, n, 4)
    count = np.frombuffer(blob, np.uint32, n, 4 + 2 * n)
    return unpack48(blob[4 + 6 * n :]) | (np.repeat(high, count).astype(np.uint64) << np.uint64(48))


def hash_blobs(chunk: int, hashes: np.ndarray, indexed: np.ndarray, buckets: int) -> pa.Table:
    """Per bucket, the chunk's distinct hashes (62 bits), flagged if indexed and if repeated in the chunk."""
    if not len(hashes):
        return BLOB.empty_table()
    value = np.sort((hashes & ~np.uint64(3)) | np.where(indexed, INDEXED, np.uint64(0)))
    plain = value >> np.uint64(2)
    cut = np.flatnonzero(np.r_[True, plain[1:] != plain[:-1]])
    often = np.diff(np.r_[cut, len(plain)]) > 1
    value = np.bitwise_or.reduceat(value, cut) | np.where(often, REPEATED, np.uint64(0))
    owner, bounds = by_bucket(value, buckets)
    blobs = [pack64(value[a:b]) for a, b in zip(bounds, bounds[1:])]
    return pa.table(
        [pa.array(owner, pa.int32()), pa.array([chunk] * len(owner), pa.int32()), pa.array(blobs, pa.binary())], schema=BLOB
    )


def cuts(sorted_keys: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal keys."""
    first = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1 if len(sorted_keys) else np.zeros(0, np.int64)
    return np.r_[0, first, len(sorted_keys)] if len(sorted_keys) else np.zeros(1, np.int64)


def live_hashes(table: pa.Table) -> pa.Table:
    """Per chunk, its hashes of this bucket that are indexed somewhere and occur twice."""
    chunk_of = table.column("chunk").to_pylist()
    parts = [unpack64(b) for b in table.column("hashes").to_pylist()]
    value = np.concatenate(parts)
    source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.argsort(value, kind="stable")
    value, source = value[order], source[order]
    plain = value >> np.uint64(2)
    bounds = cuts(plain)
    size = np.diff(bounds)
    flags = np.bitwise_or.reduceat(value, bounds[:-1])
    keep = np.repeat(((flags & INDEXED) > 0) & (((flags & REPEATED) > 0) | (size > 1)), size)
    value, source = plain[keep] << np.uint64(2), source[keep]
    order = np.argsort(source, kind="stable")  # values stay sorted within a source
    value, source = value[order], source[order]
    bounds = cuts(source)
    return pa.table(
        {
            "chunk": pa.array([chunk_of[s] for s in source[bounds[:-1]]], pa.int32()),
            "hashes": pa.array([pack64(value[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()),
        }
    )


def is_live(hashes: np.ndarray, messages: pa.Table) -> np.ndarray:
    """Which hashes a chunk's messages from ``live_hashes`` name."""
    if not len(messages) or not len(hashes):
        return np.zeros(len(hashes), bool)
    live = np.sort(np.concatenate([unpack64(b) for b in messages.column("hashes").to_pylist()]))
    found = hashes & ~np.uint64(3)
    return live[np.minimum(np.searchsorted(live, found), len(live) - 1)] == found
