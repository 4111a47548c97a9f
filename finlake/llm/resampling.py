"""Importance resampling towards a target distribution of hashed n-grams.

Counting. The texts of a batch are joined with a separator between them, one
regular expression pass finds all words of the batch, ``searchsorted`` of the
documents' offsets tells whose a word is, and runs of words that would cross
documents are masked before a ``bincount`` over the buckets. A feature is a run of
1 to ``MAX_GRAM`` words joined by one space, repeats counted; its bucket is the
CRC-32 of its bytes modulo ``BUCKETS``. CRCs of runs come from those of their words
(the CRC of a concatenation is a linear function of the parts' CRCs), so no
feature is ever built as a string. As finding words is the dear part, the buckets
of each document's features (two bytes each) are written once, below
spark.checkpoint.dir, and read for the counts and for the weights.

Weights. The whole corpus and the whole target are counted; a bucket's gain is
the scaled logarithm of its smoothed target share over its smoothed corpus share;
a document weighs the mean gain of its features.

Drawing. A document's score is its weight plus Gumbel noise from a hash of its
id, so the highest scores are a sample without replacement in proportion to the
exponential of the weights, the same on every run. Ranks come from a
range-partitioned sort and the partitions' sizes; nothing but ``BUCKETS`` counts
and one number per partition reaches the driver.

Defined cases: a null or empty text has no words, no features and weight 0; a
run never leaves its document; very long texts are a batch of their own; a row
without id has a null score, is not drawn and does not count among the documents
drawn from; repeated rows each count, score alike and are ranked one after the
other; other columns are ignored; an empty target or corpus counts nothing.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize
from .textops import LOWER, slices, utf8

BUCKETS = 10_000
MAX_GRAM = 2
MIN_WORDS = 20
PERCENT = 25
SEED = 7
SCALE = 1000

#: A word after lower-casing (as UTF-8: no multi-byte character is outside the class), or what lies between two words.
WORD_OR_GAP = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Between two documents: not a word byte.
SENTINEL = b"\n"


def _crc_table() -> np.ndarray:
    """CRC-32 of the 256 single bytes, from an all-zero register."""
    rows = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rows = np.where(rows & 1, (rows >> 1) ^ np.uint32(0xEDB88320), rows >> 1)
    return rows


class Crc:
    """CRC-32 of many byte spans at once, and of spans put one after another."""

    def __init__(self):
        self.table = _crc_table()
        #: shift[n]: what n zero bytes do to a register, as four tables of 256 entries.
        self.shift = np.zeros((0, 4, 256), np.uint32)

    def _grow(self, n: int) -> None:
        low = len(self.shift)
        if n < low:
            return
        tables = np.zeros((max(n + 1, 2 * low, 64), 4, 256), np.uint32)
        tables[:low] = self.shift
        if not low:
            for k in range(4):
                tables[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
            low = 1
        for i in range(low, len(tables)):
            before = tables[i - 1]
            tables[i] = self.table[before & 0xFF] ^ (before >> np.uint32(8))
        self.shift = tables

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 of data[start:end] for each span, a byte position of all spans at a time."""
        size = ends - starts
        order = np.argsort(-size, kind="stable")
        at, left = starts[order], size[order]
        register = np.full(len(at), 0xFFFFFFFF, np.uint32)
        # spans that still have a byte at place i come first
        live = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), side="left")
        for i, n in enumerate(live):
            if n < 16 and i > 64:
                break
            byte = data[at[:n] + i]
            head = register[:n]
            register[:n] = self.table[(head ^ byte) & np.uint32(0xFF)] ^ (head >> np.uint32(8))
        else:
            i = len(live)
        out = np.empty(len(at), np.uint32)
        out[order] = register ^ np.uint32(0xFFFFFFFF)
        if i < len(live):  # the few longest ones, one by one
            for j in range(int(live[i])):
                k = order[j]
                out[k] = zlib.crc32(data[starts[k] : ends[k]].tobytes())
        return out

    def joined(self, left: np.ndarray, right: np.ndarray, right_size: np.ndarray) -> np.ndarray:
        """CRC-32 of left + right from both CRCs and the size of right."""
        long = right_size >= 256
        self._grow(int(min(255, right_size.max(initial=0))))
        size = np.where(long, 0, right_size)
        out = right.copy()
        for k in range(4):
            out ^= self.shift[size, k, (left >> np.uint32(8 * k)) & np.uint32(0xFF)]
        for i in np.flatnonzero(long):
            out[i] = right[i] ^ self._shifted(int(left[i]), int(right_size[i]))
        return out

    def _shifted(self, register: int, n: int) -> np.uint32:
        self._grow(255)
        while n:
            step = min(n, 255)
            parts = [self.shift[step, k, (register >> (8 * k)) & 0xFF] for k in range(4)]
            register = int(parts[0] ^ parts[1] ^ parts[2] ^ parts[3])
            n -= step
        return np.uint32(register)


class Batch:
    """Words and feature buckets of the documents of one slice."""

    def __init__(self, texts: pa.Array, crc: Crc, buckets: int, max_gram: int):
        data, offsets = utf8(texts)
        # one separator after every document
        n = len(offsets) - 1
        at = offsets + np.arange(n + 1)
        joined = np.full(len(data) + n, SENTINEL[0], np.uint8)
        keep = np.ones(len(joined), bool)
        keep[at[1:] - 1] = False
        joined[keep] = LOWER[data]
        raw = joined.tobytes()
        # words and gaps take turns, so their lengths are all that is needed
        tokens = WORD_OR_GAP.findall(raw)
        edges = np.r_[0, np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))]
        first = 1 if tokens and GAP.match(tokens[0]) else 0
        starts, ends = edges[first:-1:2], edges[first + 1 :: 2]
        owner = np.searchsorted(at, starts, side="right") - 1
        self.n_words = np.bincount(owner, minlength=n)
        gram = crc.spans(joined, starts, ends)
        size = ends - starts
        space = np.full(len(gram), zlib.crc32(b" "), np.uint32)
        spaced = crc.joined(space, gram, size)  # " word"
        self.doc, self.bucket = [], []
        for g in range(1, max_gram + 1):
            if g > 1:
                if len(owner) < g:
                    break
                gram = crc.joined(gram[:-1], spaced[g - 1 :], size[g - 1 :] + 1)
            inside = owner[: len(gram)] == owner[g - 1 :]  # not across documents
            self.doc.append(owner[: len(gram)][inside])
            self.bucket.append((gram[inside] % np.uint32(buckets)).astype(np.int64))
        self.doc, self.bucket = np.concatenate(self.doc), np.concatenate(self.bucket)
        self.n_features = np.bincount(self.doc, minlength=n)


def features(
    docs: DataFrame, id_col: str | None, text_col: str = "text", buckets: int = BUCKETS, max_gram: int = MAX_GRAM
) -> DataFrame:
    """(doc_id, n_words, features): the bucket of every feature of every document, as packed numbers; written once, read twice."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = Crc()
        for batch in batches:
            for part in slices(batch):
                b = Batch(part.column("text"), crc, buckets, max_gram)
                order = np.argsort(b.doc, kind="stable")
                ends = kind.itemsize * np.r_[0, np.cumsum(b.n_features)]
                packed = pa.Array.from_buffers(
                    pa.binary(),
                    len(part),
                    [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(b.bucket[order].astype(kind))],
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(b.n_words.astype(np.int64)), packed], ["doc_id", "n_words", "features"]
                )

    ids = F.col(f"`{id_col}`").cast("long") if id_col else F.lit(None).cast("long")
    two = docs.select(ids.alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return materialize(two.mapInArrow(emit, "doc_id long, n_words long, features binary"), "resampling-features")


def unpacked(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all features, first feature of each document and the end)."""
    data, offsets = utf8(column)
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    return np.frombuffer(data.tobytes(), kind), offsets // kind.itemsize


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all documents: counted per task, summed by Spark."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "features"):
                total += np.bincount(unpacked(part.column("features"), buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    rows = found.select("features").mapInArrow(emit, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Scaled log ratio of the smoothed shares of each bucket, rounded down."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())

    def gain(s: int, t: int) -> int:
        return math.floor(scale * math.log(float((t + 1) * (s_all + buckets)) / float((s + 1) * (t_all + buckets))))

    return np.array([gain(int(s), int(t)) for s, t in zip(corpus, target)], np.int64)


def gumbel(doc_id: int, seed: int, scale: int = SCALE) -> int:
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(found: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score): one row per document."""
    buckets = len(gain)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "features"):
                feature, first = unpacked(part.column("features"), buckets)
                n = np.diff(first)
                sums = np.r_[0, np.cumsum(gain[feature])]
                weight = (sums[first[1:]] - sums[first[:-1]]) // np.maximum(n, 1)
                ids = part.column("doc_id").to_pylist()
                score = [None if i is None else int(w) + gumbel(i, seed) for i, w in zip(ids, weight)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_words"), pa.array(n), pa.array(weight), pa.array(score, pa.int64())],
                    ["doc_id", "n_words", "n_features", "weight", "score"],
                )

    return found.mapInArrow(emit, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, eligible: str, percent: int) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... by (score descending, doc_id) for the drawn share of the eligible ones."""
    spark = rows.sparkSession
    order = [F.col("score").desc(), F.col("doc_id")]
    in_draw = rows.filter(eligible).repartitionByRange(*order).sortWithinPartitions(*order)
    # the upper bits are the partition, the lower 33 the place in it
    placed = materialize(in_draw.withColumn("at", F.monotonically_increasing_id()), "resampling-order")
    part, place = F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(placed.groupBy(part).count().collect())  # one row per partition
    before, bases = 0, []
    for p, n in sizes:
        bases.append((p, before))
        before += n
    drawn = percent * before // 100
    base = spark.createDataFrame(bases, "base_part long, base long")
    numbered = (
        placed.join(F.broadcast(base), F.shiftright("at", 33) == F.col("base_part"))
        .withColumn("number", F.col("base") + place + 1)
        .withColumn("rank", F.when(F.col("number") <= drawn, F.col("number")))
    )
    rest = rows.filter(f"not coalesce({eligible}, false)").withColumn("rank", F.lit(None).cast("long"))
    columns = [*rows.columns, "rank"]
    return numbered.select(*columns).unionByName(rest.select(*columns))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    max_gram: int = MAX_GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per input row: doc_id, n_features, weight, score, rank (null if not drawn)."""
    found = features(docs, id_col, text_col, buckets, max_gram)
    wanted = bucket_counts(features(target, None, "text", buckets, max_gram), buckets)
    rows = materialize(weighted(found, gains(bucket_counts(found, buckets), wanted), seed), "resampling-weights")
    out = ranked(rows, f"doc_id is not null and n_words >= {int(min_words)}", percent)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` whose id was drawn, all columns as they were; rows that share an id go together."""
    ids = resample(docs, target, id_col=id_col, **how).filter("rank is not null").select(F.col("doc_id").alias("__drawn")).distinct()
    key = F.col(f"`{id_col}`").cast("long")
    return docs.join(ids, key == F.col("__drawn"), "left_semi")
