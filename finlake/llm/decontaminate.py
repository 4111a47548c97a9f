"""Benchmark decontamination by winnowing.

A benchmark window is ``window`` consecutive words of an item (an item with
fewer words is one window). For a span length L both sides keep, in every span
of L words, the smallest hash among the k-word grams inside it (rightmost on
ties), k = (L + 1) // 2. Equal spans keep equal grams, so joining the kept
document grams with the kept benchmark grams finds every shared span of L words
or more. Each hit is then extended to the windows around it, which are compared
as a whole (64-bit hashes of all their words).

Kept document grams are about two in L - k + 2 words; they stream through a
join with the benchmark's grams, which is a broadcast while the benchmark has at
most ``BROADCAST_ROWS`` windows (counted first) and a shuffle join beyond.

Defined cases: a null or empty text has no words and no hits; an item without
words has no window; repeated documents are judged each on its own; repeated
items and windows count once per item_id; an item with a null id hits like any
other, but has no id to report, so it is left out of n_items and items_sha256; ids
of any type are compared as text; other columns are ignored whatever their
names; empty tables on either side give rows without hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize
from .textops import ALNUM_WORDS, LOWER, SpanHash, gram_mask, slices, utf8, word_hashes, words

WINDOW = 10
BROADCAST_ROWS = 1_000_000


def parameters(length: int) -> tuple[int, int]:
    """Gram size and number of grams in a span of ``length`` words."""
    k = (length + 1) // 2
    return k, length - k + 1


def winnow(grams: np.ndarray, ok: np.ndarray, span_ok: np.ndarray, n: int) -> np.ndarray:
    """Position of the smallest gram (rightmost on ties) of every span of ``n`` grams."""
    views = np.lib.stride_tricks.sliding_window_view(grams, n)[: len(span_ok)][:, ::-1]
    return np.arange(len(views)) + (n - 1 - np.argmin(views, axis=1))


class Spans:
    """Hashes of all words, grams and spans of a slice of texts."""

    def __init__(self, texts: pa.Array, word_hash: SpanHash, span_hash: SpanHash):
        data, offsets = utf8(texts)
        data = LOWER[data]
        starts, ends, self.first = words(data, offsets, ALNUM_WORDS)
        self.n = len(starts)
        self.prefix = span_hash.prefix(word_hashes(data, starts, ends, word_hash))
        self.span_hash = span_hash

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(span starts, span hashes, kept gram position per span, gram hashes) for spans of ``length`` words."""
        k, n = parameters(length)
        if self.n < length:
            none = np.zeros(0, np.int64)
            return none, none.astype(np.uint64), none, none.astype(np.uint64)
        grams = self.span_hash.grams(self.prefix, k)
        valid = gram_mask(self.first, self.n, length)
        kept = winnow(grams, valid, valid, n)
        starts = np.flatnonzero(valid)
        return starts, self.span_hash.grams(self.prefix, length), kept[starts], grams


def _i64(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def benchmark_windows(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, len, gram, span): every distinct window of every item with its kept gram."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hash, span_hash = SpanHash(1), SpanHash(2)
        for batch in batches:
            for part in slices(batch):
                spans = Spans(part.column("text"), word_hash, span_hash)
                counts = np.diff(spans.first)
                owner = np.repeat(np.arange(len(counts)), counts)
                for length in sorted({min(window, int(c)) for c in np.unique(counts) if c}):
                    starts, hashes, kept, grams = spans.of(length)
                    mine = counts[owner[starts]]
                    use = (mine >= window) if length == window else (mine == length)
                    starts, kept = starts[use], kept[use]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("item_id").take(pa.array(owner[starts])),
                            pa.array(np.full(len(starts), length, np.int32)),
                            _i64(grams[kept]),
                            _i64(hashes[starts]),
                        ],
                        ["item_id", "len", "gram", "span"],
                    )

    two = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(emit, "item_id string, len int, gram long, span long").distinct()


def document_grams(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """Kept grams of every document with the hashes of the spans that keep them,
    after one header row (pos -1) per document with its number of words."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hash, span_hash = SpanHash(1), SpanHash(2)
        names = ["row", "doc_id", "text_hash", "n_words", "len", "pos", "gram", "spans"]
        for batch in batches:
            for part in slices(batch):
                spans = Spans(part.column("text"), word_hash, span_hash)
                counts = np.diff(spans.first)
                owner = np.repeat(np.arange(len(counts)), counts)
                rows = len(part)
                # a header's gram is only a spread-out value: no join takes it (its pos is -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(counts.astype(np.int64)),
                        pa.array(np.zeros(rows, np.int32)),
                        pa.array(np.full(rows, -1, np.int64)),
                        part.column("row"),
                        pa.nulls(rows, pa.list_(pa.int64())),
                    ],
                    names,
                )
                for length in lengths:
                    starts, hashes, kept, grams = spans.of(length)
                    if not len(starts):
                        continue
                    # spans of one document that keep the same gram are neighbours; a gram of
                    # a repeated text can be kept again by a later run, which is a row of its own
                    cut = np.flatnonzero(np.r_[True, (kept[1:] != kept[:-1]) | (owner[starts[1:]] != owner[starts[:-1]])])
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.r_[cut, len(starts)].astype(np.int32)), _i64(hashes[starts])
                    )
                    head = owner[starts[cut]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("row").take(pa.array(head)),
                            part.column("doc_id").take(pa.array(head)),
                            part.column("text_hash").take(pa.array(head)),
                            pa.array(counts[head].astype(np.int64)),
                            pa.array(np.full(len(cut), length, np.int32)),
                            pa.array((starts[cut] - spans.first[head]).astype(np.int64)),
                            _i64(grams[kept[cut]]),
                            lists,
                        ],
                        names,
                    )

    schema = "row long, doc_id long, text_hash long, n_words long, len int, pos long, gram long, spans array<long>"
    return docs.mapInArrow(emit, schema)


def _joinable(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")


def hit_windows(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(hits, benchmark windows). Hits: one header row (start null) per document and one
    row per document place where a benchmark window occurs: row, doc_id, text_hash, n_words, len, start, span."""
    bench = materialize(benchmark_windows(items, window), "benchmark-windows")
    per_length = bench.groupBy("len").count().collect()  # at most ``window`` rows
    lengths, n_windows = sorted(r["len"] for r in per_length), sum(r["count"] for r in per_length)
    two = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("text_hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    kept = document_grams(two, lengths).alias("d")
    grams = bench.select("len", "gram").distinct().withColumn("known", F.lit(True)).alias("b")
    spans = bench.select("len", "span").distinct().withColumn("found", F.lit(True)).alias("s")
    same = (F.col("d.gram") == F.col("b.gram")) & (F.col("d.len") == F.col("b.len")) & (F.col("d.pos") >= 0)
    candidates = (
        kept.join(_joinable(grams, n_windows), same, "left")
        .filter("d.pos < 0 or known")
        .select("row", "doc_id", "text_hash", "n_words", "d.len", "pos", F.posexplode_outer("spans").alias("shift", "span"))
        .withColumn("start", F.when(F.col("pos") >= 0, F.col("pos") + F.col("shift")))
        .alias("c")
    )
    whole = (F.col("c.span") == F.col("s.span")) & (F.col("c.len") == F.col("s.len"))
    hits = (
        candidates.join(_joinable(spans, n_windows), whole, "left")
        .filter("pos < 0 or found")
        .select("row", "doc_id", "text_hash", "n_words", "c.len", "start", "c.span")
    )
    return materialize(hits, "benchmark-hits"), bench


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: row (its place in the input), doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hits, bench = hit_windows(docs, items, window, id_col, text_col)
    order = Window.partitionBy("row").orderBy("start", "len")
    reach = F.max(F.col("start") + F.col("len")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    covered = (
        hits.filter("start is not null")
        .select("row", "start", "len")
        .distinct()
        .withColumn("reach", F.coalesce(reach, F.lit(0)))
        .groupBy("row")
        .agg(F.sum(F.greatest(F.lit(0), F.col("start") + F.col("len") - F.greatest("start", "reach"))).alias("n_hit"))
    )
    # the items of a window as one list, so a passage of many items stays one row per document and window
    holders = bench.filter("item_id is not null").groupBy("len", "span").agg(F.collect_set("item_id").alias("holders"))
    n_windows = bench.count()
    named = (
        hits.filter("start is not null")
        .select("row", "len", "span")
        .distinct()
        .join(_joinable(holders, n_windows), ["len", "span"])
        .groupBy("row")
        .agg(F.array_distinct(F.flatten(F.collect_list("holders"))).alias("items"))
    )
    items_text = F.concat_ws(",", F.array_sort(F.coalesce("items", F.array().cast("array<string>"))))
    return (
        hits.filter("start is null")
        .select("row", "doc_id", "n_words")
        .join(covered, "row", "left")
        .join(named, "row", "left")
        .select(
            "row",
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(items_text, 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window."""
    hits, _ = hit_windows(docs, items, window)
    bad = (
        hits.filter("start is not null")
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        .distinct()
    )
    same = docs["doc_id"].cast("long").eqNullSafe(bad["__id"]) & (F.xxhash64(docs["text"].cast("string")) == bad["__hash"])
    return docs.join(bad, same, "left_anti")
