"""Exact dedup by content sort.

1. Texts are normalised (A-Z lower-cased, null is empty) to bytes.
2. Sampled splitters range-partition them by content: the first bytes, a hash of
   all bytes, and the row's place in the input. The last part cuts a group of
   copies over as many partitions as it fills, so one text may be a third of all
   rows; the first two keep equal texts next to each other in the whole order.
3. Every partition is sorted by content (Spark's sort, which spills) and read
   once: each text is compared in full with the one before it, equal neighbours
   form a run, and of a run the row with the first identifier is noted.
4. Only the first and the last run of a partition can go on in another one.
   Their texts (two per partition) are grouped once more, and what a cut group
   amounts to is broadcast to its rows.

What the driver holds is Spark's sample of the sort keys (at most 100 per
partition, ``PREFIX`` bytes and two numbers each); what a task holds is a batch of
texts and the identifiers of one run.

Defined cases: a null text equals an empty one; long texts are compared whole;
a null id is never preferred to another (a group without ids has a null
``keep_id``); of rows that share the kept id the first of the input stays, so
repeated rows leave one; other columns are carried as they are, whatever their
names; empty in, empty out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import materialize
from .textops import LOWER, slices, utf8

#: Leading bytes of a text in the sort key.
PREFIX = 32
#: Normalised bytes of a sort partition, until there are MANY partitions.
PART_BYTES, MANY = 32 << 20, 50_000


def normalised(texts: pa.Array) -> pa.Array:
    """UTF-8 bytes of each text with A-Z lower-cased; null is empty."""
    data, offsets = utf8(texts)
    return pa.Array.from_buffers(
        pa.binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(LOWER[data])]
    )


def content_rows(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """(row, doc_id, norm[, rest]): rest holds all columns of the input."""
    cols = [
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ]
    if carry:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"))
    slim = docs.select(*cols)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                columns = {c: part.column(c) for c in part.schema.names if c != "text"}
                yield pa.RecordBatch.from_pydict(columns | {"norm": normalised(part.column("text"))})

    fields = [f for f in slim.schema.fields if f.name != "text"]
    return slim.mapInArrow(emit, T.StructType([*fields, T.StructField("norm", T.BinaryType())]))


class Runs:
    """Runs of equal texts in one sorted partition, fed batch by batch."""

    def __init__(self, part: int, names: list[str]):
        self.part, self.names = part, names
        self.number = 0
        self.text: bytes | None = None  # of the open run
        self.open: list[pa.RecordBatch] = []

    def rows(self, batch: pa.RecordBatch, starts: np.ndarray, texts: list[bytes], edges: list[bool]) -> pa.RecordBatch:
        """Result rows of whole runs that begin at ``starts`` of ``batch``."""
        n = np.diff(np.r_[starts, len(batch)])
        owner = np.repeat(np.arange(len(n)), n)
        first = pa.array(starts[owner])
        sha = pa.array([hashlib.sha256(t).hexdigest() for t in texts])
        at_start = np.zeros(len(batch), bool)
        at_start[starts] = True
        edge = [None] * len(batch)
        for s, text, is_edge in zip(starts, texts, edges):
            if is_edge:
                edge[s] = text
        columns = {c: batch.column(c) for c in self.names} | {
            "part": pa.array(np.full(len(batch), self.part, np.int32)),
            "run": pa.array(self.number + owner),
            "n": pa.array(n[owner]),
            "best_id": batch.column("doc_id").take(first),
            "best_row": batch.column("row").take(first),
            "sha": sha.take(pa.array(owner)),
            "edge": pa.array(edge, pa.binary()),
        }
        self.number += len(n)
        return pa.RecordBatch.from_pydict(columns)

    def close(self, last: bool) -> pa.RecordBatch:
        batch = self.open[0] if len(self.open) == 1 else pa.concat_batches(self.open)
        return self.rows(batch, np.zeros(1, np.int64), [self.text], [last or self.number == 0])

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        norm = batch.column("norm")
        if not len(norm):
            return
        fresh = np.ones(len(norm), bool)
        fresh[0] = self.text is None or norm[0].as_py() != self.text
        fresh[1:] = ~np.asarray(pc.equal(norm.slice(1), norm.slice(0, len(norm) - 1)))
        starts = np.flatnonzero(fresh)
        slim = batch.select(self.names)
        if not len(starts):
            self.open.append(slim)
            return
        if self.text is not None:
            if starts[0]:
                self.open.append(slim.slice(0, int(starts[0])))
            yield self.close(last=False)
        whole, tail = starts[:-1], int(starts[-1])
        if len(whole):
            head = slim.slice(int(whole[0]), tail - int(whole[0]))
            texts = [norm[int(s)].as_py() for s in whole]
            yield self.rows(head, whole - whole[0], texts, [self.number + i == 0 for i in range(len(whole))])
        self.open, self.text = [slim.slice(tail)], norm[tail].as_py()

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.text is not None:
            yield self.close(last=True)


def copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", carry: bool = False
) -> DataFrame:
    """Per input row: row, doc_id, keep_id, group_size, kept, text_sha256 and, with ``carry``, rest (the input's columns).

    ``keep`` says which identifier of equal texts stays, the "smallest" or the "largest"."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    rows = content_rows(docs, id_col, text_col, carry)
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, min(MANY, -(-total // PART_BYTES)))
    key = F.bitwise_not("doc_id") if keep == "largest" else F.col("doc_id")
    order = [F.substring("norm", 1, PREFIX), F.xxhash64("norm")]
    preferred = [F.col("doc_id").isNull(), key, F.col("row")]
    ordered = rows.repartitionByRange(parts, *order, "row").sortWithinPartitions(*order, "norm", *preferred)
    names = [c for c in rows.columns if c != "norm"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        runs = Runs(TaskContext.get().partitionId(), names)
        for batch in batches:
            yield from runs.feed(batch)
        yield from runs.end()

    added = "part int, run long, n long, best_id long, best_row long, sha string, edge binary"
    schema = T.StructType([*(rows.schema[c] for c in names), *T.StructType.fromDDL(added).fields])
    found = materialize(ordered.mapInArrow(emit, schema), "content-runs")

    # two runs of a partition at most, so at most 2 * ``parts`` rows
    edges = found.filter("edge is not null")
    best = F.bitwise_not("best_id") if keep == "largest" else F.col("best_id")
    whole = edges.groupBy("edge").agg(
        F.sum("n").alias("total"),
        F.min(F.struct(F.col("best_id").isNull().alias("no_id"), best.alias("key"), "best_row", "best_id")).alias("best"),
    )
    cut = edges.select("part", "run", "edge").join(whole, "edge").select("part", "run", "total", "best")
    joined = found.join(F.broadcast(cut), ["part", "run"], "left")
    seen = F.col("total").isNotNull()
    return joined.select(
        "row",
        "doc_id",
        F.when(seen, F.col("best.best_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("total", "n").alias("group_size"),
        (F.col("row") == F.when(seen, F.col("best.best_row")).otherwise(F.col("best_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *(["rest"] if carry else []),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    return copies(docs, id_col, text_col, keep, carry=True).filter("kept").select("rest.*")
