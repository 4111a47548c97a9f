"""CSV records whose quoted fields hold line breaks, read in parallel.

Spark's CSV reader gives such a file to one task. Here Spark reads it as lines,
in as many pieces as any text file:

1. every piece reports its quote states (``probe.piece_states``);
2. the states of the pieces before it tell whether a piece begins inside a quoted
   field (one small group per file);
3. every piece puts its lines together to records. A record that is open at the
   end of a piece is a fragment, as is what a piece begins with inside quotes;
4. the fragments, at most two per piece, are joined to records by file and place.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finlake.session import scratch_path
from finlake.sources.probe import cut_records, piece_states, raw_lines

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Kinds of rows: a whole record, and the fragments in the order in which a piece can hold them.
WHOLE, ENDS_ONE, GOES_ON, BEGINS_ONE = 0, 1, 2, 3
#: Bytes of records yielded at a time.
BATCH_BYTES = 4 << 20


def starts_inside(pieces: DataFrame) -> DataFrame:
    """(path, block): the pieces that begin inside a quoted field."""

    def prefix(pdf):
        inside, out = False, []
        for p in pdf.sort_values("block").itertuples():
            if inside:
                out.append(p.block)
            inside = p.end_in if inside else p.end_out
        found = pdf[pdf["block"].isin(out)]
        return found[["path", "block"]]

    return pieces.groupBy("path").applyInPandas(prefix, "path string, block long")


class Piece:
    """Records of one piece of a file, line by line."""

    def __init__(self, path: str, block: int, inside: bool, sep: bytes):
        self.path, self.block, self.quoted, self.sep = path, block, inside, sep
        self.begun_inside = inside
        self.parts: list[bytes] = []
        self.header = block == 0

    def row(self, kind: int) -> tuple | None:
        record = self.sep.join(self.parts)
        self.parts = []
        if kind == WHOLE and not record.strip():
            return None
        first, self.header = self.header, False
        return self.path, self.block, kind, first, record

    def feed(self, line: bytes) -> Iterator[tuple]:
        ended, rest, self.quoted = cut_records(line, self.quoted)
        if not self.quoted:  # the line's own end ends a record
            ended.append(rest)
        for record in ended:
            self.parts.append(record)
            kind, self.begun_inside = ENDS_ONE if self.begun_inside else WHOLE, False
            if row := self.row(kind):
                yield row
        if self.quoted:
            self.parts.append(rest)

    def end(self) -> Iterator[tuple]:
        if self.quoted:
            yield self.row(GOES_ON if self.begun_inside else BEGINS_ONE)


RECORDS = "path string, block long, kind int, first boolean, record binary"


def csv_records(spark: SparkSession, paths: list[str], sep: str, work: str | None = None) -> DataFrame:
    """(path, record): the records of files whose lines end with ``sep`` ("\\n", also after "\\r",
    or "\\r"), as bytes, without each file's first record and without blank ones. Records
    are kept below ``work``, or the shared scratch folder, until the caller is done."""
    lines = raw_lines(spark, paths, sep)
    inside = starts_inside(piece_states(lines)).withColumn("inside", F.lit(True))
    # at most one row per piece of a file
    told = lines.join(F.broadcast(inside), ["path", "block"], "left")
    joiner = sep.encode()

    def emit(batches: Iterator) -> Iterator:
        import pandas as pd

        names, now = [c.split()[0] for c in RECORDS.split(", ")], None
        for batch in batches:
            rows, size = [], 0
            for path, block, line, begun in zip(batch["path"], batch["block"], batch["line"], batch["inside"]):
                if now is None or (path, block) != (now.path, now.block):
                    rows += now.end() if now else ()
                    now = Piece(path, block, begun is True or begun == True, joiner)  # noqa: E712  numpy's or Python's
                for row in now.feed(line):
                    rows.append(row)
                    size += len(row[4])
                if size > BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=names)
                    rows, size = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names)
        if rows := list(now.end()) if now else []:
            yield pd.DataFrame(rows, columns=names)

    # used twice, so written once
    folder = f"{work or scratch_path(spark, 'records')}/records-{uuid.uuid4().hex}"
    told.mapInPandas(emit, RECORDS).write.parquet(folder)
    found = spark.read.schema(RECORDS).parquet(folder)
    whole = found.filter(F.col("kind") == WHOLE).select("path", "first", "record")
    place = Window.partitionBy("path").orderBy("block", "kind")
    part = F.struct("block", "kind", "record")
    text = F.aggregate(
        F.slice(F.col("parts"), 2, F.greatest(F.size("parts") - 1, F.lit(0))),
        F.col("parts")[0]["record"],
        lambda seen, p: F.concat(seen, F.lit(joiner), p["record"]),
    )
    stitched = (
        found.filter(F.col("kind") != WHOLE)
        .withColumn("number", F.sum((F.col("kind") == BEGINS_ONE).cast("int")).over(place))
        .groupBy("path", "number")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"), F.bool_or("first").alias("first"))
        .select("path", "first", text.alias("record"))
    )
    return whole.unionByName(stitched).filter("not first").select("path", "record")
