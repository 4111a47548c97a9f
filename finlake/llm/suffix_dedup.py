"""Repeated byte strings removed with suffix arrays of shards.

A byte goes if a string of ``length`` bytes that covers it also starts earlier.

1. Anchors (see ``anchors``) cut every document's windows into runs; equal
   windows have the same anchor. Anchors that occur once are done: nothing around
   them repeats.
2. The runs of the others meet by anchor as hashes of their bytes. All places of
   a run's bytes but the earliest are repeats as a whole. Where an anchor's runs
   have different bytes, the earliest place of each goes on.
3. Shards of these runs (by anchor; their text only) get a suffix array by
   induced sorting and permuted common prefixes; suffixes that share ``length``
   bytes are one string, all its places but the earliest are repeats. Anchors
   with more than ``HOT`` different runs would make a shard large, so their
   windows are spread by the windows' own hashes instead, unique per chunk.
4. Repeats are marked byte by byte and cut out.

Bytes travel only for step 3; everything else is hashes (62 bits of the anchor
and 64 of the run together, 64 bits for the windows of hot anchors).

Defined cases: a null or empty text has no bytes; "earlier" is the smaller
doc_id, then the earlier start, and a null id comes after every other; rows that
share an id are the same place at the same start, so a repeated row is no repeat
of itself, and rows that share id and text are worked on as one, however many they
are; matches never cross documents and may cut inside a character; other columns
are ignored; empty in, empty out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .anchors import runs as anchor_runs
from .chunks import Chunk, Plan, all_copies, by_bucket, chunked, cuts, distinct_rows, hash_blobs, is_live, live_hashes, per_bucket, per_chunk, plan
from .storage import materialize, release
from .suffixes import common_prefixes, suffix_array
from .textops import SpanHash, doc_ranges, utf8

LENGTH = 100
HOT = 256
CHUNK_BYTES = 2 << 20
SLICE_BYTES = 1 << 20

#: Places: id rank, start in the document, start in the chunk, number of windows.
PLACE = np.dtype([("rank", "<i8"), ("inner", "<i4"), ("at", "<i4"), ("windows", "<i4")])
KEYED = np.dtype([("anchor", "<u8"), ("span", "<u8")])
#: Messages to chunks. Repeats: ranges of window starts. Asked: runs whose bytes (or windows, if hot) are wanted.
REPEATS, ASKED, ASKED_HOT = 0, 1, 2
MESSAGE = pa.schema([("chunk", pa.int32()), ("kind", pa.int32()), ("places", pa.binary()), ("anchors", pa.binary())])
MESSAGE_DDL = "chunk int, kind int, places binary, anchors binary"
SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("places", pa.binary()), ("keys", pa.binary()), ("data", pa.binary())])
SENT_DDL = "bucket int, chunk int, kind int, places binary, keys binary, data binary"
DONE, RUNS, TEXTS, WINDOWS = 0, 1, 2, 3


class Bytes:
    """Bytes of a chunk."""

    def __init__(self, chunk: Chunk):
        self.data, self.offsets = utf8(chunk.texts)
        self.rank = chunk.rank

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first window, windows, anchor, hash of all bytes) of every run of the chunk."""
        hasher = SpanHash(7)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        for i, j in doc_ranges(self.offsets, SLICE_BYTES):
            base = self.offsets[i]
            data = self.data[base : self.offsets[j]]
            first, windows, anchor = anchor_runs(data, self.offsets[i : j + 1] - base, length)
            span = hasher.spans(hasher.bytes_prefix(data), first, first + windows + length - 1)
            out.append((first + base, windows, anchor, span))
        return tuple(np.concatenate(x) for x in zip(*out))

    def window_hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the windows that start at ``at``."""
        hasher = SpanHash(8)
        out = np.zeros(len(at), np.uint64)
        for i, j in doc_ranges(self.offsets, SLICE_BYTES):
            base, stop = self.offsets[i], self.offsets[j]
            here = np.flatnonzero((at >= base) & (at < stop))
            if len(here):
                out[here] = hasher.grams(hasher.bytes_prefix(self.data[base:stop]), length)[at[here] - base]
        return out

    def places(self, at: np.ndarray, windows: np.ndarray) -> np.ndarray:
        doc = np.searchsorted(self.offsets, at, side="right") - 1
        out = np.zeros(len(at), PLACE)
        out["rank"], out["inner"], out["at"], out["windows"] = self.rank[doc], at - self.offsets[doc], at, windows
        return out


def later(order: np.ndarray, head: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For groups that start where ``head`` is true in ``order``: which places come after their group's first place."""
    p = places[order]
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    return (p["rank"] != p["rank"][first]) | (p["inner"] != p["inner"][first])


def grouped(places: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, head): places by key, earliest first; where a new key starts."""
    order = np.lexsort((places["inner"], places["rank"], *keys[::-1]))
    head = np.zeros(len(order), bool)
    head[:1] = True
    for key in keys:
        k = key[order]
        head[1:] |= k[1:] != k[:-1]
    return order, head


def rows_of(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def anchor_blobs(chunk: Chunk, length: int, buckets: int) -> pa.Table:
    b = Bytes(chunk)
    _, _, anchor, _ = b.runs(length)
    return hash_blobs(chunk.number, anchor, np.ones(len(anchor), bool), buckets)


def run_blobs(chunk: Chunk, messages: pa.Table, length: int, buckets: int) -> pa.Table:
    """Runs with live anchors as hashes: the chunk's earliest place of each, and repeats known already."""
    if chunk.number is None or not len(messages):
        return SENT.empty_table()
    b = Bytes(chunk)
    first, windows, anchor, span = b.runs(length)
    live = is_live(anchor, messages)
    first, windows, anchor, span = first[live], windows[live], anchor[live], span[live]
    places = b.places(first, windows)
    order, head = grouped(places, anchor, span)
    known = later(order, head, places)
    rows = [(chunk.number % buckets, chunk.number, DONE, places[order[known]].tobytes(), b"", b"")]
    send = order[~known]
    keys = np.zeros(len(send), KEYED)
    keys["anchor"], keys["span"] = anchor[send], span[send]
    for bucket, x, y in _slices(anchor[send], buckets):
        rows.append((bucket, chunk.number, RUNS, places[send[x:y]].tobytes(), keys[x:y].tobytes(), b""))
    return rows_of(rows, SENT)


def _slices(sorted_hashes: np.ndarray, buckets: int):
    owner, bounds = by_bucket(sorted_hashes, buckets)
    return zip(owner.tolist(), bounds[:-1].tolist(), bounds[1:].tolist())


def _joined(table: pa.Table, kind: int) -> tuple[list[int], np.ndarray, np.ndarray, list[bytes]]:
    """(chunk of each row, places, row number of each place, rows) of one kind of message."""
    rows = [r for r in table.to_pylist() if r["kind"] == kind]
    parts = [np.frombuffer(r["places"], PLACE) for r in rows]
    places = np.concatenate(parts) if parts else np.zeros(0, PLACE)
    return [r["chunk"] for r in rows], places, np.repeat(np.arange(len(rows)), [len(p) for p in parts]), rows


def _to_chunks(kind: int, chunks: list[int], source: np.ndarray, places: np.ndarray, anchor: np.ndarray | None = None) -> list[tuple]:
    order = np.argsort(source, kind="stable")
    out = []
    for x, y in zip(b := cuts(source[order]), b[1:]):
        pick = order[x:y]
        named = anchor[pick].tobytes() if anchor is not None else b""
        out.append((chunks[source[pick[0]]], kind, places[pick].tobytes(), named))
    return out


def settle_runs(table: pa.Table) -> pa.Table:
    """Repeats among whole runs, and the runs whose bytes are wanted."""
    chunks, places, source, _ = _joined(table, DONE)
    out = _to_chunks(REPEATS, chunks, source, places)
    chunks, places, source, rows = _joined(table, RUNS)
    if len(places):
        keys = np.frombuffer(b"".join(r["keys"] for r in rows), KEYED)
        order, head = grouped(places, keys["anchor"], keys["span"])
        again = later(order, head, places)
        out += _to_chunks(REPEATS, chunks, source[order[again]], places[order[again]])
        anchor = keys["anchor"][order]
        bounds = cuts(anchor)
        different = np.repeat(np.add.reduceat(head.astype(np.int64), bounds[:-1]), np.diff(bounds))
        for kind, pick in ((ASKED, (different > 1) & (different <= HOT)), (ASKED_HOT, different > HOT)):
            pick = order[pick & ~again]
            out += _to_chunks(kind, chunks, source[pick], places[pick], keys["anchor"][pick])
    return rows_of(out, MESSAGE)


def text_blobs(chunk: Chunk, messages: pa.Table, length: int, buckets: int) -> pa.Table:
    """The bytes of the runs that were asked for; for hot anchors, hashes of their windows."""
    if chunk.number is None or not len(messages):
        return SENT.empty_table()
    b = Bytes(chunk)
    rows = []
    asked = [m for m in messages.to_pylist() if m["kind"] == ASKED]
    if asked:
        places = np.frombuffer(b"".join(m["places"] for m in asked), PLACE)
        anchor = np.frombuffer(b"".join(m["anchors"] for m in asked), np.uint64)
        order = np.argsort(anchor, kind="stable")
        places = places[order]
        size = places["windows"].astype(np.int64) + length - 1
        for bucket, x, y in _slices(anchor[order], buckets):
            total = np.cumsum(size[x:y])
            at = np.repeat(places["at"][x:y] - np.r_[0, total[:-1]], size[x:y]) + np.arange(total[-1])
            rows.append((bucket, chunk.number, TEXTS, places[x:y].tobytes(), b"", b.data[at].tobytes()))
    hot = [m for m in messages.to_pylist() if m["kind"] == ASKED_HOT]
    if hot:
        runs = np.frombuffer(b"".join(m["places"] for m in hot), PLACE)
        n = runs["windows"].astype(np.int64)
        at = np.repeat(runs["at"] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        hashes = b.window_hashes(at, length)
        places = b.places(at, np.ones(len(at), np.int64))
        order, head = grouped(places, hashes)
        known = later(order, head, places)
        rows.append((chunk.number % buckets, chunk.number, DONE, places[order[known]].tobytes(), b"", b""))
        send = order[~known]
        for bucket, x, y in _slices(hashes[send], buckets):
            rows.append((bucket, chunk.number, WINDOWS, places[send[x:y]].tobytes(), hashes[send[x:y]].tobytes(), b""))
    return rows_of(rows, SENT)


def shard_repeats(places: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, window in the run) of every window of the shard's runs that also starts earlier.

    ``text`` holds the runs' bytes one after the other."""
    size = places["windows"].astype(np.int64) + length - 1
    start = np.cumsum(size + 1) - size - 1  # one separator after each run
    data = np.zeros(int((size + 1).sum()), np.uint8)
    breaks = np.ones(len(data), bool)
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    data[at] = text
    breaks[at] = False
    valid = np.zeros(len(data), bool)
    n = places["windows"].astype(np.int64)
    windows = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    valid[windows] = True
    order = suffix_array(data, breaks)
    shared = common_prefixes(data, order, valid, length)
    order = order[valid[order]]
    string = np.cumsum(shared[order] < length)
    run = np.searchsorted(start, order, side="right") - 1
    offset = order - start[run]
    own = np.zeros(len(order), PLACE)
    own["rank"], own["inner"] = places["rank"][run], places["inner"][run] + offset
    first, head = grouped(own, string)
    again = first[later(first, head, own)]
    return run[again], offset[again]


def settle_windows(table: pa.Table, length: int) -> pa.Table:
    """Repeats found in a shard, as ranges of window starts."""
    chunks, places, source, _ = _joined(table, DONE)
    out = _to_chunks(REPEATS, chunks, source, places)
    chunks, places, source, rows = _joined(table, TEXTS)
    if len(places):
        run, offset = shard_repeats(places, np.frombuffer(b"".join(r["data"] for r in rows), np.uint8), length)
        order = np.lexsort((offset, run))
        run, offset = run[order], offset[order]
        new = np.r_[True, (run[1:] != run[:-1]) | (offset[1:] != offset[:-1] + 1)][: len(run)]
        begin = np.flatnonzero(new)
        found = places[run[begin]].copy()
        found["at"] += offset[begin].astype(np.int32)
        found["windows"] = np.diff(np.r_[begin, len(run)])
        out += _to_chunks(REPEATS, chunks, source[run[begin]], found)
    chunks, places, source, rows = _joined(table, WINDOWS)
    if len(places):
        order, head = grouped(places, np.frombuffer(b"".join(r["keys"] for r in rows), np.uint64))
        again = order[later(order, head, places)]
        out += _to_chunks(REPEATS, chunks, source[again], places[again])
    return rows_of(out, MESSAGE)


def repeated_ranges(rows: DataFrame, corpus: Plan, length: int = LENGTH) -> DataFrame:
    """Messages: per chunk, ranges of starts of strings that also start earlier."""
    spark = rows.sparkSession
    chunks, buckets = corpus.chunks, corpus.buckets
    parts = chunked(rows, chunks)
    blobs = per_chunk(parts, None, lambda c: anchor_blobs(c, length, buckets), "bucket int, chunk int, hashes binary", chunks)
    live = materialize(per_bucket(blobs, live_hashes, "chunk int, hashes binary", buckets), "suffix-anchors")
    release(spark)
    sent = per_chunk(parts, live, lambda c, m: run_blobs(c, m, length, buckets), SENT_DDL, chunks)
    asked = materialize(per_bucket(sent, settle_runs, MESSAGE_DDL, buckets), "suffix-runs")
    release(spark)
    wanted = asked.filter(f"kind <> {REPEATS}")
    sent = per_chunk(parts, wanted, lambda c, m: text_blobs(c, m, length, buckets), SENT_DDL, chunks)
    found = per_bucket(sent, lambda t: settle_windows(t, length), MESSAGE_DDL, buckets)
    found = materialize(found, "suffix-windows")
    release(spark)
    return asked.filter(f"kind = {REPEATS}").unionByName(found)


def dedup_digest(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and spans (start, end of each removed run)."""

    def finish(chunk: Chunk, messages: pa.Table) -> pa.Table:
        ddl = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
        ddl += [("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
        ddl += [("copies", pa.int64())]
        schema = pa.schema(ddl)
        if chunk.number is None:
            return schema.empty_table()
        b = Bytes(chunk)
        step = np.zeros(len(b.data) + 1, np.int32)
        for m in messages.column("places").to_pylist():
            p = np.frombuffer(m, PLACE)
            np.add.at(step, p["at"], 1)
            np.add.at(step, p["at"] + p["windows"] + length - 1, -1)
        gone = np.cumsum(step)[:-1] > 0
        rows = []
        ids, copies = chunk.ids.to_pylist(), chunk.table.column("copies").to_pylist()
        for i, doc in enumerate(ids):
            x, y = int(b.offsets[i]), int(b.offsets[i + 1])
            mine, text = gone[x:y], b.data[x:y]
            edge = np.flatnonzero(np.diff(np.r_[False, mine, False].astype(np.int8)))
            sha = hashlib.sha256((text[~mine] if len(edge) else text).tobytes()).hexdigest()
            spans = [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])]
            rows.append((doc, y - x, int(mine.sum()), len(spans), sha, spans, copies[i]))
        return rows_of(rows, schema)

    corpus = plan(docs, id_col, text_col, CHUNK_BYTES)
    distinct = distinct_rows(docs, corpus, id_col, text_col)
    messages = repeated_ranges(distinct, corpus, length)
    parts = chunked(distinct, corpus.chunks, carry=("copies",))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>, copies long"
    return all_copies(per_chunk(parts, messages, finish, out, corpus.chunks), corpus)
