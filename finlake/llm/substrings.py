"""Substring dedup on words by fixed-block anchors.

A repeat is a run of at least ``window`` words that also starts earlier.

1. Every document is cut into non-overlapping blocks of ``window // 2`` words,
   the index. Any window of ``window`` words holds a whole block of its document.
   All rolling block-sized grams of all documents probe the index; a gram is
   live when it equals an indexed block and occurs at a second place.
2. Windows around live grams are the only ones that can repeat. Their hashes
   (all words) meet by hash, the earliest place of each keeps its words, every
   other place is a repeat; neighbouring repeats join into maximal spans.
3. Covered words are taken out.

Both exchanges carry values made unique per chunk (see ``chunks``), so a passage
in a third of all documents is no hot key, and no pairs are formed. Windows are
compared by a 64-bit hash of all their words; block grams by 62 bits, whose
accidental matches only add candidates.

Defined cases: a null or empty text has no words and is kept as it is; "earlier"
is the smaller doc_id, then the earlier start, and a null id comes after every
other; rows that share an id count as the same place at the same start, so a
repeated row is no repeat of itself, and rows that share id and text are worked on
as one, however many they are; other columns pass by; empty in, empty out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Chunk, Plan, all_copies, by_bucket, chunked, distinct_rows, hash_blobs, is_live, live_hashes, per_bucket, per_chunk, plan, to_all_rows
from .storage import materialize, release
from .textops import SPACE_WORDS, SpanHash, doc_ranges, gram_mask, utf8, word_hashes, words

WINDOW = 20


class Words:
    """Words of a chunk and prefix hashes over them."""

    def __init__(self, chunk: Chunk, hashed: bool = True):
        self.data, self.offsets = utf8(chunk.texts)
        hasher = SpanHash(3)
        starts, ends, counts = ([np.zeros(0, np.int64)] for _ in range(3))
        hashes = [np.zeros(0, np.uint64)]
        for i, j in doc_ranges(self.offsets):
            base = self.offsets[i]
            data = self.data[base : self.offsets[j]]
            s, e, first = words(data, self.offsets[i : j + 1] - base, SPACE_WORDS)
            starts.append(s + base)
            ends.append(e + base)
            counts.append(np.diff(first))
            if hashed:
                hashes.append(word_hashes(data, s, e, hasher))
        self.starts, self.ends = np.concatenate(starts), np.concatenate(ends)
        self.first = np.r_[0, np.cumsum(np.concatenate(counts))]
        self.n = len(self.starts)
        self.owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        if hashed:
            self.grams_of = SpanHash(4)
            self.prefix = self.grams_of.prefix(np.concatenate(hashes))

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of all grams of ``size`` words inside one document."""
        if self.n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        ok = np.flatnonzero(gram_mask(self.first, self.n, size))
        return ok, self.grams_of.grams(self.prefix, size)[ok]


def gram_blobs(chunk: Chunk, block: int, buckets: int) -> pa.Table:
    """Per bucket, the distinct grams of the chunk and whether each is indexed or repeated here."""
    ws = Words(chunk)
    at, grams = ws.grams(block)
    return hash_blobs(chunk.number, grams, (at - ws.first[ws.owner[at]]) % block == 0, buckets)


PLACES = "bucket int, chunk int, hashes binary, ranks binary, places binary, done boolean"


def place_blobs(chunk: Chunk, messages: pa.Table, window: int, block: int, buckets: int) -> pa.Table:
    """Candidate windows by hash: the chunk's earliest place of each (``done`` false), and the
    places that are already known to repeat an earlier one of the chunk (``done``)."""
    schema = pa.schema(
        [("bucket", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary()), ("ranks", pa.binary()), ("places", pa.binary()), ("done", pa.bool_())]
    )
    if not len(messages) or chunk.number is None:
        return schema.empty_table()
    ws = Words(chunk)
    at, grams = ws.grams(block)
    hit = np.zeros(ws.n + 1, np.int64)
    hit[at[is_live(grams, messages)] + 1] = 1
    hits = np.cumsum(hit)  # live grams that start before a place
    at, hashes = ws.grams(window)
    candidate = hits[np.minimum(at + window - block + 1, ws.n)] > hits[at]
    at, hashes = at[candidate], hashes[candidate]
    if not len(at):
        return schema.empty_table()
    rank = chunk.rank[ws.owner[at]]
    inner = at - ws.first[ws.owner[at]]
    order = np.lexsort((inner, rank, hashes))
    at, hashes, rank, inner = at[order], hashes[order], rank[order], inner[order]
    head = np.r_[True, hashes[1:] != hashes[:-1]]
    group = np.cumsum(head) - 1
    cut = np.flatnonzero(head)
    # rows that share an id are one place at one start: all of them are sent
    repeat = (rank != rank[cut][group]) | (inner != inner[cut][group])
    sent = np.flatnonzero(~repeat)
    owner, bounds = by_bucket(hashes[sent], buckets)
    rows = {k: [] for k in ("hashes", "ranks", "places")}
    for a, b in zip(bounds, bounds[1:]):
        # in document order, ids and starts compress better than in hash order
        pick = sent[a:b]
        pick = pick[np.argsort(at[pick], kind="stable")]
        rows["hashes"].append(hashes[pick].tobytes())
        rows["ranks"].append(rank[pick].tobytes())
        rows["places"].append(inner[pick].astype(np.int32).tobytes() + at[pick].astype(np.int32).tobytes())
    n = len(owner)
    known = np.sort(at[repeat]).astype(np.int32)
    return pa.table(
        [
            pa.array(np.r_[owner, chunk.number % buckets], pa.int32()),
            pa.array([chunk.number] * (n + 1), pa.int32()),
            pa.array([*rows["hashes"], b""], pa.binary()),
            pa.array([*rows["ranks"], b""], pa.binary()),
            pa.array([*rows["places"], known.tobytes()], pa.binary()),
            pa.array([False] * n + [True]),
        ],
        schema=schema,
    )


def later_places(table: pa.Table) -> pa.Table:
    """Per chunk, the places (word numbers in the chunk) whose window starts earlier elsewhere."""
    chunks, out = [], []
    done = table.filter(table.column("done"))
    for c, p in zip(done.column("chunk").to_pylist(), done.column("places").to_pylist()):
        chunks.append(c)
        out.append(p)
    rest = table.filter(pc.invert(table.column("done")))
    if len(rest):
        number = rest.column("chunk").to_pylist()
        hashes = [np.frombuffer(b, np.uint64) for b in rest.column("hashes").to_pylist()]
        sizes = [len(h) for h in hashes]
        places = [np.frombuffer(b, np.int32).reshape(2, -1) for b in rest.column("places").to_pylist()]
        h = np.concatenate(hashes)
        rank = np.concatenate([np.frombuffer(b, np.int64) for b in rest.column("ranks").to_pylist()])
        inner, at = np.concatenate(places, axis=1)
        source = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((inner, rank, h))
        h, rank, inner, at, source = h[order], rank[order], inner[order], at[order], source[order]
        head = np.r_[True, h[1:] != h[:-1]]
        cut = np.flatnonzero(head)[np.cumsum(head) - 1]
        later = (rank != rank[cut]) | (inner != inner[cut])
        at, source = at[later], source[later]
        order = np.argsort(source, kind="stable")
        at, source = at[order], source[order]
        first = np.flatnonzero(np.r_[True, source[1:] != source[:-1]]) if len(source) else np.zeros(0, np.int64)
        bounds = np.r_[first, len(source)]
        chunks += [number[s] for s in source[first]]
        out += [np.sort(at[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])]
    return pa.table({"chunk": pa.array(chunks, pa.int32()), "places": pa.array(out, pa.binary())})


def covered_words(n: int, messages: pa.Table, window: int) -> np.ndarray:
    """True for the words of a chunk that some repeated window covers."""
    step = np.zeros(n + 1, np.int64)
    for b in messages.column("places").to_pylist():
        at = np.frombuffer(b, np.int32)
        np.add.at(step, at, 1)
        np.add.at(step, at + window, -1)
    return np.cumsum(step)[:n] > 0


def repeated_places(rows: DataFrame, corpus: Plan, window: int = WINDOW) -> DataFrame:
    """Messages: per chunk, the word places where a repeated window starts."""
    if window < 2:
        raise ValueError("a window holds at least two words")
    block = window // 2
    chunks, buckets = corpus.chunks, corpus.buckets
    slim = chunked(rows, chunks)
    blobs = per_chunk(slim, None, lambda c: gram_blobs(c, block, buckets), "bucket int, chunk int, hashes binary", chunks)
    live = materialize(per_bucket(blobs, live_hashes, "chunk int, hashes binary", buckets), "substring-live")
    release(rows.sparkSession)
    placed = per_chunk(slim, live, lambda c, m: place_blobs(c, m, window, block, buckets), PLACES, chunks)
    later = materialize(per_bucket(placed, later_places, "chunk int, places binary", buckets), "substring-later")
    release(rows.sparkSession)
    return later


def dedup_digest(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space)."""

    def finish(chunk: Chunk, messages: pa.Table) -> pa.Table:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("copies", pa.int64())]
        )
        if chunk.number is None:
            return schema.empty_table()
        ws = Words(chunk, hashed=False)
        gone = covered_words(ws.n, messages, window)
        removed = np.add.reduceat(np.r_[gone, False].astype(np.int64), ws.first[:-1]) * (np.diff(ws.first) > 0)
        shas = []
        for i in range(len(ws.first) - 1):
            a, b = ws.first[i], ws.first[i + 1]
            text = ws.data[ws.offsets[i] : ws.offsets[i + 1]].tobytes().split()
            if removed[i]:
                text = [w for w, g in zip(text, gone[a:b]) if not g]
            shas.append(hashlib.sha256(b" ".join(text)).hexdigest())
        ids = chunk.ids.combine_chunks() if isinstance(chunk.ids, pa.ChunkedArray) else chunk.ids
        columns = [ids, pa.array(np.diff(ws.first)), pa.array(removed), pa.array(shas), chunk.table.column("copies")]
        return pa.table(columns, schema=schema)

    corpus = plan(docs, id_col, text_col)
    rows = distinct_rows(docs, corpus, id_col, text_col)
    later = repeated_places(rows, corpus, window)
    parts = chunked(rows, corpus.chunks, carry=("copies",))
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string, copies long"
    return all_copies(per_chunk(parts, later, finish, out, corpus.chunks), corpus)


def cut_texts(chunk: Chunk, messages: pa.Table, window: int) -> tuple[list[str | None], np.ndarray]:
    """(texts of the chunk without their repeated spans, numbers of the texts that changed)."""
    ws = Words(chunk, hashed=False)
    gone = covered_words(ws.n, messages, window)
    texts = chunk.table.column("text").to_pylist()
    changed = np.unique(ws.owner[gone])
    for i in changed:
        a, b = ws.first[i], ws.first[i + 1]
        keep = np.ones(ws.offsets[i + 1] - ws.offsets[i], bool)
        mine, base = gone[a:b], ws.offsets[i]
        edge = np.flatnonzero(np.diff(np.r_[False, mine, False].astype(np.int8)))
        for x, y in zip(edge[::2], edge[1::2]):
            keep[ws.starts[a + x] - base : ws.starts[a + y] - base if a + y < b else len(keep)] = False
        texts[i] = ws.data[base : ws.offsets[i + 1]][keep].tobytes().decode()
    return texts, changed


def dedup_texts(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every repeated span cut out of its texts; texts without repeats stay as they are.

    A span is cut from its first word to the start of the next kept word. All other
    columns are as they were, whatever their names; repeated rows are cut alike."""
    corpus = plan(docs, id_col, text_col)
    rows = distinct_rows(docs, corpus, id_col, text_col)
    later = repeated_places(rows, corpus, window)
    if corpus.repeats:

        def changed_only(chunk: Chunk, messages: pa.Table) -> pa.Table:
            table = chunk.table.drop_columns(["chunk"])
            if chunk.number is None:
                return table.append_column("new_text", table.column("text"))
            texts, changed = cut_texts(chunk, messages, window)
            return table.append_column("new_text", pa.array(texts, pa.string())).take(pa.array(changed, pa.int64()))

        parts = chunked(rows, corpus.chunks, carry=("copies",))
        out = "doc_id long, text string, copies long, new_text string"
        changed = materialize(per_chunk(parts, later, changed_only, out, corpus.chunks), "substring-cut")
        return to_all_rows(docs, changed, corpus, id_col, text_col)

    def finish(chunk: Chunk, messages: pa.Table) -> pa.Table:
        table = chunk.table
        if chunk.number is not None:
            texts, _ = cut_texts(chunk, messages, window)
            table = table.set_column(table.column_names.index("text"), "text", pa.array(texts, pa.string()))
        return table.drop_columns(["chunk"])

    parts = chunked(docs, corpus.chunks, id_col, text_col, carry=True)
    fields = [f for f in parts.schema.fields if f.name != "chunk"]
    out = per_chunk(parts, later, finish, type(parts.schema)(fields), corpus.chunks)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns])
