"""Toxicity scores by weak supervision.

1. Voters. From labelled rows (a bounded sample, see ``MAX_ROWS``) the words and
   word stems (first 4, 5 and 6 bytes) that lean most to either class are found
   by distributed counts. A lexicon voter fires where its feature occurs, a pattern
   voter where its measure of shouting, exclamation marks or length is met. Those
   whose log ratio of firing rates lies ``SURE`` standard errors from zero may vote.
2. Label model. A generative model with a firing rate per voter and class is
   fitted by expectation-maximisation over votes alone. The labelled rows choose the
   voters and give the rates' first values and prior counts; a row's own label is no
   vote, so its posterior can contradict it. Correlations are estimated in each
   round from what the class leaves unexplained; voters that fire together share
   their weight: each log-likelihood ratio is divided by one plus the sum of its
   residual correlations to the power ``SHARPNESS``, so that copies of a voter count
   once and weak correlations hardly count. Many weak voters that share a cause other
   than the class (a language, long texts) would pull the model to that cause: a model
   is fitted for each least log ratio of ``STRENGTHS``, and the one whose posteriors
   agree best with the labelled rows as a whole is taken.
3. Classifier. A logistic regression over the features is trained on the model's
   posterior labels.
4. Every whole text is scored by the linear classifier, in tasks.

Only text, and the toxic label of rows whose crc32(id) mod 5 is not 0, are used.
What reaches the driver is bounded by parameters: ``N_FEATURES`` features and
``MAX_ROWS`` rows of ``N_FEATURES`` bits.

Defined cases: a null or empty text has no features and gets the score of the
bias alone; labels that are null are not used, an id labelled twice is toxic if
either label says so; of documents that share a labelled id, the one with the
smallest text hash is learned from; without labelled rows of both classes every score is the
labelled rows' share of toxic (0 without any); if no voter is sure enough, the share of toxic is every
row's posterior; repeated rows each get a result;
a null id is never held out nor learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize
from .textops import ALNUM_WORDS, LOWER, SpanHash, mix, slices, utf8, words

#: Bound on labelled rows that the model is fitted on (smallest hashes of their ids).
MAX_ROWS = 20_000
#: Features kept, half of the room for either class.
N_FEATURES = 512
#: Least documents of the sample that hold a feature.
MIN_DOCS = 3
STEMS = (4, 5, 6)
#: Text bytes whose features are in memory at a time.
SLICE = 1 << 20
#: Standard errors that a voter's log ratio lies from zero.
SURE = 3.0
#: Least sizes of a voter's log ratio that are tried.
STRENGTHS = (3.0, 2.0, 1.0, 0.0)
#: Least probability of a label when models are compared, so that wrong labels do not decide.
DOUBT = 0.01
#: Power of the residual correlations by which voters share weight.
SHARPNESS = 8
FOLDS = 5


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("long").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class Features:
    """Distinct feature hashes per document of a slice, and its pattern measures."""

    def __init__(self, texts: pa.Array, hasher: SpanHash, wanted: np.ndarray | None = None):
        raw, offsets = utf8(texts)
        data = LOWER[raw]
        starts, ends, first = words(data, offsets, ALNUM_WORDS)
        n = np.diff(first)
        owner = np.repeat(np.arange(len(n)), n)
        prefix = hasher.bytes_prefix(data)
        parts, owners = [mix(hasher.spans(prefix, starts, ends))], [owner]
        for size in STEMS:
            longer = np.flatnonzero(ends - starts > size)
            # other bits than a whole word of the same letters
            parts.append(hasher.spans(prefix, starts[longer], starts[longer] + size) ^ np.uint64(size))
            owners.append(owner[longer])
        h, doc = np.concatenate(parts), np.concatenate(owners)
        if wanted is not None and len(wanted):
            sieve = np.zeros(1 << 16, bool)
            sieve[(wanted & np.uint64(0xFFFF)).astype(np.int64)] = True
            may = sieve[(h & np.uint64(0xFFFF)).astype(np.int64)]
            h, doc = h[may], doc[may]
            slot = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            exact = wanted[slot] == h
            pair = np.unique(doc[exact] * len(wanted) + slot[exact])
            self.doc, self.slot = pair // len(wanted), pair % len(wanted)
        else:
            order = np.lexsort((h, doc))
            h, doc = h[order], doc[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])][: len(h)]
            self.hash, self.doc = h[new], doc[new]
        per = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][offsets])
        upper, bangs = per((raw >= 65) & (raw <= 90)), per(raw == 33)
        size = np.maximum(np.diff(offsets), 1)
        self.patterns = np.stack([upper / size > 0.2, bangs / size > 0.005, n < 20, n > 2000], axis=1)


N_PATTERNS = 4


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(toxic, text) of at most ``max_rows`` labelled ids that are not held out, one document each."""
    marked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("mark"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_rows)
    )
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most ``max_rows`` pairs of numbers: the texts stay where they are
    found = slim.join(F.broadcast(marked), slim["doc_id"] == marked["id"])
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))  # combined before the shuffle: a text per id and task
    return found.groupBy("id", "mark").agg(one.alias("d")).select(F.col("mark").alias("toxic"), "d.text")


def leaning_features(rows: DataFrame, totals: dict[int, int], n: int = N_FEATURES) -> np.ndarray:
    """Hashes of the features that lean most to toxic and to clean."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash(5)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                f = Features(part.column("text"), hasher)
                toxic = np.asarray(part.column("toxic"))[f.doc]
                value, slot = np.unique(f.hash, return_inverse=True)
                ones = np.bincount(slot, toxic == 1, len(value)).astype(np.int64)
                count = np.bincount(slot, minlength=len(value)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array(ones), pa.array(count - ones)], ["feature", "toxic", "clean"]
                )

    counts = (
        rows.mapInArrow(emit, "feature long, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") + F.col("clean") >= MIN_DOCS)
    )
    rate = lambda c, t: (F.col(c) + 0.5) / (t + 1.0)
    lean = F.log(rate("toxic", totals[1]) / rate("clean", totals[0]))
    scored = counts.select("feature", (lean * F.sqrt(F.col("toxic") + F.col("clean"))).alias("lean"), "toxic")
    toxic = scored.orderBy(F.desc("lean"), "feature").limit(n * 3 // 4).collect()  # bounded by n
    clean = scored.orderBy("lean", "feature").limit(n // 4).collect()
    chosen = [r.feature for r in toxic if r.lean > 0] + [r.feature for r in clean if r.lean < 0]
    return np.array(list(dict.fromkeys(chosen)), np.int64).view(np.uint64)


def feature_bits(rows: DataFrame, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(toxic, features present, patterns) of the sample, in a fixed order; bounded by ``MAX_ROWS`` rows of bits."""
    order = np.argsort(features)
    ordered = features[order]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash(5)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                f = Features(part.column("text"), hasher, ordered)
                bits = np.zeros((len(part), len(features) + N_PATTERNS), bool)
                bits[f.doc, order[f.slot]] = True
                bits[:, len(features) :] = f.patterns
                blobs = [row.tobytes() for row in np.packbits(bits, axis=1)]
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(blobs, pa.binary())], ["toxic", "bits"])

    got = sorted((r.toxic, bytes(r.bits)) for r in rows.mapInArrow(emit, "toxic int, bits binary").collect())
    packed = np.frombuffer(b"".join(b for _, b in got), np.uint8).reshape(len(got), -1)
    bits = np.unpackbits(packed, axis=1)[:, : len(features) + N_PATTERNS].astype(bool)
    return np.array([t for t, _ in got]), bits[:, : len(features)], bits[:, len(features) :]


def votes(present: np.ndarray, patterns: np.ndarray, toxic: np.ndarray, strength: float = 0.0) -> np.ndarray:
    """One column per voter of a log ratio above ``strength``, true where it fires."""
    candidates = np.concatenate([present, patterns], axis=1)
    fired = np.stack([candidates[~toxic].sum(axis=0), candidates[toxic].sum(axis=0)]) + 0.5
    rows = np.array([[(~toxic).sum()], [toxic.sum()]]) + 1.0
    ratio = np.log(fired[1] / rows[1]) - np.log(fired[0] / rows[0])
    return candidates[:, np.abs(ratio) > np.maximum(strength, SURE * np.sqrt((1 / fired).sum(axis=0)))]


def label_model(fired: np.ndarray, toxic: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Posterior probability of toxic per row, from the voters alone; without voters it is the share of toxic."""
    x = fired.astype(np.float32)
    gold = np.stack([~toxic, toxic]).astype(np.float32)
    gold_fired, gold_rows = gold @ x, gold.sum(axis=1, keepdims=True)
    first = (gold_fired + 0.5) / (gold_rows + 1)
    prior = toxic.mean()
    weight, posterior = gold, np.full(len(x), np.inf)
    for _ in range(rounds):
        rate = (weight @ x + gold_fired + first) / (weight.sum(axis=1, keepdims=True) + gold_rows + 1)
        # residual correlation of the voters given the class
        residual = np.zeros((x.shape[1],) * 2, np.float32)
        for c in (0, 1):
            centred = (x - rate[c]) * np.sqrt(weight[c])[:, None]
            residual += centred.T @ centred
        scale = np.sqrt(np.maximum(np.diag(residual), 1e-9))
        corr = residual / scale[:, None] / scale[None, :]
        np.fill_diagonal(corr, 0)
        share = 1 / (1 + (np.clip(corr, 0, 1) ** SHARPNESS).sum(axis=1))
        on = np.log(rate[1] / rate[0]) * share
        off = np.log((1 - rate[1]) / (1 - rate[0])) * share
        evidence = np.log(prior / (1 - prior)) + x @ on + (1 - x) @ off
        updated = 1 / (1 + np.exp(-np.clip(evidence, -30, 30)))
        done = np.abs(updated - posterior).max() < 1e-3
        posterior = updated
        weight = np.stack([1 - posterior, posterior]).astype(np.float32)
        if done:
            break
    return posterior


def posteriors(present: np.ndarray, patterns: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Those of the label model, of one for each set of voters, that agrees best with the labels; ties: stronger voters."""
    best, least, tried = np.zeros(0), np.inf, 0
    for strength in STRENGTHS:
        fired = votes(present, patterns, toxic, strength)
        if fired.shape[1] == tried and (tried or strength):  # the sets are nested: none more, or none yet
            continue
        tried = fired.shape[1]
        posterior = label_model(fired, toxic)
        loss = -np.log(np.maximum(np.where(toxic, posterior, 1 - posterior), DOUBT)).mean()
        if loss < least:
            best, least = posterior, loss
    return best


def logistic(x: np.ndarray, target: np.ndarray, l2: float = 3e-5, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias for soft targets, by accelerated gradient steps."""
    x = x.astype(np.float32)
    row = np.full(len(x), 1 / len(x), np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    vw, vb, lw, lb = w.copy(), 0.0, w, b
    step = 1.0 / (0.25 * (1 + float((row @ (x * x)).sum())) + l2)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30)))
        error = row * (p - target)
        nw, nb = vw - step * (x.T @ error + l2 * vw), vb - step * error.sum()
        momentum = t / (t + 3)
        vw, vb = nw + momentum * (nw - lw), nb + momentum * (nb - lb)
        lw, lb = nw, nb
    return lw.astype(np.float64), float(lb)


@dataclass
class Model:
    """Linear classifier over feature hashes (ascending)."""

    bias: float
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def logits(self, texts: pa.Array, hasher: SpanHash) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        if len(self.features):
            f = Features(texts, hasher, self.features)
            out += np.bincount(f.doc, self.weights[f.slot], len(texts))
        return out


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    rows = materialize(training_rows(docs, labels, max_rows), "toxicity-sample")
    totals = {0: 0, 1: 0} | {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not totals[0] or not totals[1]:
        share = totals[1] / max(1, totals[0] + totals[1])
        return Model(float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    features = leaning_features(rows, totals)
    marks, present, patterns = feature_bits(rows, features)
    toxic = marks == 1
    weights, bias = logistic(present, posteriors(present, patterns, toxic))
    order = np.argsort(features)
    return Model(bias, features[order], weights[order])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, held_out, score, predicted."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash(5)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                p = 1 / (1 + np.exp(-np.clip(model.logits(part.column("text"), hasher), -500, 500)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (
        slim.mapInArrow(emit, "doc_id long, score double")
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the model predicts to be toxic; no shuffle, columns as they are, whatever their names."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash(5)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                yield part.filter(pa.array(model.logits(part.column("text"), hasher) < 0))

    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest")
    two = docs.select(F.col(f"`{text_col}`").alias("text"), others)
    kept = two.mapInArrow(emit, two.schema)
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns])
