"""Hard negatives by an inverted multi-index.

Index. A vector is cut into two halves; each half space has a codebook, fitted on
a bounded sample (about ``SAMPLE`` vectors, chosen by a hash), and the pair of
nearest codewords is a vector's cell. All vectors are indexed, not only the
sample: they lie as packed blocks of at most about ``BLOCK`` vectors, by cell. For
each codeword the radius (largest distance of a member) is kept.

Search. The inner product of a query with any member of a cell is at most the sum
of two half bounds, ``q . codeword + |q| * radius``. Both lists of half bounds are
sorted, and a heap visits the cells in order of their sums (the multi-sequence
algorithm). Queries go round by round: in each they visit cells worth a budget of
vectors, which grows ``GROWTH`` times a round; visits meet the blocks in a join on
(cell, block) and a matrix product. A window (a range of scores) of a query is
certified when it holds its ``k`` best and the next cell's bound is below the last
of them, or when that bound is below the whole window, or no cell is left. A query
stops when all its windows are certified, so results are exact.

Mining. One search finds each anchor's positives: same label, one window without
ends. A second one finds the negatives: other labels, a window from ``low`` to
``high`` percent of the score of each positive.

Vectors are integers, ``floor(SCALE * x)``, so scores are exact; only bounds are
floating point, with a margin. The driver holds the codebooks, their radii and the
sizes of cells (at most ``MAX_CODES`` squared).

Defined cases: rows without id, label or vector, with a null or non-finite
component, or of another length than most, take no part; a zero vector does; a
component beyond 2**26 after scaling is an error (scores would not be exact); equal
rows count once; rows that share an id but not label or vector are candidates each,
but no row meets its own id, and such an anchor uses its smallest label and
vector; ties go to the smaller id; a negative positive-score leaves no window;
other columns are ignored; empty in, empty out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import materialize

SCALE = 256
#: Vectors that the codebooks are fitted on, about (all, if there are fewer).
SAMPLE = 20_000
ROUNDS = 8
#: Codewords of a half space: cells hold about CELL vectors until there are MAX_CODES codewords.
CELL, MAX_CODES = 512, 256
BLOCK = 4096
#: Queries packed into one visit of a block, about.
PART = 1024
#: Vectors that a query visits in its first round, and how that grows.
BUDGET, GROWTH = 8192, 8
#: Rows of visits yielded at a time.
VISITS = 16_384
LIMIT = 1 << 26
FAR = 1 << 62


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """Distinct (vec_id, label, v as array<long>) of the rows that take part."""
    x = F.col("x")
    three = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("x")
    )
    sound = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c))
    whole = F.transform(x, lambda c: F.floor(c * SCALE))
    fits = F.forall(x, lambda c: F.abs(c) * SCALE < LIMIT)
    checked = F.when(fits, F.transform(whole, lambda c: c.cast("long"))).otherwise(
        F.raise_error(F.concat(F.lit("a component of this vector is too large: vec_id "), F.col("vec_id").cast("string")))
    )
    # each condition needs the ones before it
    return (
        three.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.when(x.isNotNull(), sound).otherwise(False))
        .select("vec_id", "label", checked.alias("v"))
        .distinct()
    )


# --- codebooks -----------------------------------------------------------------


def fit_codebook(points: np.ndarray, n: int, rounds: int = ROUNDS) -> np.ndarray:
    """``n`` codewords by Lloyd's rounds from a fixed random start."""
    rng = np.random.default_rng(12_345)
    words = points[np.sort(rng.choice(len(points), n, replace=False))].astype(np.float64)
    for _ in range(rounds):
        code = nearest_code(points, words)[0]
        size = np.bincount(code, minlength=n)
        sums = np.stack([np.bincount(code, weights=points[:, d], minlength=n) for d in range(points.shape[1])], axis=1)
        words = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], words)
    return words


def nearest_code(points: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, distance to its codeword) of each point."""
    squared = (words * words).sum(axis=1) - 2 * points @ words.T
    code = squared.argmin(axis=1)
    away = points - words[code]
    return code, np.sqrt((away * away).sum(axis=1))


class Index:
    """What every task knows of the index: codebooks, radii and blocks per cell."""

    def __init__(self, words: list[np.ndarray], radii: list[np.ndarray], sizes: np.ndarray, blocks: np.ndarray):
        self.words, self.radii, self.sizes, self.blocks = words, radii, sizes, blocks
        self.cut = words[0].shape[1]

    def half_bounds(self, query: np.ndarray) -> list[np.ndarray]:
        out = []
        for h, part in enumerate((query[: self.cut], query[self.cut :])):
            norm = float(np.sqrt(part @ part))
            out.append(self.words[h] @ part + norm * self.radii[h])
        return out

    def visit(self, query: np.ndarray, skip: int, budget: int) -> tuple[list[int], int, float]:
        """(non-empty cells, cells popped in all, bound of what is left): the heap's next cells, at
        least one and up to ``budget`` vectors, after the ``skip`` ones it has given before."""
        first, second = self.half_bounds(query)
        if not len(first) or not len(second):
            return [], skip, -np.inf
        a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        x, y = first[a], second[b]
        heap, popped, cells, left = [(-(x[0] + y[0]), 0, 0)], 0, [], budget
        while heap and left > 0:
            _, i, j = heapq.heappop(heap)
            if j + 1 < len(y):
                heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(x):
                heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))
            popped += 1
            if popped > skip:
                cell = int(a[i]) * len(y) + int(b[j])
                if self.sizes[cell]:
                    cells.append(cell)
                    left -= int(self.sizes[cell])
        bound = -heap[0][0] if heap else -np.inf
        # room for what floating point lost
        return cells, popped, bound + 1e-6 * (1 + abs(bound)) if heap else -np.inf


def _rows(column: pa.Array) -> np.ndarray:
    """Vectors of a list column as a matrix of 64-bit integers."""
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def build_index(vectors: DataFrame) -> tuple[Index, DataFrame] | None:
    """(Index, blocks): blocks are rows (cell, block, ids, labels, matrix) of packed 64-bit numbers. None without vectors."""
    spark = vectors.sparkSession
    n = vectors.count()
    if not n:
        return None
    share = F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(1 << 31)) < int(min(1.0, SAMPLE / n) * (1 << 31))
    sample = vectors.filter(share).select("vec_id", "v").toArrow()  # distinct rows, so about SAMPLE
    points = _rows(sample.column("v").combine_chunks()).astype(np.float64)
    points = points[np.lexsort((*points.T[::-1], np.asarray(sample.column("vec_id"))))]
    if not len(points):  # a tiny table that the hash missed
        points = _rows(vectors.select("v").limit(1).toArrow().column("v").combine_chunks()).astype(np.float64)
    dim = points.shape[1]
    codes = int(min(MAX_CODES, max(1, round((n / CELL) ** 0.5)), len(points)))
    cut = dim // 2 if dim > 1 else dim
    words = [fit_codebook(points[:, :cut], codes)]
    words.append(fit_codebook(points[:, cut:], codes) if cut < dim else np.zeros((1, 0)))
    second = len(words[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            v = _rows(batch.column("v")).astype(np.float64)
            code0, away0 = nearest_code(v[:, :cut], words[0])
            code1, away1 = nearest_code(v[:, cut:], words[1])
            columns = [*batch.columns, pa.array((code0 * second + code1).astype(np.int32)), pa.array(away0), pa.array(away1)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "v", "cell", "away0", "away1"])

    schema = "vec_id long, label long, v array<long>, cell int, away0 double, away1 double"
    assigned = materialize(vectors.mapInArrow(assign, schema), "negatives-cells")
    sizes, radii = np.zeros(codes * second, np.int64), [np.zeros(codes), np.zeros(second)]
    # one row per non-empty cell, at most MAX_CODES squared
    for r in assigned.groupBy("cell").agg(F.count(F.lit(1)), F.max("away0"), F.max("away1")).collect():
        cell, size, *away = r
        sizes[cell] = size
        for h, code in enumerate(divmod(cell, second)):
            # room for what floating point lost
            radii[h][code] = max(radii[h][code], away[h] * (1 + 1e-9) + 1e-9)
    index = Index(words, radii, sizes, -(-sizes // BLOCK))

    def pack(table: pa.Table) -> pa.Table:
        ids = np.asarray(table.column("vec_id"), dtype=np.int64)
        matrix = _rows(table.column("v").combine_chunks())
        return pa.table(
            {
                "cell": table.column("cell").slice(0, 1).cast(pa.int32()),
                "block": table.column("block").slice(0, 1).cast(pa.int32()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "labels": pa.array([np.asarray(table.column("label"), dtype=np.int64).tobytes()], pa.binary()),
                "matrix": pa.array([matrix.astype(np.int32).tobytes()], pa.binary()),
            }
        )

    counts = spark.createDataFrame([(int(c), int(index.blocks[c])) for c in np.flatnonzero(sizes)], "cell int, blocks int")
    dealt = assigned.join(F.broadcast(counts), "cell").select(
        "vec_id", "label", "v", "cell", F.pmod(F.xxhash64("vec_id", "label", "v"), F.col("blocks")).cast("int").alias("block")
    )
    packed = dealt.groupBy("cell", "block").applyInArrow(pack, "cell int, block int, ids binary, labels binary, matrix binary")
    return index, materialize(packed, "negatives-blocks")


# --- search ------------------------------------------------------------------------

SLOT = "slots array<struct<slot: int, low: long, high: long>>"
STATE = f"query_id long, label long, v array<long>, {SLOT}, popped int, bound double"


def plan_visits(state: DataFrame, index: Index, budget: int) -> DataFrame:
    """One row per query and cell of this round, after a row without cell that holds the query's new state."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            queries = _rows(batch.column("v")).astype(np.float64)
            owner, cell, popped, bound = [], [], [], []
            for i, query in enumerate(queries):
                cells, n, rest = index.visit(query, batch.column("popped")[i].as_py(), budget)
                owner += [i] * (1 + len(cells))
                cell += [None, *cells]
                popped += [n] * (1 + len(cells))
                bound += [rest] * (1 + len(cells))
                if len(owner) < VISITS and i + 1 < len(queries):
                    continue
                at = pa.array(owner)
                columns = [batch.column(c).take(at) for c in ("query_id", "label", "v", "slots")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(popped, pa.int32()), pa.array(bound, pa.float64()), pa.array(cell, pa.int32())],
                    ["query_id", "label", "v", "slots", "popped", "bound", "cell"],
                )
                owner, cell, popped, bound = [], [], [], []

    return state.mapInArrow(emit, f"{STATE}, cell int")


def best_in_window(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best scores, ties by smaller id."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def scored(visits: DataFrame, blocks: DataFrame, k: int, same: bool) -> DataFrame:
    """(query_id, slot, vec_id, score): the ``k`` best of each visited block in each window."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(len(batch)):
                ids, labels = (np.frombuffer(batch.column(c)[row].as_py(), np.int64) for c in ("ids", "labels"))
                matrix = np.frombuffer(batch.column("matrix")[row].as_py(), np.int32).reshape(len(ids), -1)
                queries = batch.column("queries")[row].values
                q = _rows(queries.field("v"))
                product = products(q, matrix)
                for i, (qid, label, slots) in enumerate(
                    zip(*(queries.field(c).to_pylist() for c in ("query_id", "label", "slots")))
                ):
                    use = np.flatnonzero(((labels == label) == same) & (ids != qid))
                    score = product[i, use]
                    for s in slots:
                        inside = use[(score >= s["low"]) & (score <= s["high"])]
                        if len(inside):
                            best = inside[best_in_window(product[i, inside], ids[inside], k)]
                            out.append((np.full(len(best), qid), np.full(len(best), s["slot"]), ids[best], product[i, best]))
            if out:
                qid, slot, vec, score = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qid), pa.array(slot.astype(np.int32)), pa.array(vec), pa.array(score)],
                    ["query_id", "slot", "vec_id", "score"],
                )

    joined = visits.join(blocks, ["cell", "block"]).select("ids", "labels", "matrix", "queries")
    return joined.mapInArrow(emit, "query_id long, slot int, vec_id long, score long")


def products(queries: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating point while every sum stays below 2**53."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(matrix).max(initial=0)) * matrix.shape[1]
    if most < 1 << 53:
        return (queries.astype(np.float64) @ matrix.astype(np.float64).T).astype(np.int64)
    return queries @ matrix.astype(np.int64).T


def search(queries: DataFrame, index: Index, blocks: DataFrame, k: int, same: bool) -> DataFrame:
    """(query_id, slot, rank, vec_id, score): the ``k`` best per query and window, certified."""
    spark = queries.sparkSession
    state = materialize(queries.select("query_id", "label", "v", "slots", F.lit(0).alias("popped"), F.lit(0.0).alias("bound")), "negatives-state")
    found = spark.createDataFrame([], "query_id long, slot int, vec_id long, score long, rank int")
    counts = spark.createDataFrame([(int(c), int(index.blocks[c])) for c in np.flatnonzero(index.sizes)], "cell int, blocks int")
    best = Window.partitionBy("query_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    budget = BUDGET
    while waiting := state.count():
        planned = materialize(plan_visits(state, index, budget), "negatives-visits")
        parts = max(1, -(-waiting // PART))
        asked = F.collect_list(F.struct("query_id", "label", "v", "slots")).alias("queries")
        visits = (
            planned.join(F.broadcast(counts), "cell")
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .groupBy("cell", "block", F.pmod(F.xxhash64("query_id"), F.lit(parts)).alias("part"))
            .agg(asked)
        )
        candidates = scored(visits, blocks, k, same).unionByName(found.drop("rank"))
        ranked = candidates.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        found = materialize(ranked, "negatives-found")
        full = found.filter(F.col("rank") == k).select("query_id", F.struct("slot", "score").alias("last"))
        full = full.groupBy("query_id").agg(F.map_from_entries(F.collect_list("last")).alias("last"))
        after = planned.filter("cell is null").drop("cell").join(full, "query_id", "left")
        bound = F.col("bound")

        def open_slot(s: Column) -> Column:
            last = F.coalesce(F.col("last"), F.create_map().cast("map<int,long>"))[s["slot"]]
            return (bound >= s["low"]) & (last.isNull() | (bound >= last))

        after = after.withColumn("slots", F.filter("slots", open_slot)).filter((F.size("slots") > 0) & (bound > float("-inf")))
        state = materialize(after.select("query_id", "label", "v", "slots", "popped", "bound"), "negatives-state")
        budget *= GROWTH
    return found


# --- mining ------------------------------------------------------------------------


def mine(
    vectors: DataFrame,
    anchors: str | Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: str | Column = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on vec_id; ``label`` a column or an expression over the input's columns."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, F.col(f"`{label}`") if isinstance(label, str) else label)
    rows = materialize(rows, "negatives-rows")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if most is None or not most["dim"]:
        return spark.createDataFrame([], result)
    rows = rows.filter(F.size("v") == most["dim"])
    index, blocks = build_index(rows)
    whole = F.array(F.struct(F.lit(0).alias("slot"), F.lit(-FAR).alias("low"), F.lit(FAR).alias("high")))
    asked = rows.filter(anchors).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("label", "v")).alias("s"))
    asked = asked.select("query_id", "s.label", "s.v", whole.alias("slots"))
    near = search(asked, index, blocks, positives, same=True)
    found = near.select("query_id", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # score * 100 between the two products, in whole numbers; a score below zero leaves no room
    window = F.struct(
        "slot",
        F.expr(f"({low} * positive_score + 99) div 100").alias("low"),
        F.expr(f"({high} * positive_score) div 100").alias("high"),
    )
    sound = found.filter("positive_score >= 0").groupBy("query_id").agg(F.collect_list(window).alias("slots"))
    others = search(asked.drop("slots").join(sound, "query_id"), index, blocks, negatives, same=False)
    return found.join(others, ["query_id", "slot"]).select(
        F.col("query_id").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
