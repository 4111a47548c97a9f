"""Ordered fill-down (last non-null value at or above each row).

Spark rows carry no order, so the order is an explicit column. A plain
``last(ignorenulls)`` window over the whole frame runs in one task; that is
only done when the frame has at most ``bucket_rows`` rows. Larger frames are
cut into buckets of consecutive ordinals (each bucket at most ``bucket_rows``
rows, because ordinals are distinct integers):

1. window inside each bucket (partitioned by bucket -> parallel);
2. per bucket, its last non-null value (``max_by`` over the ordinal);
3. the carry into each bucket = fill-down over the bucket summaries,
   exclusive of the bucket itself, computed by the same rule recursively;
4. join the carry back on the bucket id and take the in-bucket value first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.functions.columns import col
from finlake.session import ensure_checkpoint_dir

DEFAULT_BUCKET_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def with_ordinal(df: DataFrame, order_by: list[str | Column], name: str = "__ord") -> DataFrame:
    """Distinct long ordinal increasing in ``order_by`` order, computed with a
    range-partitioned sort (no single task). The result is checkpointed so a
    recomputation after executor loss cannot renumber rows."""
    cols = [col(c) if isinstance(c, str) else c for c in order_by]
    ordered = df.orderBy(*cols).withColumn(name, F.monotonically_increasing_id())
    ensure_checkpoint_dir(df.sparkSession)
    return ordered.checkpoint(eager=True)


def with_row_number(df: DataFrame, order_by: list[str | Column], name: str) -> DataFrame:
    """Consecutive row numbers from 1 in ``order_by`` order, without a window over all rows.

    An ordinal holds its partition and the place in it; the rows of the partitions
    before are added, from one count per partition of the sort (a frame that grows
    with the number of partitions, not of rows). Ties get different numbers."""
    numbered = with_ordinal(df, order_by, "__place")
    part = F.shiftright("__place", 33)
    inside = col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = numbered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(col("__part"), F.coalesce(before, F.lit(0)).alias("__before"))
    joined = numbered.withColumn("__part", part).join(F.broadcast(starts), "__part")
    rest = [col(c) for c in df.columns if c != name]
    return joined.select(*rest, (col("__before") + inside + 1).alias(name))


def fill_down(
    df: DataFrame,
    ordinal: str,
    values: dict[str, Column],
    bucket_rows: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Add (or replace) one column per ``values`` entry holding the last
    non-null value of its expression over rows with ordinal <= this row's.

    ``ordinal`` must name a distinct, non-null integral column. ``rows``, when
    already known, saves counting the frame."""
    if bucket_rows is None:
        conf = df.sparkSession.conf.get("finlake.filldown.bucketRows", None)
        bucket_rows = int(conf) if conf else DEFAULT_BUCKET_ROWS
    tmp = {name: f"__fv{i}" for i, name in enumerate(values)}
    staged = df.select("*", *[expr.alias(tmp[n]) for n, expr in values.items()])
    filled = _fill(staged, ordinal, list(tmp.values()), exclusive=False, bucket_rows=bucket_rows, level=0, rows=rows)
    replaced = [col(c) if c not in values else col(tmp[c]).alias(c) for c in df.columns]
    new = [col(tmp[n]).alias(n) for n in values if n not in df.columns]
    return filled.select(*replaced, *new)


def _fill(
    df: DataFrame,
    ordinal: str,
    vcols: list[str],
    exclusive: bool,
    bucket_rows: int,
    level: int,
    rows: int | None = None,
) -> DataFrame:
    end = -1 if exclusive else Window.currentRow
    others = [c for c in df.columns if c not in vcols]
    n = df.count() if rows is None else rows
    if n <= bucket_rows:
        w = Window.orderBy(col(ordinal)).rowsBetween(Window.unboundedPreceding, end)
        return df.select(*[col(c) for c in others], *[F.last(col(v), ignorenulls=True).over(w).alias(v) for v in vcols])

    bucket = f"__b{level}"
    d = df.withColumn(bucket, F.floor(col(ordinal) / F.lit(bucket_rows)).cast("long"))
    w = Window.partitionBy(bucket).orderBy(col(ordinal)).rowsBetween(Window.unboundedPreceding, end)
    in_bucket = d.select(
        *[col(c) for c in others],
        F.col(bucket),
        *[F.last(col(v), ignorenulls=True).over(w).alias(v) for v in vcols],
    )
    summary = d.groupBy(bucket).agg(
        *[F.max_by(col(v), F.when(col(v).isNotNull(), col(ordinal))).alias(v) for v in vcols]
    )
    measured = summary.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.lit(16) + sum((F.coalesce(F.octet_length(col(v).cast("string")), F.lit(0)) + 8 for v in vcols), F.lit(0))).alias("bytes"),
    ).first()
    n_buckets = measured["n"]
    carry = _fill(summary, bucket, vcols, True, bucket_rows, level + 1, rows=n_buckets)
    carry = carry.select(F.col(bucket), *[col(v).alias(v + "__carry") for v in vcols])
    # Broadcast the carry only when its measured size is within the limit.
    limit = df.sparkSession.conf.get("finlake.broadcast.maxBytes", None)
    if (measured["bytes"] or 0) <= int(limit or DEFAULT_BROADCAST_BYTES):
        carry = F.broadcast(carry)
    joined = in_bucket.join(carry, bucket, "left")
    return joined.select(
        *[col(c) for c in others],
        *[F.coalesce(col(v), col(v + "__carry")).alias(v) for v in vcols],
    )


def fill_down_exact(df: DataFrame, ordinal: str, values: dict[str, Column]) -> DataFrame:
    """Reference form: one unpartitioned window (one task). For tests."""
    w = Window.orderBy(col(ordinal)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df
    for name, expr in values.items():
        out = out.withColumn(name, F.last(expr, ignorenulls=True).over(w))
    return out
