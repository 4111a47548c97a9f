"""Null-safe, cardinality-checked lookup joins.

``lookup_join`` gives the three semantics the gold rules rely on:

* null keys match null keys (``<=>``), which Spark still plans as a hash or
  sort-merge equi-join;
* a ``validate`` contract: a side that must be unique is checked before the
  join and a duplicate key raises;
* same-named non-key columns get suffixes on both sides.

Strategy. The check of the "one" side is a single aggregation that also
measures that side (rows and bytes). The side is broadcast only when that
measured size is under ``finlake.broadcast.maxBytes``; then the big side is
never shuffled, so a key holding a third of its rows costs nothing extra.

A larger side is first cut to the keys that the big side holds (semi-join
reduction, ``finlake.lookup.reduce``, on by default): the big side's distinct keys
are written once, from its key columns alone; if so many rows of average width would
fit, the dimension's rows with these keys are written, measured, and broadcast if
they do fit. That takes a pass over the key columns instead of a shuffle of
whole facts.

Otherwise the join is a sort-merge join. Hot keys (the null key included) are
then handled in one of two ways, chosen by ``finlake.skew.mode``:

* ``aqe`` (default): AQE's skew-join handling splits an oversized shuffle
  partition of the big side into several tasks at run time, each joined with
  the (small) matching partition of the dimension. No extra pass.
* ``split``: keys holding at least ``finlake.skew.hotKeyRows`` rows are found
  first with a map-side-combined count, and their rows are joined by
  broadcast of their few dimension rows (at most ``finlake.skew.maxHotKeys``
  keys, unique by contract); the rest shuffles. This costs one extra pass over
  the big side, so it suits inputs that are cheap to re-read (a scan).

Either way no row is dropped.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.functions.columns import col
from finlake.session import scratch_path

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_HOT_KEY_ROWS = 2_000_000
DEFAULT_MAX_HOT_KEYS = 1_000

VALIDATIONS = {
    "one_to_one": (True, True),
    "1:1": (True, True),
    "one_to_many": (True, False),
    "1:m": (True, False),
    "many_to_one": (False, True),
    "m:1": (False, True),
    "many_to_many": (False, False),
    "m:m": (False, False),
    None: (False, False),
}


class MergeError(ValueError):
    """A side that must be unique on the join key is not."""


@dataclass(frozen=True)
class SideStats:
    rows: int
    keys: int
    max_per_key: int
    bytes: int


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    try:
        value = df.sparkSession.conf.get(key, None)
    except Exception:
        value = None
    return int(value) if value else default


_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


def _row_width(df: DataFrame) -> Column:
    """Approximate in-memory bytes of a row, computed per row: fixed widths
    for scalars, actual byte length for text, 64 for nested values."""
    fixed = 16
    texts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            texts.append("coalesce(octet_length(`" + f.name.replace("`", "``") + "`), 0) + 8")
        else:
            fixed += _FIXED_WIDTH.get(type(f.dataType), 64)
    return F.expr(" + ".join([f"cast({fixed} as bigint)"] + texts))


def _memo(df: DataFrame) -> dict:
    return df.__dict__.setdefault("_finlake_key_stats", {})


def _stats_plan(df: DataFrame, keys: list[str], tag: int) -> DataFrame:
    per_key = df.groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(_row_width(df)).alias("__w")
    )
    return per_key.agg(
        F.lit(tag).alias("tag"),
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("rows"),
        F.count(F.lit(1)).cast("long").alias("keys"),
        F.coalesce(F.max("__n"), F.lit(0)).cast("long").alias("mx"),
        F.coalesce(F.sum("__w"), F.lit(0)).cast("long").alias("bytes"),
    )


def prefetch_key_stats(items: list[tuple[DataFrame, list[str]]]) -> None:
    """Measure several (frame, keys) pairs in one job: the per-frame
    aggregates are unioned, so their stages run side by side."""
    todo = []
    for df, keys in items:
        ks = tuple(_as_list(keys))
        if ks not in _memo(df) and all(k in df.columns for k in ks):
            todo.append((df, ks))
    if not todo:
        return
    plans = [_stats_plan(df, list(ks), i) for i, (df, ks) in enumerate(todo)]
    rows = reduce(lambda a, b: a.unionByName(b), plans).collect()
    for r in rows:
        df, ks = todo[r["tag"]]
        _memo(df)[ks] = SideStats(r["rows"], r["keys"], r["mx"], r["bytes"])


def known_rows(df: DataFrame) -> int | None:
    """Row count of ``df`` if some earlier measurement already gave it."""
    for stats in _memo(df).values():
        return stats.rows
    return None


def key_stats(df: DataFrame, keys: list[str]) -> SideStats:
    """Rows, distinct keys, largest key group and approximate bytes of
    ``df`` grouped on ``keys`` (null is a key value like any other), in one
    job. Remembered on the DataFrame object, so a dimension used by many
    lookups is measured once."""
    ks = tuple(_as_list(keys))
    if ks not in _memo(df):
        prefetch_key_stats([(df, list(ks))])
    return _memo(df)[ks]


def duplicate_keys(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """Key values that occur more than once, with their row count ``n``.
    Null counts as a key value (it groups with other nulls)."""
    ks = _as_list(keys)
    return (
        df.groupBy(*[col(k) for k in ks])
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def assert_unique(df: DataFrame, keys: str | list[str], side: str = "right", sample: int = 5) -> None:
    """Raise MergeError with sample keys if ``keys`` is not unique in ``df``."""
    ks = _as_list(keys)
    known = _memo(df).get(tuple(ks))
    if known is not None and known.max_per_key <= 1:
        return
    dups = duplicate_keys(df, ks).limit(sample).collect()
    if dups:
        shown = ", ".join(str(tuple(r[k] for k in ks)) for r in dups)
        raise MergeError(f"{side} side is not unique on {ks}; duplicate keys include {shown}")


def _rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    if not mapping:
        return df
    # Other columns stay the attributes they are: the first branch of a union keeps every alias of its output,
    # and Spark would take its shuffles for others than those of an equal branch.
    return df.select(*[col(c).alias(mapping[c]) if c in mapping else col(c) for c in df.columns])


def _null_safe_cond(lkeys: list[str], rkeys: list[str]) -> Column:
    conds = [col(a).eqNullSafe(col(b)) for a, b in zip(lkeys, rkeys)]
    return reduce(lambda a, b: a & b, conds)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str] | None = None,
    *,
    left_on: str | list[str] | None = None,
    right_on: str | list[str] | None = None,
    how: str = "left",
    validate: str | None = "many_to_one",
    suffixes: tuple[str, str] = ("_x", "_y"),
    strategy: str = "auto",
) -> DataFrame:
    """Join ``right`` onto ``left`` with null-safe key equality.

    ``on`` keeps a single key column (the left one for inner/left joins);
    ``left_on``/``right_on`` keep both. Overlapping non-key columns get
    ``suffixes``. ``strategy``: "auto" (measured broadcast, else shuffle with
    hot-key split), "broadcast" (raises if the measured side is over the
    limit), or "shuffle".
    """
    how = {"left_outer": "left", "full": "outer", "full_outer": "outer"}.get(how, how)
    if how not in ("inner", "left", "right", "outer"):
        raise ValueError(f"unsupported join type {how!r}")
    if validate not in VALIDATIONS:
        raise ValueError(f"unknown validate={validate!r}")

    if on is not None:
        lkeys = rkeys = _as_list(on)
        shared = set(lkeys)
    else:
        lkeys, rkeys = _as_list(left_on), _as_list(right_on)
        if not lkeys or len(lkeys) != len(rkeys):
            raise ValueError("give `on`, or `left_on` and `right_on` of equal length")
        shared = set()
    for k in lkeys:
        if k not in left.columns:
            raise KeyError(f"left has no column {k!r}")
    for k in rkeys:
        if k not in right.columns:
            raise KeyError(f"right has no column {k!r}")

    # Suffix resolution (same names, excluding shared `on` keys).
    overlap = (set(left.columns) & set(right.columns)) - shared
    lmap = {c: c + suffixes[0] for c in overlap}
    rmap = {c: c + suffixes[1] for c in overlap}
    for c in overlap:
        if lmap[c] == rmap[c]:
            raise ValueError(f"suffixes {suffixes} leave column {c!r} ambiguous")
    # The right copy of a shared key gets a private name for the join.
    rtmp = {k: f"__rk{i}__{k}" for i, k in enumerate(rkeys)} if shared else {}
    left_r = _rename(left, lmap)
    right_r = _rename(right, {**rmap, **rtmp})
    lk = [lmap.get(k, k) for k in lkeys]
    rk = [rtmp.get(k, rmap.get(k, k)) for k in rkeys]

    left_unique, right_unique = VALIDATIONS[validate]
    if left_unique:
        # Measure both sides in one job when both need it.
        wanted = [(left, lkeys)] + ([(right, rkeys)] if (right_unique or strategy != "shuffle") else [])
        prefetch_key_stats(wanted)
        assert_unique(left, lkeys, side="left")

    rstats: SideStats | None = None
    if right_unique or strategy != "shuffle":
        rstats = key_stats(right, rkeys)
        if right_unique and rstats.max_per_key > 1:
            assert_unique(right, rkeys, side="right")

    cond = _null_safe_cond(lk, rk)
    max_bytes = _conf_int(left, "finlake.broadcast.maxBytes", DEFAULT_BROADCAST_BYTES)
    fits = rstats is not None and rstats.bytes <= max_bytes
    if strategy == "broadcast" and not fits:
        raise ValueError(f"the right side has {rstats.bytes} bytes; finlake.broadcast.maxBytes is {max_bytes}")
    use_broadcast = fits and (strategy == "broadcast" or (strategy == "auto" and how in ("inner", "left")))

    split = (left.sparkSession.conf.get("finlake.skew.mode", "aqe") or "aqe") == "split"
    reduced = None
    if strategy == "auto" and not use_broadcast and right_unique and how in ("inner", "left") and max_bytes > 0:
        if (left.sparkSession.conf.get("finlake.lookup.reduce", "true") or "true") == "true":
            reduced = _reduced_side(left_r, right_r, lk, rk, rstats, max_bytes)
    if use_broadcast:
        joined = left_r.join(F.broadcast(right_r), cond, how)
    elif reduced is not None:
        joined = left_r.join(F.broadcast(reduced), cond, how)
    elif strategy == "auto" and split and how in ("inner", "left") and right_unique:
        joined = _skew_split_join(left_r, right_r.hint("merge"), lk, rk, cond, how)
    else:
        # Measured too large to broadcast (or not measured): a sort-merge
        # join, which spills instead of failing.
        joined = left_r.join(right_r.hint("merge"), cond, how)

    # Output columns: left (suffixed), then right without the shared keys.
    out: list[Column] = []
    for c in left_r.columns:
        if shared and c in lk and how in ("right", "outer"):
            out.append(F.coalesce(col(c), col(rtmp[c])).alias(c))
        else:
            out.append(col(c))
    for c in right_r.columns:
        if c in rtmp.values():
            continue
        out.append(col(c))
    return joined.select(*out)


def _written(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``df`` written to the shared scratch folder and read back, with what was measured on the way."""
    seen, path = Observation(), scratch_path(df.sparkSession, name) + "/rows"
    df.observe(seen, *[m.alias(n) for n, m in measures.items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def _reduced_side(
    left: DataFrame, right: DataFrame, lk: list[str], rk: list[str], stats: SideStats, max_bytes: int
) -> DataFrame | None:
    """The rows of ``right`` (unique on ``rk``) whose keys occur in ``left``, or None if they do not fit ``max_bytes``."""
    names = [f"__lk{i}" for i in range(len(lk))]
    distinct = left.select(*[col(k).alias(n) for k, n in zip(lk, names)]).distinct()
    keys, found = _written(distinct, "lookup-keys", rows=F.count(F.lit(1)))
    if found["rows"] * stats.bytes > max_bytes * max(stats.rows, 1):
        return None
    # a key is no wider than the row it belongs to, so the keys fit as well
    held = right.join(F.broadcast(keys), _null_safe_cond(rk, names), "left_semi")
    rows, found = _written(held, "lookup-reduced", bytes=F.coalesce(F.sum(_row_width(right)), F.lit(0)))
    return rows if found["bytes"] <= max_bytes else None


def _skew_split_join(
    left: DataFrame, right: DataFrame, lk: list[str], rk: list[str], cond: Column, how: str
) -> DataFrame:
    """Shuffle join where each hot left key (null included) is served from a
    broadcast of its single matching dimension row instead of one reducer."""
    hot_rows = _conf_int(left, "finlake.skew.hotKeyRows", DEFAULT_HOT_KEY_ROWS)
    max_hot = _conf_int(left, "finlake.skew.maxHotKeys", DEFAULT_MAX_HOT_KEYS)
    hot = (
        left.groupBy(*[col(k) for k in lk])
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") >= hot_rows)
        .orderBy(F.desc("__n"))
        .limit(max_hot)
        .collect()
    )
    if not hot:
        return left.join(right, cond, how)
    # Keys past max_hot stay in the shuffle path (exact; AQE splits them).
    # The hot keys are a small table (<= max_hot rows): membership tests are
    # null-safe semi/anti joins against its broadcast, not literal lists.
    key_schema = T.StructType([T.StructField(f"__hk{i}", left.schema[k].dataType) for i, k in enumerate(lk)])
    hot_keys = F.broadcast(left.sparkSession.createDataFrame([tuple(r[k] for k in lk) for r in hot], key_schema))
    on_left = _null_safe_cond(lk, [f"__hk{i}" for i in range(len(lk))])
    on_right = _null_safe_cond(rk, [f"__hk{i}" for i in range(len(rk))])
    hot_dim = right.join(hot_keys, on_right, "left_semi")  # <= max_hot rows: right is unique per key
    hot_part = left.join(hot_keys, on_left, "left_semi").join(F.broadcast(hot_dim), cond, how)
    rest = left.join(hot_keys, on_left, "left_anti").join(right.join(hot_keys, on_right, "left_anti"), cond, how)
    return hot_part.unionByName(rest)
