"""Schema-level DataFrame helpers: renames, drops, unions, casts, reorders."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from finlake.functions.columns import col


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Exact-case bulk rename; names not in ``df`` are ignored. Two source
    columns landing on one target name raise."""
    targets: dict[str, str] = {}
    for c in df.columns:
        new = mapping.get(c, c)
        if new in targets:
            raise ValueError(f"columns {targets[new]!r} and {c!r} both become {new!r}")
        targets[new] = c
    return df.select(*[col(c).alias(mapping[c]) if c in mapping else col(c) for c in df.columns])


def drop_if_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    present = [c for c in names if c in df.columns]
    return df.drop(*present) if present else df


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from a frame is null there. A
    column that is text in one frame and not in another is text in all (the
    other way a code like 'A1' would have to become a number)."""
    types: dict[str, set[str]] = {}
    for df in frames:
        for f in df.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    as_text = {name for name, found in types.items() if len(found - {"void"}) > 1 and "string" in found}
    if as_text:
        frames = [
            df.select(*[col(c).cast("string").alias(c) if c in as_text else col(c) for c in df.columns]) for df in frames
        ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def cast_by_type(df: DataFrame, source: T.DataType | str, target: T.DataType | str) -> DataFrame:
    """Cast every column whose type equals ``source`` to ``target``."""
    if isinstance(source, str):
        source = T._parse_datatype_string(source)
    return df.select(
        *[col(f.name).cast(target).alias(f.name) if f.dataType == source else col(f.name) for f in df.schema.fields]
    )


def move_last(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[col(c) for c in df.columns if c != name], col(name))


def ordered_columns(df: DataFrame, prefix: list[str], contains: str | None = None) -> DataFrame:
    """``prefix`` columns, then every column whose name contains ``contains``."""
    extra = [c for c in df.columns if contains and contains in c and c not in prefix]
    return df.select(*[col(c) for c in prefix + extra])
