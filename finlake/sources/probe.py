"""What a file is before Spark parses it.

For CSV: its first record, which names the columns, whether a quoted field holds a
line break (``\\n``, ``\\r`` or both), and whether a quote is left open at the end
(rows would be swallowed, so the file is rejected). A quote opens a field only at
the field's start; elsewhere it is text.

The first record comes from the file's head, whatever its line ends. The quotes
are looked at by all tasks at once: Spark reads the files as lines, split like any
text, and only lines that hold a quote are considered. As a task cannot know
whether its piece of a file begins inside a quoted field, it reports for both cases
the state at its end and whether a line ended inside quotes; the pieces of a file
are then put one after the other. A file of any size needs little memory.

For Parquet: the schema in the footer.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.sources.store import for_each, head, literal, norm, parquet_schema, part_files, readable

# Task code travels with the job: executors need not import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE, COMMA = 0x22, 0x2C
_BEFORE_FIELD = frozenset(b",\n\r")
_MARK = re.compile(rb'["\r\n]')
#: Bytes of a file's head read at first, and at most, to find its first record.
HEAD_BYTES, MAX_HEAD = 1 << 16, 16 << 20


def state_after(line: bytes, quoted: bool) -> bool:
    """Whether a field is still quoted after ``line``, given whether one was before it."""
    at = 0
    while (i := line.find(b'"', at)) >= 0:
        at = i + 1
        if not quoted:
            quoted = i == 0 or line[i - 1] in _BEFORE_FIELD
        elif line[i + 1 : i + 2] == b'"':
            at = i + 2
        else:
            quoted = False
    return quoted


def cut_records(text: bytes, quoted: bool) -> tuple[list[bytes], bytes, bool]:
    """(records ended in ``text``, what follows the last one, whether it is inside quotes).
    A record ends at any ``\\r`` or ``\\n`` outside quotes, so ``\\r\\n`` leaves an empty one, which is no record."""
    ended, start, skip = [], 0, -1
    for mark in _MARK.finditer(text):
        i = mark.start()
        if i == skip:
            continue
        if text[i] != QUOTE:
            if not quoted:
                ended.append(text[start:i])
                start = i + 1
        elif not quoted:
            quoted = i == start or text[i - 1] == COMMA
        elif text[i + 1 : i + 2] == b'"':
            skip = i + 1
        else:
            quoted = False
    return ended, text[start:], quoted


def first_record(data: bytes, whole: bool) -> bytes | None:
    """The first record that is not blank, or None if ``data`` (the whole file or its head) does not hold it all."""
    ended, rest, quoted = cut_records(data, False)
    for record in [*ended, rest] if whole and not quoted else ended:
        if record.strip():
            return record
    return None


def line_end(data: bytes, record: bytes | None) -> str:
    """The character that ends lines, as after the first record: ``\\r`` if it stands alone, else ``\\n``."""
    after = data[data.find(record) + len(record) :][:2] if record else b""
    return "\r" if after[:1] == b"\r" and after != b"\r\n" else "\n"


def csv_head(spark: SparkSession, path: str) -> dict:
    """{'record': bytes or None, 'empty': bool, 'line_end': str} from the start of a file."""
    size = HEAD_BYTES
    while True:
        data = head(spark, path, size)
        whole = len(data) < size
        record = first_record(data, whole)
        if record is not None or whole or size >= MAX_HEAD:
            return {"record": record, "empty": whole and not data.strip(), "line_end": line_end(data, record)}
        size = min(MAX_HEAD, size * 16)


# --- lines of files, in pieces -----------------------------------------------------


def raw_lines(spark: SparkSession, paths: list[str], sep: str | None = None) -> DataFrame:
    """(path, block, line): the lines of files as bytes, with the start of the piece they were
    read in. ``sep`` is the only line end; without it ``\\n``, ``\\r`` and ``\\r\\n`` all are."""
    reader = spark.read
    if sep is not None:
        reader = reader.option("lineSep", sep)
    path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    return reader.text(readable(spark, paths)).select(
        path.alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line")
    )


PIECES = "path string, block long, end_out boolean, end_in boolean, broken_out boolean, broken_in boolean"


def piece_states(lines: DataFrame) -> DataFrame:
    """Per piece of a file, if it begins outside (``_out``) or inside (``_in``) a quoted field: the
    state at its end and whether a line ended inside quotes. ``lines`` may leave out lines without a quote."""

    def emit(batches: Iterator) -> Iterator:
        import pandas as pd

        names = [c.split()[0] for c in PIECES.split(", ")]
        now, out, inside, broken_out, broken_in = None, False, True, False, False
        for batch in batches:
            rows = []
            for key, line in zip(zip(batch["path"], batch["block"]), batch["line"]):
                if key != now:
                    if now:
                        rows.append((*now, out, inside, broken_out, broken_in))
                    now, out, inside, broken_out, broken_in = key, False, True, False, False
                out, inside = state_after(line, out), state_after(line, inside)
                broken_out, broken_in = broken_out or out, broken_in or inside
            yield pd.DataFrame(rows, columns=names)
        if now:
            yield pd.DataFrame([(*now, out, inside, broken_out, broken_in)], columns=names)

    return lines.mapInPandas(emit, PIECES)


def quote_facts(spark: SparkSession, paths: list[str]) -> dict[str, tuple[bool, bool]]:
    """norm(path) -> (a quoted field holds a line break, a quote is left open), of files that hold a quote."""
    lines = raw_lines(spark, paths).filter(F.col("line").contains(F.lit(b'"')))
    pieces = F.array_sort(F.collect_list(F.struct("block", "end_out", "end_in", "broken_out", "broken_in")))
    start = F.struct(F.lit(False).alias("inside"), F.lit(False).alias("broken"))

    def one_more(seen, p):
        inside = seen["inside"]
        return F.struct(
            F.when(inside, p["end_in"]).otherwise(p["end_out"]).alias("inside"),
            (seen["broken"] | F.when(inside, p["broken_in"]).otherwise(p["broken_out"])).alias("broken"),
        )

    files = piece_states(lines).groupBy("path").agg(pieces.alias("pieces"))
    found = files.select("path", F.aggregate("pieces", start, one_more).alias("f"))
    return {norm(r["path"]): (r["f"]["broken"], r["f"]["inside"]) for r in found.collect()}  # one row per file


def csv_facts(spark: SparkSession, paths: list[str], encoding: str) -> dict[str, dict]:
    """Facts of a bounded list of paths: header (text or None), empty, quoted_newline, unclosed, line_end,
    mixed (the part files of a folder are not alike)."""
    if not paths:
        return {}
    parts = for_each(paths, lambda p: part_files(spark, p))
    heads = for_each([f for p in paths for f in parts[p]], lambda p: csv_head(spark, p))
    filled = {p: [f for f in parts[p] if not heads[f]["empty"]] for p in paths}
    some = [p for p in paths if filled[p]]
    quotes = quote_facts(spark, some) if some else {}
    out = {}
    for p in paths:
        alike = {(heads[f]["record"], heads[f]["line_end"]) for f in filled[p]}
        record, end = min(alike, key=str) if alike else (None, "\n")
        found = [quotes.get(norm(f), (False, False)) for f in filled[p]]
        out[p] = {
            "header": None if record is None else record.decode(encoding, "replace"),
            "empty": not filled[p],
            "quoted_newline": any(broken for broken, _ in found),
            "unclosed": any(unclosed for _, unclosed in found),
            "line_end": end,
            "mixed": len(alike) > 1,
        }
    return out


def parquet_facts(spark: SparkSession, paths: Iterable[str]) -> dict[str, tuple[str | None, str | None]]:
    """path -> (schema text, problem), from the footers."""


    def one(path: str) -> tuple[str | None, str | None]:
        found = {parquet_schema(spark, f) for f in part_files(spark, path)}
        problems = sorted(problem for _, problem in found if problem)
        if problems or len(found) != 1:
            return None, problems[0] if problems else "the part files differ in schema"
        return found.pop()

    return for_each(paths, one)
