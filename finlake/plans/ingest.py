"""Batch import (G4): new files -> routed feeds -> typed frames -> bronze.

Each file lands at most once. Files are grouped, never looped over one by
one: one listing job, one ledger anti-join, one probe of the files' bytes, and
one write and check per (feed, header) group. A batch holds at
most ``BATCH_NAMES`` base names, so a run of any size keeps a bounded list of
paths in the driver.

Write protocol (see ``sources.ledger``): typed rows are written to bronze once, as an
attempt of their own, by month, each with why it is bad (a column that no reader
takes); only if some are, files with bad rows are found there, the rows of the good
files are written as another attempt and the first is removed. Then the ledger
entry, the only commit, makes them visible. A crash before it leaves rows that no
reader sees (``vacuum`` removes them), and the next run writes another attempt.
Feeds are imported side by side.

A file that cannot be loaded (an open quote, a value that does not parse to its
type, a date that is not month/day/year, a period month outside 1..12, other
columns than its feed, a value the feed's type cannot hold) is quarantined with
its reason; the other files still load, and if another file of the same name
exists, the next path is tried. Anything else, such as a storage or cluster
fault, is raised, so the run (or the stream's batch) fails and can be repeated.
"""

from __future__ import annotations

import logging
import os
import time
import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.functions.columns import col, month_start, parse_date, period_digits
from finlake.plans.warehouse import ATTEMPT, MONTH, Warehouse
from finlake.session import COMPILED_CODE, conf_override, scratch_path
from finlake.sources.csv import VISIBLE, Rejected, cast_value, first_reason, group_by_header, read_csv_group, read_parquet_files
from finlake.sources.files import is_hidden, list_files, rank_per_name, visible_copies, with_feed
from finlake.sources.ledger import merge_commits, new_files, read_ledger, record
from finlake.sources.probe import parquet_facts
from finlake.sources.store import child_folders, remove

log = logging.getLogger(__name__)

BATCH_NAMES = 10_000


@dataclass
class ImportReport:
    """Base names per feed, what was rejected and why, and rows per feed as the writes counted them."""

    ingested: dict[str, list[str]] = field(default_factory=lambda: defaultdict(list))
    rejected: list[Rejected] = field(default_factory=list)
    duplicates: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=lambda: defaultdict(int))

    @property
    def ingested_count(self) -> int:
        return sum(len(v) for v in self.ingested.values())


def with_partition_date(df: DataFrame) -> tuple[DataFrame, Column]:
    """First rule that applies.

    * ``Period`` present -> (Fiscal Year, Period);
    * ``Fiscal Period`` present -> (Fiscal Year, Fiscal Period);
    * ``Last Refresh`` present -> Fiscal Period = digits of PERIOD (0 when
      none), date only for a non-zero month;
    * otherwise no PartitionDate.

    Returns the frame and a per-row flag for dates that cannot be built (a
    null or out-of-range month, a null year)."""
    cols = df.columns
    if "Period" in cols or "Fiscal Period" in cols:
        month = "Period" if "Period" in cols else "Fiscal Period"
        if "Fiscal Year" not in cols:
            raise ValueError(f"column {month!r} needs 'Fiscal Year'")
        pdate = month_start(col("Fiscal Year"), col(month), strict=False)
        return df.withColumn("PartitionDate", pdate), col("PartitionDate").isNull()
    if "Last Refresh" in cols:
        fp = period_digits("PERIOD")
        out = df.withColumn("Fiscal Period", fp)
        pdate = F.when(col("Fiscal Period") != 0, month_start(col("YEAR"), col("Fiscal Period"), strict=False))
        out = out.withColumn("PartitionDate", pdate)
        return out, (col("Fiscal Period") != 0) & col("PartitionDate").isNull()
    return df, F.lit(False)


def with_date_columns(df: DataFrame, names: list[str]) -> tuple[DataFrame, list[tuple[str, Column, Column]]]:
    """Every column with 'date' in its name (of ``names``) parsed as
    month/day/year; text that does not parse flags its row. Returns the frame
    (texts kept as ``__txt_*``) and the checks."""
    checks = []
    out = df
    for f in df.schema.fields:
        if f.name not in names or "date" not in f.name.lower():
            continue
        if f.dataType.typeName() == "string":
            out = out.withColumn(f"__txt_{f.name}", col(f.name))
            out = out.withColumn(f.name, parse_date(f.name, strict=False))
            checks.append((f.name, col(f"__txt_{f.name}").isNotNull() & col(f.name).isNull(), col(f"__txt_{f.name}")))
        else:
            out = out.withColumn(f.name, col(f.name).cast("timestamp_ntz"))
    return out, checks


def _base(path: str) -> str:
    return os.path.basename(path.rstrip("/"))


def typed_rows(df: DataFrame) -> DataFrame:
    """G5 and C9 on one (feed, header) group; ``__bad`` says why a row is bad."""
    names = [c for c in df.columns if c not in ("source_file", "__bad")]
    staged, bad_period = with_partition_date(df)
    staged, checks = with_date_columns(staged, names)
    period = F.when(bad_period, F.lit("no month can be built from the period columns"))
    staged = staged.withColumn("__bad", F.coalesce(col("__bad"), first_reason(checks), period))
    return staged.drop(*[c for c in staged.columns if c.startswith("__txt_")])


def as_feed(staged: DataFrame, schema) -> DataFrame:
    """Columns in the feed's order and types; a value its type cannot hold is bad."""
    have = {f.name: f.dataType for f in staged.schema.fields}
    cols, checks = [], []
    for f in schema.fields:
        if have[f.name] == f.dataType:
            cols.append(col(f.name))
            continue
        typed, bad = cast_value(f.name, have[f.name], f.dataType)
        cols.append(typed.alias(f.name))
        checks.append((f.name, bad, col(f.name)))
    return staged.select(*cols, F.coalesce(col("__bad"), first_reason(checks)).alias("__bad"))


@dataclass
class Published:
    """One (feed, header) group: path -> reason of the rejected files, and what was written but not yet committed."""

    rejected: dict[str, str]
    attempt: str | None = None
    names: list[str] = field(default_factory=list)
    rows: int = 0


def publish_group(spark: SparkSession, wh: Warehouse, feed: str, df: DataFrame, paths: list[str], work: str) -> Published:
    """Write one (feed, header) group as a new attempt, without the files that hold bad rows."""
    try:
        staged = typed_rows(df)
    except ValueError as exc:  # the columns contradict a rule
        return Published({p: str(exc) for p in paths})
    schema = wh.feed_schema(spark, feed)
    if schema is None:
        wanted = staged.drop("__bad").schema
    elif set(schema.fieldNames()) != set(staged.columns) - {"__bad"}:
        return Published({p: f"columns differ from feed table {feed}" for p in paths})
    else:
        wanted = schema
        staged = as_feed(staged, schema)
    month = F.date_format(col("PartitionDate"), "yyyy-MM") if "PartitionDate" in wanted.names else F.lit(None).cast("string")

    def write(rows: DataFrame) -> tuple[str, str, dict]:
        """(attempt, its folder, counts): no shuffle, a file's rows stay in the task(s) that read it."""
        attempt, seen = uuid.uuid4().hex, Observation()
        folder = f"{wh.feed_path(feed)}/{ATTEMPT}={attempt}"
        rows = rows.select(*[col(f.name) for f in wanted.fields], "__bad", month.alias(MONTH))
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(col("__bad")).alias("bad"))
        counted.write.partitionBy(MONTH).parquet(folder)
        return attempt, folder, seen.get

    attempt, folder, counts = write(staged)
    reasons = {}
    if counts["bad"]:
        found = spark.read.schema(T.StructType([*wanted.fields, T.StructField("__bad", T.StringType())])).parquet(folder)
        # at most one row per file of the batch
        bad = found.filter(col("__bad").isNotNull()).groupBy("source_file").agg(F.min("__bad").alias("reason"))
        reasons = {r["source_file"]: r["reason"] for r in bad.collect()}
    rejected = {p: reasons[_base(p)] for p in paths if _base(p) in reasons}
    good_names = sorted({_base(p) for p in paths} - set(reasons))
    if reasons:
        if good_names:
            attempt, _, counts = write(found.join(F.broadcast(bad.select("source_file")), "source_file", "left_anti"))
        remove(spark, folder)
    if not good_names:
        return Published(rejected)
    if schema is None:
        wh.set_feed_schema(spark, feed, wanted)
    return Published(rejected, attempt, good_names, counts["rows"])


def ingest_group(
    spark: SparkSession, wh: Warehouse, feed: str, df: DataFrame, paths: list[str], work: str, report: ImportReport
) -> dict[str, str]:
    """Publish and commit one (feed, header) group; returns path -> reason of the rejected ones."""
    found = publish_group(spark, wh, feed, df, paths, work)
    if found.names:
        names = spark.createDataFrame([(n,) for n in found.names], "file_name string")
        record(spark, wh.ledger_path, names, found.attempt)
        report.rows[feed] += found.rows
    return found.rejected


def frames_of(
    spark: SparkSession, paths: list[str], input_format: str, multi_line: bool | None, work: str
) -> tuple[list[tuple[DataFrame, list[str]]], dict[str, str]]:
    """(frames with the paths they read, one per header or schema; path -> reason of unreadable files)."""
    rejected: dict[str, str] = {}
    if input_format.lower() == "parquet":
        groups: dict[str, list[str]] = defaultdict(list)
        for p, (schema, problem) in parquet_facts(spark, paths).items():
            if problem:
                rejected[p] = problem
            else:
                groups[schema].append(p)
        return [(read_parquet_files(spark, g), g) for _, g in sorted(groups.items(), key=lambda x: min(x[1]))], rejected
    hg = group_by_header(spark, paths, multi_line=multi_line)
    rejected |= {r.path: r.reason for r in hg.rejected}
    return [(read_csv_group(spark, names, g, records=sep, work=work), g) for (names, sep), g in hg.groups.items()], rejected


def _ingest_files(
    spark: SparkSession,
    wh: Warehouse,
    feed: str,
    paths: list[str],
    input_format: str,
    multi_line: bool | None,
    work: str,
    report: ImportReport,
) -> dict[str, str]:
    """One file per base name into one feed; returns path -> reason of the rejected ones."""
    hidden = [p for p in paths if is_hidden(p)]
    copies = visible_copies(spark, hidden, f"{work}/visible-{uuid.uuid4().hex}") if hidden else {}
    original = {copies.get(p, p): p for p in paths}
    frames, unreadable = frames_of(spark, list(original), input_format, multi_line, work)
    rejected = {original[p]: reason for p, reason in unreadable.items()}
    for df, group in frames:
        plain = {_plain(p): original[p] for p in group}
        for p, reason in ingest_group(spark, wh, feed, df, list(plain), work, report).items():
            rejected[plain[p]] = reason
    return rejected


def _plain(path: str) -> str:
    """Path with the base name that rows carry as ``source_file``."""
    folder, _, name = path.rpartition("/")
    return f"{folder}/{name.removeprefix(VISIBLE)}"


def import_paths(
    spark: SparkSession,
    wh: Warehouse,
    files: DataFrame,
    input_format: str = "csv",
    multi_line: bool | None = None,
) -> ImportReport:
    """Ingest the listed files (DataFrame with ``path`` and ``file_name``)
    that the ledger has not seen. ``multi_line`` None reads whole files in one
    task only where a quoted field holds a line break."""
    report = ImportReport()
    fresh = new_files(files, read_ledger(spark, wh.ledger_path))
    ranked = with_feed(rank_per_name(fresh.select("path", "file_name").distinct())).select("path", "file_name", "feed", "rank")
    n_names = ranked.filter("rank = 1").count()
    batches = max(1, -(-n_names // BATCH_NAMES))
    work = scratch_path(spark, "import")
    batch_of = F.pmod(F.xxhash64("file_name"), F.lit(batches))
    for b in range(batches):
        rows = sorted(ranked.filter(batch_of == b).collect(), key=lambda r: (r["rank"], r["path"]))
        waiting, loaded = rows, {}
        while waiting:
            # the smallest path of each name; the others wait for its outcome
            now = {}
            for r in waiting:
                now.setdefault(r["file_name"], r)
            by_feed: dict[str, list[str]] = defaultdict(list)
            for r in now.values():
                by_feed[r["feed"]].append(r["path"])
            rejected: dict[str, str] = {}

            def load(feed: str) -> dict[str, str]:
                return _ingest_files(spark, wh, feed, sorted(by_feed[feed]), input_format, multi_line, work, report)  # noqa: B023

            # feeds share no file, so their jobs run side by side
            with conf_override(spark, **COMPILED_CODE), ThreadPoolExecutor(max(1, len(by_feed))) as pool:
                outcomes = dict(zip(sorted(by_feed), pool.map(load, sorted(by_feed))))
            for feed, found in outcomes.items():
                rejected |= found
                done = [p for p in sorted(by_feed[feed]) if p not in found]
                report.ingested[feed].extend(_base(p) for p in done)
                loaded |= {_base(p): p for p in done}
            report.rejected += [Rejected(_base(p), reason) for p, reason in sorted(rejected.items())]
            tried = {r["path"] for r in now.values()}
            waiting = [r for r in waiting if r["path"] not in tried]
            lost = [r for r in waiting if r["file_name"] in loaded]
            report.duplicates += [r["path"] for r in lost]
            waiting = [r for r in waiting if r["file_name"] not in loaded]
    report.duplicates.sort()
    _write_quarantine(spark, wh, report)
    merge_commits(spark, wh.ledger_path)
    remove(spark, work)
    return report


def import_files(
    spark: SparkSession,
    wh: Warehouse,
    roots: list[str],
    input_format: str = "csv",
    multi_line: bool | None = None,
) -> ImportReport:
    """G4 entry: list ``*.<input_format>`` under ``roots`` and ingest."""
    files = list_files(spark, roots, input_format)
    return import_paths(spark, wh, files, input_format, multi_line)


def _write_quarantine(spark: SparkSession, wh: Warehouse, report: ImportReport) -> None:
    """Rejected files, and paths that lost to another file of their name."""
    rows = [(r.path, r.reason) for r in report.rejected]
    rows += [(p, "another file of this name was loaded") for p in report.duplicates]
    if not rows:
        return
    (
        spark.createDataFrame(rows, "file_name string, reason string")
        .withColumn("rejected_at", F.localtimestamp().cast("timestamp_ntz"))
        .coalesce(1)
        .write.mode("append")
        .parquet(wh.quarantine_path)
    )


def vacuum(spark: SparkSession, wh: Warehouse, feeds: list[str], older_than_hours: float = 24) -> list[str]:
    """Remove attempts that were never committed and are older than any running import can be."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    committed = read_ledger(spark, wh.ledger_path).select("attempt").distinct()
    found = []
    for feed in feeds:
        for folder in child_folders(spark, wh.feed_path(feed)):
            target = jvm.org.apache.hadoop.fs.Path(folder)
            age = time.time() - target.getFileSystem(conf).getFileStatus(target).getModificationTime() / 1000
            if age >= older_than_hours * 3600:
                found.append((folder, target.getName().partition("=")[2]))
    listed = spark.createDataFrame(found, "folder string, attempt string")
    gone = [r["folder"] for r in listed.join(committed, "attempt", "left_anti").collect()]
    for folder in gone:
        remove(spark, folder)
    return gone
