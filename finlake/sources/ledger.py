"""Ingest ledger: one entry per ingested base name (S6, S7, J15), and the only commit.

The rows of an import are written as an *attempt*, a folder of their own that no
reader looks at. An entry (name, time, attempt), written after them as one file,
makes them visible; a crash before that leaves an attempt nobody sees, and the next
run writes another. So a file's rows and its entry appear together, also if the
file changed in between.

The ledger is a folder of small folders, one per commit, each written by one job of
its own; so importers never touch each other's files. When there are many they are
merged: all entries are written once more, then the merged folders are removed.
Entries seen twice in between are one entry. If two importers commit the same name,
the earlier entry counts and the later one's rows stay invisible.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.schemas import LEDGER_SCHEMA
from finlake.sources.store import child_folders, remove

log = logging.getLogger(__name__)

#: Commit folders beyond which they are merged, and entries in a merged file.
MAX_COMMITS, ENTRIES_PER_FILE = 64, 1_000_000
#: Attempts whose names (about 40 bytes each) are broadcast to a feed's rows.
MAX_BROADCAST_ATTEMPTS = 1_000_000


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Create-if-absent read: a missing ledger is an empty one."""
    try:
        entries = spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        raise
    return entries.dropDuplicates(["filename", "attempt"])


def new_files(files: DataFrame, ledger: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Files whose base name is not in the ledger."""
    seen = ledger.select(F.col("filename").alias(name_col))
    return files.join(seen, name_col, "left_anti")


def record(spark: SparkSession, path: str, names: DataFrame, attempt: str, name_col: str = "file_name") -> None:
    """Commit an attempt: its file names with the ingest time, in one file."""
    rows = names.select(
        F.col(name_col).alias("filename"),
        F.localtimestamp().cast("timestamp_ntz").alias("ingested_at"),
        F.lit(attempt).alias("attempt"),
    ).distinct()
    rows.coalesce(1).write.parquet(f"{path.rstrip('/')}/commit-{attempt}")


def merge_commits(spark: SparkSession, path: str, max_commits: int = MAX_COMMITS) -> bool:
    """Write all entries to one folder and remove the folders they came from, if there are many."""
    folders = child_folders(spark, path)
    if len(folders) <= max_commits:
        return False
    entries = spark.read.schema(LEDGER_SCHEMA).parquet(*folders).dropDuplicates(["filename", "attempt"])
    files = max(1, -(-entries.count() // ENTRIES_PER_FILE))
    # by name, so that a file's statistics tell which names it holds
    merged = entries.repartitionByRange(files, "filename").sortWithinPartitions("filename")
    merged.write.parquet(f"{path.rstrip('/')}/merged-{uuid.uuid4().hex}")
    for folder in folders:
        remove(spark, folder)
    log.info("merged %d ledger commits", len(folders))
    return True


def visible_rows(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows (with ``attempt`` and ``source_file``) of committed attempts, each file's from its first one."""
    attempts = ledger.select("attempt").distinct()
    few = attempts.count() <= MAX_BROADCAST_ATTEMPTS
    entry = F.struct("ingested_at", "attempt")
    # two importers at once: normally no rows
    late = (
        ledger.groupBy("filename")
        .agg(F.min(entry)["attempt"].alias("first"), F.collect_list("attempt").alias("attempts"))
        .filter(F.size("attempts") > 1)
        .select(F.col("filename").alias("source_file"), F.explode(F.array_except("attempts", F.array("first"))).alias("attempt"))
    )
    committed = rows.join(F.broadcast(attempts) if few else attempts, "attempt", "left_semi")
    return committed.join(F.broadcast(late), ["attempt", "source_file"], "left_anti")
