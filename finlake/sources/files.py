"""File discovery and routing (S1, S4, S7-S8 helpers).

Listing uses Spark's own file index (``binaryFile`` with only the ``path``
column selected, so no file content is read), which lists many roots in
parallel and works on any Hadoop-compatible store; files that the index hides
or skips (``_x.csv``, empty files) are added.
"""

from __future__ import annotations

import logging
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finlake.functions.columns import base_name, extract_path, route_feed
from finlake.sources.csv import VISIBLE

log = logging.getLogger(__name__)


def _exists(spark: SparkSession, root: str) -> bool:
    try:
        spark.read.format("binaryFile").load(root).select("path").limit(0).collect()
        return True
    except Exception as exc:  # missing root: warn and skip, as the CLI did
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return False
        raise


LISTING = "path string, file_name string, modification_time timestamp, length long, seen boolean"
#: Folders of writers in progress and table formats, never sources.
NOT_SOURCES = ("_temporary", "_spark_metadata", "_delta_log")


def list_files(spark: SparkSession, roots: list[str], extension: str) -> DataFrame:
    """DataFrame(path, file_name, modification_time, length, seen) of every file
    named ``*.<extension>`` under ``roots``, recursively: also empty files
    (length 0) and those whose name or folder starts with ``_`` or ``.``,
    which Spark's readers hide (``seen`` is false for both). A folder of that
    name that holds ``part-*`` files is one extract, listed by its own path. Missing
    roots are skipped with a warning."""
    ext = extension.lstrip(".")
    found = []
    for root in roots:
        if not _exists(spark, root):
            log.warning("source path %s does not exist or is not a folder; skipped", root)
            continue
        found.append(root)
    if not found:
        return spark.createDataFrame([], LISTING)
    index = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{ext}")
        .load(found)
        .select("path", "modificationTime", "length")
    )
    listing = index.select(
        "path",
        base_name("path").alias("file_name"),
        F.col("modificationTime").alias("modification_time"),
        "length",
        F.lit(True).alias("seen"),
    )
    # The file index knows empty files, but a scan of it skips them.
    known = spark.createDataFrame([(unquote(p),) for p in index.inputFiles()], "path string")
    bare = F.regexp_replace("path", "^file:/*", "/")
    empty = known.withColumn("bare", bare).join(listing.select(bare.alias("bare")), "bare", "left_anti")
    not_seen = F.lit(False).alias("seen")
    listing = listing.unionByName(
        empty.select("path", base_name("path").alias("file_name"), F.lit(0).cast("long").alias("length"), not_seen),
        allowMissingColumns=True,
    )
    # part files are one extract, under the name of their folder
    parts = listing.withColumn("path", extract_path("path")).groupBy("path")
    listing = parts.agg(
        F.max("modification_time").alias("modification_time"), F.sum("length").alias("length"), F.bool_or("seen").alias("seen")
    ).select("path", base_name("path").alias("file_name"), "modification_time", "length", "seen")
    hidden = [h for root in found for h in hidden_files(spark, root, ext)]
    if hidden:
        more = spark.createDataFrame(hidden, "path string, length long, changed long")
        changed = F.timestamp_millis("changed").alias("modification_time")
        listing = listing.unionByName(more.select("path", base_name("path").alias("file_name"), changed, "length", not_seen))
    return listing


def hidden_files(spark: SparkSession, root: str, extension: str) -> list[tuple[str, int, int]]:
    """(path, length, changed in ms) of files below ``root`` whose name or folder
    starts with ``_`` or ``.``. The folders are matched level by level in the file system's
    own client; only hidden entries are brought back."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(conf)
    out, level = [], root.rstrip("/")

    def add(status) -> None:
        name = status.getPath().getName()
        if name.endswith(f".{extension}"):
            out.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))

    while True:
        for status in fs.globStatus(path(f"{level}/[_.]*")) or []:
            if not status.isDirectory():
                add(status)
            elif status.getPath().getName() not in NOT_SOURCES:
                inside = fs.listFiles(status.getPath(), True)
                while inside.hasNext():
                    add(inside.next())
        level += "/*"
        if not fs.globStatus(path(f"{level}/*")):
            return out


def is_hidden(path: str) -> bool:
    """Whether Spark's readers skip a file given by its path (only its own name counts then)."""
    return path.rstrip("/").rsplit("/", 1)[-1].startswith(("_", "."))


def visible_copies(spark: SparkSession, paths: list[str], folder: str) -> dict[str, str]:
    """Copies, below ``folder`` on shared storage, of files that Spark's readers
    would skip (their name starts with ``_`` or ``.``): path -> copy."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    out = {}
    for i, p in enumerate(paths):
        name = p.rsplit("/", 1)[1]
        copy = f"{folder}/{i}/{VISIBLE}{name}"
        source, target = path(p), path(copy)
        jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)
        out[p] = copy
    return out


def with_feed(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Add the feed each file routes to."""
    return files.withColumn("feed", route_feed(name_col))


def rank_per_name(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Add ``rank``, 1 for the smallest path among files sharing a base
    name; the next one is tried if that is rejected."""
    return files.withColumn("rank", F.row_number().over(Window.partitionBy(name_col).orderBy("path")))
