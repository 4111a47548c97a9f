"""Incremental, once-per-name ingest as a Structured Streaming query.

The stream watches the source folders for new files (``binaryFile`` with only
the ``path`` column selected, so file contents are not read by the stream) and
hands each micro-batch of new paths to the batch importer through
``foreachBatch``, with every other listed path of the same base names: the
smallest valid path loads and the quarantine names the others, as in a batch
import, however the paths are dealt over micro-batches. The importer anti-joins
the ledger and writes bronze before the ledger, so a batch replayed after a
failure (the checkpoint is written after ``foreachBatch`` returns) loads
nothing twice. The stream checkpoint only saves re-listing; the ledger stays
the authority, which lets batch and stream share one bronze. Versions of files
that were rejected are a table beside the checkpoint, so neither a later batch nor
a restart tries them again; the driver keeps nothing between batches.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.columns import base_name, extract_path
from finlake.plans.ingest import ImportReport, import_paths
from finlake.plans.warehouse import Warehouse
from finlake.sources.files import list_files

# The fixed schema of Spark's binaryFile source.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


#: What tells a file from a later one at its path.
VERSION = ["path", "changed", "length"]
VERSION_SCHEMA = "path string, changed long, length long"


def rejected_versions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Versions of files that the stream with this checkpoint has rejected."""
    try:
        return spark.read.schema(VERSION_SCHEMA).parquet(_rejected_path(checkpoint))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], VERSION_SCHEMA)
        raise


def _rejected_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-rejected"


def corrected_files(spark: SparkSession, wh: Warehouse, listing: DataFrame) -> DataFrame | None:
    """Names of quarantined files that were changed since; the stream itself never lists a path twice."""
    try:
        quarantine = spark.read.parquet(wh.quarantine_path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return None
        raise
    last = quarantine.groupBy("file_name").agg(F.max("rejected_at").alias("rejected_at"))
    changed = F.col("modification_time").cast("timestamp_ntz") > F.col("rejected_at")
    return listing.join(last, "file_name").filter(changed).select("file_name")


def start_ingest_stream(
    spark: SparkSession,
    wh: Warehouse,
    source_path: str,
    checkpoint: str,
    input_format: str = "csv",
    available_now: bool = True,
    max_files_per_trigger: int | None = 1000,
    reports: list[ImportReport] | None = None,
):
    """Start the stream; returns the StreamingQuery. Each micro-batch takes
    at most ``max_files_per_trigger`` new files (``availableNow`` still
    drains everything, in several batches); which files load does not depend on
    it. A path that comes after its name was loaded is skipped, as in a batch
    import. Quarantined files that were corrected since, and files that the
    stream's listing does not show (hidden or empty ones), are imported before
    the stream starts, the latter also with every micro-batch. A fault that is
    not the data's fails its batch, which then runs again."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{input_format.lstrip('.')}")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    listing = reader.load(source_path).select("path")

    def run(listed: DataFrame, names: DataFrame) -> None:
        offered = listed.join(names.distinct(), "file_name", "left_semi")
        offered = offered.withColumn("changed", F.unix_micros("modification_time"))
        known = rejected_versions(spark, checkpoint).select(*[F.col(c).alias(f"__{c}") for c in VERSION])
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in VERSION]
        fresh = offered.join(known, same, "left_anti")
        report = import_paths(spark, wh, fresh, input_format)
        if report.rejected:
            bad = spark.createDataFrame([(r.path,) for r in report.rejected], "file_name string")
            versions = fresh.join(bad, "file_name", "left_semi").select(*VERSION)
            versions.coalesce(1).write.mode("append").parquet(_rejected_path(checkpoint))
        if reports is not None:
            reports.append(report)

    def unseen(listed: DataFrame) -> DataFrame:
        return listed.filter("not seen").select("file_name")

    def ingest_batch(batch: DataFrame, batch_id: int) -> None:
        names = batch.select(base_name(extract_path(F.col("path"))).alias("file_name"))
        listed = list_files(spark, [source_path], input_format)
        run(listed, names.unionByName(unseen(listed)))

    # no micro-batch runs if only these are new
    listed = list_files(spark, [source_path], input_format)
    first, again = unseen(listed), corrected_files(spark, wh, listed)
    if again is not None:
        first = first.unionByName(again)
    if not first.isEmpty():
        run(listed, first)

    writer = listing.writeStream.foreachBatch(ingest_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def ingest_available(
    spark: SparkSession, wh: Warehouse, source_path: str, checkpoint: str, input_format: str = "csv"
) -> list[ImportReport]:
    """Process every file present now, then stop (``availableNow``)."""
    reports: list[ImportReport] = []
    q = start_ingest_stream(spark, wh, source_path, checkpoint, input_format, reports=reports)
    q.awaitTermination()
    return reports
