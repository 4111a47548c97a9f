"""Shared-storage helpers: written intermediates and release of finished shuffles."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession

from finlake.session import scratch_path


def materialize(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files every executor sees, so a lost executor costs
    at most the tasks it was running.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of phases whose result is already written.

    Spark removes shuffle files when the driver's JVM has collected the last
    reference to them; between phases of one operator that would otherwise wait
    for memory pressure while disks fill. The first collection only frees what
    holds those references (plans and listeners let go a moment later), so there
    is a second one.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
