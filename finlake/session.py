"""Session construction and shared-storage helpers.

Lineage cuts and intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir``. Only a local session without one (tests) gets a
folder under /tmp.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale; every one can be overridden by the caller.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: HotSpot never compiles a method of more than 8,000 bytes of bytecode. Spark's whole-stage code of a row with many
#: columns is one such method, interpreted for every row; beyond this limit Spark runs operators whose code is split.
COMPILED_CODE = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def get_session(master: str | None = None, app: str = "finlake", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Only a local session without one
    gets a folder under /tmp; on a cluster a missing setting is an error."""
    sc = _context(spark)
    current = None
    if sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current and sc is not None:
            sc.setCheckpointDir(current)
    if not current:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        current = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        if sc is not None:
            sc.setCheckpointDir(current)
        spark.conf.set("spark.checkpoint.dir", current)
        # setCheckpointDir adds a uuid child; report what Spark actually uses
        if sc is not None:
            current = sc.getCheckpointDir() or current
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/finlake/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


@contextmanager
def conf_override(spark: SparkSession, **settings: str):
    """Temporarily set session settings (restored afterwards). Settings are
    read when plans are built, so the override shapes plans built inside."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
