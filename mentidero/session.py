"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime re-planning does the skew splitting and partition sizing on a cluster;
# nothing here depends on the size of the input.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The first rows of a group are kept inside each task at any number wanted.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    # Narrow build sides are hashed instead of sorting the wide side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Long texts: keep one Arrow batch to a few MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
}


def build_session(app: str = "mentidero", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session with the engine's settings; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder that driver and executors share. Where none is named, a local session
    (one process) uses a folder of its own machine; on a cluster that would lose rows, so it is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        base = tempfile.mkdtemp(prefix="mentidero-")
    return f"{base.rstrip('/')}/mentidero/{purpose}-{uuid.uuid4().hex[:12]}"
