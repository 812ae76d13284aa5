"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings every job of this package relies on. Event-time text carries no zone, so
# the session zone is pinned; AQE re-plans joins and splits skewed partitions at run time.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # state of streams: a batch writes the keys it touches
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a join keeps both of its sides in one store per partition, not in four
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

# Only at start-up: capturing the Python call site of every expression makes building a large
# plan several times slower.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "fleetpulse", master: str | None = None, **conf) -> SparkSession:
    """A session with the package settings; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**STATIC_SETTINGS, **SQL_SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the package's SQL settings to a session somebody else built."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (``spark.checkpoint.dir``).

    Only a local master may fall back to a machine-local folder: on a cluster the executors
    would each see a different disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    fallback = os.path.join(tempfile.gettempdir(), f"fleetpulse-{spark.sparkContext.applicationId}")
    os.makedirs(fallback, exist_ok=True)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared scratch folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding a configured folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
