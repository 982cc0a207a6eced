"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """Start or get a session. Executors and memory are the cluster's to size."""
    builder = (
        SparkSession.builder.appName("roadbook")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Source timestamps carry no zone; UTC keeps every duration free of clock changes."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Input per shuffle partition.
BYTES_PER_PARTITION = 256 * 1024**2
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def working_session(spark: SparkSession, input_bytes: int = 0, **conf: str) -> SparkSession:
    """A session beside the caller's for work of the engine's own, on the same cluster and catalog.

    It has the caller's settings, UTC, the given ones, and shuffles that start with enough partitions
    for the input, never with fewer than configured: adaptive execution joins partitions that turn
    out small, but does not split those of an aggregation or a window. The caller's session stays as
    it is, so builds that run at the same time do not change each other's settings.
    """
    own = spark.newSession()
    known = own.conf.getAll
    for key, value in spark.conf.getAll.items():
        if known.get(key) != value and own.conf.isModifiable(key):
            own.conf.set(key, value)
    use_utc(own)
    configured = own.conf.get(PARTITIONS, None) or own.conf.get("spark.sql.shuffle.partitions")
    wanted = -(-input_bytes // BYTES_PER_PARTITION)
    if wanted > int(configured):
        own.conf.set(PARTITIONS, str(wanted))
    for key, value in conf.items():
        own.conf.set(key, value)
    return own


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder the cluster shares between its machines.

    A machine-local folder is made only for a local session that names no shared one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="roadbook-")
    app = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/roadbook/{app}/{label}-{uuid.uuid4().hex[:12]}"

