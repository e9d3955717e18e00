"""Spark session defaults for the pipeline."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness (time zone) or for scale (AQE).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that adds a shuffle after the join (the
    # dedup and rollup aggregates downstream combine map-side anyway).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.exchange.reuse": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Conservative broadcast threshold: only genuinely small sides (date and
    # channel dimensions, nation, region) are broadcast by static size; AQE
    # still switches a join to broadcast when the measured shuffle output is
    # below it. Dimensions that grow with the data are shuffle-joined.
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
    # Checkpoint files are removed once their DataFrame is garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.cleaner.periodicGC.interval": "5min",
}


def cluster_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Shuffle sizing for a cluster run, by the bytes the largest exchange moves (not by
    the input's): partitions of about 1 GB, so that map tasks times partitions stays
    within what the shuffle service can index (100 TB: 100,000 partitions), at least two
    per core; the adaptive plan puts small ones together. Files are split at 256 MB."""
    parts = max(2 * cores, shuffle_bytes // (1 << 30))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tierwise", extra_conf: dict | None = None,
                shuffle_bytes: int | None = None, cores: int = 1) -> SparkSession:
    """``shuffle_bytes`` and ``cores`` size the exchanges (``cluster_conf``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_bytes:
        conf.update(cluster_conf(shuffle_bytes, cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    (local tests) is a fresh scratch folder created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tierwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
