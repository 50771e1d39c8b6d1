"""Session construction and lineage cutting.

Executors can disappear at any time; long lineages are cut by a table written
into the shared directory the cluster names in ``spark.checkpoint.dir``.  We only
set our own directory when the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a production job wants; all are plain public Spark options.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Large-cluster profile (hundreds of executors, tens of TB per job).  Partition sizes are
# set by bytes, not counts: AQE splits/coalesces shuffle partitions towards the advisory
# size, and a partition that is several times the median is treated as skewed and split.
CLUSTER_CONF = {
    # initial shuffle width: a 16 TB shuffle still lands at ~256 MB per partition; AQE
    # coalesces smaller shuffles down to the advisory size (not to the core count)
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "65536",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),  # runtime-checked size bound
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlake", extra: dict | None = None,
                profile: str = "local") -> SparkSession:
    """``profile='cluster'`` adds ``CLUSTER_CONF`` (for a real cluster, no master)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir, setting a local one only if unset and the
    session runs in local mode (tests); on a cluster the setting is required."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        # a machine-local folder is not visible to the other executors
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    target = configured or tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


@contextmanager
def measured_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Joins that run inside broadcast a side by the size it has when it is there, never by an estimate.

    The estimate is a share of the compressed files: of a table of keys it is a small part of what the
    rows take in the driver, which collects them and builds their hash table."""
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {k: spark.conf.get(k, None) for k in (planned, measured)}
    spark.conf.set(measured, before[measured] or spark.conf.get(planned))
    spark.conf.set(planned, "-1")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Folders of the runs under way, innermost last.
_RUNS: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for intermediate files, in the folder of the run under way if there is one."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlake"
    return "/".join([base, *_RUNS[-1:], f"{name}-{uuid.uuid4().hex[:12]}"])


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside go to one folder, which is removed when the block ends
    without an error (after one they stay, for a look).  Nothing lazy that reads them may outlive
    the block."""
    from ledgerlake.sources import fs
    _RUNS.append(f"run-{uuid.uuid4().hex[:12]}")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlake/{_RUNS[-1]}"
    try:
        yield path
    finally:
        _RUNS.pop()
    fs.remove(spark, path)


def cut_lineage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Cut the lineage by writing a Parquet table into the shared checkpoint directory
    and reading it back (never localCheckpoint).

    One pass over the data (``Dataset.checkpoint`` computes twice unless cached), and the
    downstream plans scan files: column pruning, filter pushdown and real size statistics
    for AQE's join choices.  Survives executor loss: the files are on shared storage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name or "layer")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
