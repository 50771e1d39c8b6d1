"""Incremental bronze loads as a Structured Streaming job (optional extension).

The reference runs its loads as scheduled batches driven by a high-water mark.  The same
load can run as a file stream: new extract files land in a directory, each micro-batch is
merged (``merge.upsert``) into the bronze snapshot inside ``foreachBatch``.

Exactly-once without a row-level table format: batch ``n`` reads snapshot ``epoch=n-1``
and writes snapshot ``epoch=n`` with ``mode("overwrite")``.  A batch replayed after a
failure rewrites the same directory from the same input, so it is idempotent; the
streaming checkpoint (offsets) lives in the shared checkpoint directory.  The snapshots of the
last two batches are kept.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.operators import merge
from ledgerlake.sources import fs
from ledgerlake.sources.readers import path_exists


def snapshot_path(target_dir: str, epoch: int) -> str:
    return os.path.join(target_dir, f"epoch={epoch}")


def merge_batch(spark: SparkSession, target_dir: str, keys: Sequence[str],
                update_cols: Sequence[str] | None, schema: T.StructType):
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            if path_exists(spark, snapshot_path(target_dir, 1)):
                # the checkpoint is gone but the snapshots are not: starting over would leave
                # ``latest_snapshot`` on an older, higher epoch
                raise RuntimeError(f"{target_dir} holds later epochs; restore the checkpoint or take a new target")
            current = spark.createDataFrame([], schema)
        else:
            current = spark.read.schema(schema).parquet(snapshot_path(target_dir, batch_id - 1))
        new = merge.upsert(current, merge.unique_keys(batch, list(keys)), list(keys), update_cols)
        new.write.mode("overwrite").parquet(snapshot_path(target_dir, batch_id))
        # a replay of this batch reads the snapshot before it; older ones are not needed
        fs.remove(spark, snapshot_path(target_dir, batch_id - 2))
    return run


def start_incremental_load(spark: SparkSession, source_dir: str, schema: T.StructType, target_dir: str,
                           keys: Sequence[str], checkpoint_location: str,
                           update_cols: Sequence[str] | None = None, max_files_per_trigger: int | None = None):
    """Start the stream; ``availableNow`` processes what is there and stops (a scheduled
    run), so it can replace the batch job one-for-one."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    return (stream.writeStream.foreachBatch(merge_batch(spark, target_dir, keys, update_cols, schema))
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())


def latest_snapshot(spark: SparkSession, target_dir: str) -> DataFrame:
    """The newest snapshot (highest epoch directory).  Listed through the Hadoop
    FileSystem of the path, so it works on shared storage, not only on a local disk."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    epochs = []
    if path_exists(spark, target_dir):
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("epoch="):
                epochs.append(int(name.split("=", 1)[1]))
    if not epochs:
        raise FileNotFoundError(f"no snapshot under {target_dir}")
    return spark.read.parquet(snapshot_path(target_dir, max(epochs)))


def dedup_within_watermark(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Streaming counterpart of the key dedup: duplicates arriving within ``delay`` of
    each other are dropped, state is bounded by the watermark."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
