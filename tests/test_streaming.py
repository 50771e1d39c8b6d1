"""The streaming incremental load equals a full load of the same data."""

import os

from pyspark.sql import functions as F

from ledgerlake.streaming import incremental

from .conftest import SMALL_SF


def test_stream_of_extract_files_equals_full_load(spark, tmp_dir):
    orders = spark.read.parquet(os.path.join(SMALL_SF, "orders.parquet")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    src = os.path.join(tmp_dir, "landing")
    # three extracts by date range, the last one overlapping the second (re-extracted rows)
    years = [("1990-01-01", "1997-01-01"), ("1997-01-01", "1999-06-01"), ("1999-01-01", "2100-01-01")]
    for i, (lo, hi) in enumerate(years):
        (orders.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))
         .coalesce(1).write.parquet(os.path.join(src, f"part{i}")))
    # streaming source directory must hold files directly: move each extract's files up
    flat = os.path.join(tmp_dir, "flat")
    os.makedirs(flat)
    for i in range(3):
        d = os.path.join(src, f"part{i}")
        for f in os.listdir(d):
            if f.endswith(".parquet"):
                os.link(os.path.join(d, f), os.path.join(flat, f"x{i}-{f}"))
    target = os.path.join(tmp_dir, "bronze")
    q = incremental.start_incremental_load(spark, flat, orders.schema, target, ["o_orderkey"],
                                           os.path.join(tmp_dir, "ckpt"), max_files_per_trigger=1)
    q.awaitTermination(300)
    snap = incremental.latest_snapshot(spark, target)
    assert snap.count() == orders.count()
    assert snap.exceptAll(orders).count() == 0
