"""Dense surrogate keys without a single-task global window (O-89, O-62 codes).

``row_number() over (order by key)`` has no partition clause, so Spark moves every row
into one task.  Instead:

1. distinct natural keys, range-partitioned and sorted by the key (parallel sort), written once;
2. per-partition row counts (one small row per partition) of that table -> running offsets;
3. id = offset of the partition + row number inside the partition.

The offsets frame has one row per partition, a bound we set ourselves, so it is safe to
broadcast.  ``stable_keys`` keeps existing ids and numbers only new keys after the
current maximum, so a refresh does not renumber the dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import cut_lineage

_PID = "__ll_pid"
_POS = "__ll_pos"


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def _bytes(text: str) -> int:
    """Spark byte-size setting ('67108864', '64m', '256MB') -> bytes."""
    t = text.strip().lower()
    digits = len(t) - len(t.lstrip("0123456789"))
    return int(t[:digits]) * _UNITS[t[digits:].strip()]


def _range_partitions(df: DataFrame) -> int:
    """Partitions for the range exchange: the optimizer's size estimate of the input over
    the advisory partition size, at most ``spark.sql.shuffle.partitions`` (an exchange by
    number is not coalesced by AQE, so a small dimension must not get thousands of tasks)."""
    conf = df.sparkSession.conf
    cap = int(conf.get("spark.sql.shuffle.partitions", "200"))
    advisory = _bytes(conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m") or "64m")
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(cap, -(-estimate // advisory)))


def global_row_number(df: DataFrame, order: Sequence, name: str, start: int | None = 1,
                      num_partitions: int | None = None, start_col=None) -> DataFrame:
    """``row_number() over (order by ...)`` computed in parallel (``order`` must be a total
    order, so ties never straddle two range partitions).

    The range-sorted frame is written once with its partition number and the position inside
    the partition; counts and numbers both come from that one table, so they agree whatever
    the partition count, the columns read later or an executor lost in between."""
    n = num_partitions or _range_partitions(df)
    order = list(order)
    # position inside the partition: monotonically_increasing_id() is (partition id << 33)
    # + row index within the partition, taken right after the local sort, so the local row
    # number needs no second shuffle (a window partitioned by partition id would add one)
    ranged = cut_lineage(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id()
                    - F.shiftleft(F.col(_PID).cast("long"), 33)), "row-number")
    counts = ranged.groupBy(_PID).agg((F.max(_POS) + 1).alias("__ll_cnt"))
    # running offsets over <= n rows: an unpartitioned window over a frame whose size we bound
    offsets = counts.select(
        _PID,
        (F.sum("__ll_cnt").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1))
         ).alias("__ll_off"))
    base = F.lit(start if start is not None else 0) if start_col is None else start_col
    numbered = (ranged.join(F.broadcast(offsets), _PID, "inner")
                .withColumn(name, (base + F.coalesce(F.col("__ll_off"), F.lit(0))
                                   + F.col(_POS)).cast("long")))
    return numbered.drop(_PID, _POS, "__ll_off")


def dense_keys(df: DataFrame, key_cols: Sequence[str], id_col: str, start: int | None = 1,
               num_partitions: int | None = None, start_col=None) -> DataFrame:
    """Distinct ``key_cols`` numbered densely ``start..start+n-1`` in key order
    (NULLs last)."""
    key_cols = list(key_cols)
    order = [F.col(c).asc_nulls_last() for c in key_cols]
    numbered = global_row_number(df.select(*key_cols).distinct(), order, id_col, start,
                                 num_partitions, start_col)
    return numbered.select(id_col, *key_cols)


def attach_keys(df: DataFrame, key_map: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Join the id of each natural key back onto the rows (NULL keys match NULL)."""
    key_cols = list(key_cols)
    km = key_map.select(*[F.col(c).alias(f"__ll_km_{c}") for c in key_cols],
                        *[c for c in key_map.columns if c not in key_cols])
    cond = [df[c].eqNullSafe(km[f"__ll_km_{c}"]) for c in key_cols]
    return df.join(km, cond, "left").drop(*[f"__ll_km_{c}" for c in key_cols])


def stable_keys(new_keys: DataFrame, key_map: DataFrame, key_cols: Sequence[str],
                id_col: str) -> DataFrame:
    """Existing ids are kept; unseen keys get ``max(id)+1 ..`` in key order (T-19)."""
    key_cols = list(key_cols)
    cond = [new_keys[c].eqNullSafe(key_map[c]) for c in key_cols]
    fresh = new_keys.select(*key_cols).distinct().join(key_map, cond, "left_anti")
    next_id = F.coalesce(key_map.select(F.max(id_col)).scalar(), F.lit(0)) + 1
    numbered = dense_keys(fresh, key_cols, id_col, start=None, start_col=next_id)
    return key_map.select(id_col, *key_cols).unionByName(numbered)


def category_codes(df: DataFrame, column: str, code_col: str | None = None) -> DataFrame:
    """pandas ``category`` codes: 0..k-1 in sorted value order, NULL -> -1 (O-62)."""
    code_col = code_col or f"{column}_code"
    codes = dense_keys(df.where(F.col(column).isNotNull()), [column], code_col, start=0)
    out = attach_keys(df, codes, [column])
    return out.withColumn(code_col, F.coalesce(F.col(code_col), F.lit(-1).cast("long")))
