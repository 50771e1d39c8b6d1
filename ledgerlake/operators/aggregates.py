"""Aggregations: high-water marks, grouped sums, conditional window minima."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import join_back_aggregate


def high_water_mark_frame(df: DataFrame, column: str, where: Column | None = None,
                          alias: str = "hwm") -> DataFrame:
    """One-row frame with ``MAX(column)`` (optionally filtered); NULL when empty (O-52)."""
    src = df if where is None else df.where(where)
    return src.agg(F.max(column).alias(alias))


def high_water_mark(df: DataFrame, column: str, where: Column | None = None):
    """The high-water mark as a Python scalar: a single-row collect."""
    return high_water_mark_frame(df, column, where).first()[0]


def high_water_mark_by(df: DataFrame, column: str, by: str, values: Sequence) -> DataFrame:
    """Per-status marks in one pass: ``max(when(by = v, column))`` for each v (O-52)."""
    return df.agg(*[F.max(F.when(F.col(by) == F.lit(v), F.col(column))).alias(f"hwm_{v}")
                    for v in values])


def group_sum(df: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """GROUP BY many keys + sums; NULL keys group together (O-54)."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in sums.items()])


def conditional_min_over(df: DataFrame, keys: Sequence[str], value: Column, condition: Column,
                         alias: str) -> DataFrame:
    """``MIN(CASE WHEN condition THEN value END) OVER (PARTITION BY keys)`` (O-59)."""
    return join_back_aggregate(df, keys, [F.min(F.when(condition, value)).alias(alias)])


def sum_over(df: DataFrame, keys: Sequence[str], value: Column, alias: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY keys)`` re-attached to each row (O-60)."""
    return join_back_aggregate(df, keys, [F.sum(value).alias(alias)])


def after_watermark(column: str, hwm, inclusive: bool = False) -> Column:
    """Incremental extract predicate ``column > hwm`` (O-09/O-10).

    A NULL mark (empty target, first run) selects everything — the reference compared
    with NULL and loaded nothing (T-13); a NULL ``column`` is never selected once a mark
    exists.
    """
    c = F.col(column)
    if not isinstance(hwm, Column):
        # a value read before: a plain comparison that is pushed into the scan
        return F.lit(True) if hwm is None else (c >= F.lit(hwm) if inclusive else c > F.lit(hwm))
    hwm_col = hwm
    return hwm_col.isNull() | ((c >= hwm_col) if inclusive else (c > hwm_col))
