"""Ordered deduplication that survives a hot key.

``keep_first`` keeps the first row per key under an explicit total order.  A plain
``row_number() over (partition by key)`` would send every row of a key to one task; when
one key holds a third of the data that task is the job.  Two ways to avoid it:

* Spark (3.5+) rewrites ``row_number() ... = 1`` into a *partial* ``WindowGroupLimit``
  before the shuffle: every map task keeps only its best row per key, so a hot key
  reaches its reducer as at most one row per map partition (a map-side combine).  This
  is the default whenever ``spark.sql.optimizer.windowGroupLimitThreshold`` allows it.
* Otherwise we reduce in two exact phases: rank inside ``(key, salt)`` with
  ``salt = hash(row) mod n`` and keep each salted slice's winner (a hot key is spread
  over ``n`` tasks), then rank the at most ``n`` survivors per key.  The global winner is
  the winner of its own slice, so the result equals the one-phase plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALT_BUCKETS = 32
_RN = "__ll_rn"
_SALT = "__ll_salt"


def _cols(cols) -> list:
    if cols is None:
        return []
    return [cols] if isinstance(cols, (str, Column)) else list(cols)


def _map_side_group_limit(df: DataFrame) -> bool:
    """Does the optimizer reduce ``row_number() = 1`` map-side (partial WindowGroupLimit)?"""
    conf = df.sparkSession.conf
    return int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")) >= 1


def keep_first(df: DataFrame, keys, order: Sequence[Column], salt_buckets: int | None = None,
               salt_cols: Sequence[str] | None = None) -> DataFrame:
    """First row per ``keys`` under ``order`` (which must be a total order).

    NULL key values form one group, as in SQL ``PARTITION BY``.
    """
    keys = _cols(keys)
    order = list(order)
    if salt_buckets is None:
        salt_buckets = 1 if _map_side_group_limit(df) else DEFAULT_SALT_BUCKETS
    n = salt_buckets
    cur = df
    if n and n > 1:
        salt_src = [F.col(c) for c in (salt_cols or df.columns)]
        cur = cur.withColumn(_SALT, F.pmod(F.xxhash64(*salt_src), F.lit(n)))
        w1 = Window.partitionBy(*keys, _SALT).orderBy(*order)
        cur = cur.withColumn(_RN, F.row_number().over(w1)).where(F.col(_RN) == 1).drop(_RN, _SALT)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return cur.withColumn(_RN, F.row_number().over(w2)).where(F.col(_RN) == 1).drop(_RN)


def drop_duplicates(df: DataFrame, subset, keep: str | bool = "first",
                    row_order: Sequence[str] | None = None) -> DataFrame:
    """pandas ``drop_duplicates`` on a key subset (O-66).

    Rows whose whole subset is NULL are dropped first; NULL equals NULL inside a partly
    NULL key.  A DataFrame has no row order, so ``keep='first'|'last'`` needs
    ``row_order``: columns that encode the input order (e.g. source priority, sequence),
    which together must be unique.  ``keep=False`` drops every duplicated key.
    """
    subset = _cols(subset)
    cur = df.dropna(how="all", subset=subset)
    if keep is False:
        from ledgerlake.operators.joins import join_back_aggregate
        counted = join_back_aggregate(cur, subset, [F.count(F.lit(1)).alias("__ll_n")])
        return counted.where(F.col("__ll_n") == 1).drop("__ll_n")
    if not row_order:
        raise ValueError("keep='first'/'last' needs row_order (DataFrames are unordered)")
    if keep == "first":
        order = [F.col(c).asc_nulls_last() for c in row_order]
    elif keep == "last":
        order = [F.col(c).desc_nulls_first() for c in row_order]
    else:
        raise ValueError(f"bad keep: {keep!r}")
    return keep_first(cur, subset, order)
