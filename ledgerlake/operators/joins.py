"""Join patterns of the warehouse models, written so Catalyst can plan them well.

* interval / effective-date joins keep an equi key, so they plan as hash or sort-merge
  joins with a residual range predicate (never a nested loop); where a key has many points and
  many intervals, both are also cut into bins of the range;
* EXISTS under OR is a correlated ``exists()`` subquery -> ExistenceJoin;
* a per-group aggregate re-attached to its detail is ``groupBy`` (map-side partial
  aggregation, skew-proof) + join back, instead of a window that sends a hot key to one task;
* a constant-key lookup ("the default row") is a scalar subquery, not a cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bins of the point range in ``binned_interval_join``: at most this many copies of an interval.
BINS = 256


def _pairs(on) -> list[tuple[str, str]]:
    out = []
    for item in ([on] if isinstance(on, str) else on):
        out.append((item, item) if isinstance(item, str) else tuple(item))
    return out


def _equi(left: DataFrame, right: DataFrame, on) -> list[Column]:
    return [left[a] == right[b] for a, b in _pairs(on)]


def expect_unique(df: DataFrame, keys: Sequence[str], what: str | None = None) -> DataFrame:
    """``df`` unchanged, but the query fails (``raise_error``, inside the job, no extra
    action) if a non-NULL key occurs more than once -- the opt-in "fail early" for the
    fan-outs the source models reproduce (T-07).

    A count over ``PARTITION BY key`` reads the input once (a self-join would copy its
    whole lineage into the plan).  Rows with a NULL key cannot fan out; they get a row
    hash as extra partition key, so many of them are not sent to one task.  A repeated
    non-NULL key is exactly the failure case.
    """
    keys = list(keys)
    present = None
    for k in keys:
        present = F.col(k).isNotNull() if present is None else present & F.col(k).isNotNull()
    spread = F.when(~present, F.xxhash64(*[F.col(c) for c in df.columns]))
    counted = df.withColumn("__ll_n", F.count(F.lit(1)).over(Window.partitionBy(*keys, spread)))
    msg = f"expect_unique: duplicate key {keys} in {what or 'lookup side'}"
    ok = F.when(present & (F.col("__ll_n") > 1), F.raise_error(F.lit(msg))).otherwise(F.lit(True))
    return counted.where(ok).drop("__ll_n")


def interval_join(left: DataFrame, right: DataFrame, on, point: str, start: str, end: str,
                  how: str = "inner", expect_unique_keys: Sequence[str] | None = None) -> DataFrame:
    """Equi key + half-open interval ``start <= point < end`` (O-48f).

    Overlapping intervals fan out, as in SQL; ``expect_unique_keys`` (columns of
    ``right``) makes the query fail instead when the right side repeats them.
    """
    if expect_unique_keys:
        right = expect_unique(right, expect_unique_keys, "interval side")
    cond = _equi(left, right, on) + [left[point] >= right[start], left[point] < right[end]]
    return left.join(right, cond, how)


def _position(df: DataFrame, column: str) -> Column:
    """The column as a long that never falls where the column rises: days of dates and timestamps,
    the whole part of numbers."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_date(F.to_date(df[column])).cast("long")
    if isinstance(kind, T.IntegralType):
        return df[column].cast("long")
    raise TypeError(f"{column}: points are dates, timestamps or integers, not {kind.simpleString()}")


def binned_interval_join(left: DataFrame, right: DataFrame, on, point: str, start: str, end: str,
                         how: str = "inner", bins: int = BINS) -> DataFrame:
    """``interval_join`` for keys that hold many points and many intervals (O-48f): same rows.

    The range of all points is cut into at most ``bins`` bins of equal width (a power of two).  A
    point lies in one bin, an interval is put into each bin it touches within the range, and the
    bin joins the equi key: a hot key becomes up to ``bins`` keys, and its points meet the
    intervals of their own bin only.  The bounds of the points are read first (one row).

    A point keeps its single row, so inner, left, semi and anti joins are exact; the others would
    see an interval once a bin and are refused.  NULL points, bounds and keys match nothing, nor
    do intervals that end before they start; overlapping intervals fan out.
    """
    if how not in ("inner", "left", "left_outer", "leftouter", "semi", "left_semi", "leftsemi",
                   "anti", "left_anti", "leftanti"):
        raise ValueError(f"binned interval joins keep the rows of the left side, {how} does not")
    if bins < 1:
        raise ValueError("bins must be at least 1")
    where = _position(left, point)
    low, high = left.agg(F.min(where), F.max(where)).first()
    if low is None:
        return interval_join(left, right, on, point, start, end, how)
    shift = 0
    while (high >> shift) - (low >> shift) >= bins:
        shift += 1
    first = F.greatest(F.shiftright(_position(right, start), shift), F.lit(low >> shift).cast("long"))
    last = F.least(F.shiftright(_position(right, end), shift), F.lit(high >> shift).cast("long"))
    # whole rows of the right side: its columns keep their names, whatever they are
    there = right.where((right[start] < right[end]) & (first <= last))
    cut = there.withColumn("__ll_bin_r", F.explode(F.sequence(first, last)))
    points = left.withColumn("__ll_bin_l", F.shiftright(where, shift))
    cond = _equi(points, cut, on) + [points["__ll_bin_l"] == cut["__ll_bin_r"],
                                     points[point] >= cut[start], points[point] < cut[end]]
    return points.join(cut, cond, how).drop("__ll_bin_l", "__ll_bin_r")


def effective_join(left: DataFrame, right: DataFrame, on, point: str, effective_from: str,
                   how: str = "left", expect_unique_keys: Sequence[str] | None = None) -> DataFrame:
    """Equi key + ``point >= effective_from``; every effective row matches (O-48g), or
    the query fails if ``right`` repeats ``expect_unique_keys``."""
    if expect_unique_keys:
        right = expect_unique(right, expect_unique_keys, "effective-date side")
    cond = _equi(left, right, on) + [left[point] >= right[effective_from]]
    return left.join(right, cond, how)


def validity_window(left: DataFrame, right: DataFrame, on, point: str, start: str, end: str
                    ) -> tuple[DataFrame, Column]:
    """LEFT join then the inclusive ``BETWEEN`` test as a (three-valued) Column (O-48h)."""
    joined = left.join(right, _equi(left, right, on), "left")
    return joined, F.col(point).between(F.col(start), F.col(end))


def exists_in(other: DataFrame, on) -> Column:
    """``EXISTS (SELECT 1 FROM other WHERE other.b = outer.a ...)`` as a Column (O-50).

    ``on`` pairs are (outer column, other column).  Usable inside OR -> ExistenceJoin.
    """
    cond = None
    for a, b in _pairs(on):
        term = F.col(b) == F.col(a).outer()
        cond = term if cond is None else cond & term
    return other.where(cond).exists()


def semi_or(df: DataFrame, other: DataFrame, on, predicate: Column) -> DataFrame:
    """Rows satisfying ``predicate OR EXISTS(match in other)`` (O-50)."""
    return df.where(predicate | exists_in(other, on))


def anti_join(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """``NOT EXISTS`` (O-49)."""
    return df.join(other, _equi(df, other, on), "left_anti")


def full_override(base: DataFrame, override: DataFrame, key: str, fields: Sequence[str],
                  override_key: str | None = None) -> DataFrame:
    """Full outer join; each field = coalesce(override, base); override-only rows survive
    (O-48d)."""
    ok = override_key or key
    b = base.alias("b")
    o = override.alias("o")
    joined = b.join(o, F.col(f"b.{key}") == F.col(f"o.{ok}"), "full")
    cols = [F.coalesce(F.col(f"o.{ok}"), F.col(f"b.{key}")).alias(key)]
    cols += [F.coalesce(F.col(f"o.{f}"), F.col(f"b.{f}")).alias(f) for f in fields]
    return joined.select(*cols)


def lookup_default(lookup: DataFrame, key_col: str, key_value, value_col: str) -> Column:
    """Value of ``value_col`` in the single lookup row whose key equals a literal (O-48i).

    A scalar subquery: NULL if the row is absent, an error if the key is not unique —
    no cross join, no fan-out.
    """
    return lookup.where(F.col(key_col) == F.lit(key_value)).select(value_col).scalar()


def attach_default_row(df: DataFrame, lookup: DataFrame, key_col: str, key_value,
                       columns: dict[str, str]) -> DataFrame:
    """Attach the default lookup row to every row: ``{alias: lookup column}``."""
    return df.withColumns({alias: lookup_default(lookup, key_col, key_value, src)
                           for alias, src in columns.items()})


def join_back_aggregate(detail: DataFrame, keys: Sequence[str], aggs: Sequence[Column],
                        null_safe: bool = True) -> DataFrame:
    """Per-group aggregates re-attached to every detail row (O-51, O-60).

    Equivalent to ``agg(..) OVER (PARTITION BY keys)`` (NULL keys form one group when
    ``null_safe``), but the aggregate is computed with map-side partial aggregation and
    the re-attach is an equi join that AQE can split when one key is hot.
    """
    keys = list(keys)
    g = detail.groupBy(*keys).agg(*aggs)
    renamed = g.select(*[F.col(k).alias(f"__ll_k_{i}") for i, k in enumerate(keys)],
                       *[c for c in g.columns if c not in keys])
    cond = [(detail[k].eqNullSafe(renamed[f"__ll_k_{i}"]) if null_safe
             else detail[k] == renamed[f"__ll_k_{i}"]) for i, k in enumerate(keys)]
    out = detail.join(renamed, cond, "left")
    return out.drop(*[f"__ll_k_{i}" for i in range(len(keys))])
