"""Stateless column transformers: every step is ``DataFrame -> DataFrame``.

A chain of steps is ``chain(df, [f1, f2, ...])`` (= ``df.transform(f1).transform(f2)``);
nothing is fitted, so no ``pyspark.ml`` estimator is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import casts, dates, text

Step = Callable[[DataFrame], DataFrame]


def _as_list(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def chain(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """Feed the output of each step into the next (O-90)."""
    return reduce(lambda acc, step: acc.transform(step), steps, df)


def require_columns(df: DataFrame, cols: Sequence[str], what: str = "columns") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing {what}: {missing}")


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename; names absent from the frame are ignored (O-29)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop; a missing column is an error (Spark alone would ignore it) (O-31)."""
    cols = _as_list(cols)
    require_columns(df, cols)
    return df.drop(*cols)


def keep_columns(df: DataFrame, cols) -> DataFrame:
    return df.select(*_as_list(cols))


def drop_null_dates(df: DataFrame, cols) -> DataFrame:
    """Drop rows with NULL in any listed column (O-33)."""
    return df.dropna(how="any", subset=_as_list(cols))


def equality_flag(df: DataFrame, column: str, value, flag: str = "flag") -> DataFrame:
    """``flag = (column == value)``; NULL compares as False (O-34)."""
    return df.withColumn(flag, F.coalesce(F.col(column) == F.lit(value), F.lit(False)))


def inequality_flag(df: DataFrame, column: str, value, flag: str = "flag") -> DataFrame:
    """``flag = (column != value)``; NULL compares as True (O-35)."""
    return df.withColumn(flag, F.coalesce(F.col(column) != F.lit(value), F.lit(True)))


def replace_value(df: DataFrame, column: str, old, new) -> DataFrame:
    """Whole-value replacement, not substring (O-36)."""
    c = F.col(column)
    return df.withColumn(column, F.when(c == F.lit(old), F.lit(new)).otherwise(c))


def sort_values(df: DataFrame, cols, ascending=True) -> DataFrame:
    """Global sort, NULLs last in both directions (pandas) (O-61)."""
    cols = _as_list(cols)
    asc = [ascending] * len(cols) if isinstance(ascending, bool) else list(ascending)
    return df.orderBy(*[F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last()
                        for c, a in zip(cols, asc)])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_text_columns(df: DataFrame, cols=None) -> DataFrame:
    """Strip all surrounding whitespace; default = every string column (O-70)."""
    cols = [c for c in (_as_list(cols) or string_columns(df)) if c in df.columns]
    return df.withColumns({c: text.strip_whitespace(c) for c in cols})


def upper_columns(df: DataFrame, cols) -> DataFrame:
    """Upper-case; absent columns are skipped (O-71)."""
    return df.withColumns({c: F.upper(F.col(c)) for c in _as_list(cols) if c in df.columns})


def clean_special_columns(df: DataFrame, cols) -> DataFrame:
    """Transliterate + delete control characters; absent columns skipped (O-78)."""
    return df.withColumns({c: text.clean_special(c) for c in _as_list(cols) if c in df.columns})


def normalize_text_columns(df: DataFrame, cols, length: int | None = 255) -> DataFrame:
    """Full text normalisation (O-79)."""
    return df.withColumns({c: text.normalize_text(c, length)
                           for c in _as_list(cols) if c in df.columns})


def cast_datetime_columns(df: DataFrame, cols, fmt: str = dates.DEFAULT_TS_FORMAT) -> DataFrame:
    """Exact-format timestamp parse, bad -> NULL (O-63)."""
    return df.withColumns({c: dates.strict_timestamp(c, fmt) for c in _as_list(cols)})


def cast_float_columns(df: DataFrame, cols) -> DataFrame:
    """Double cast; a non-numeric value raises (O-64)."""
    return df.withColumns({c: casts.to_double(c) for c in _as_list(cols)})


def cast_integer_columns(df: DataFrame, cols, nullable: bool = True) -> DataFrame:
    """Nullable (default) or strict non-null integer cast; absent columns skipped (O-65)."""
    fn = casts.to_nullable_long if nullable else (lambda c: casts.to_strict_long(c, c))
    return df.withColumns({c: fn(c) for c in _as_list(cols) if c in df.columns})


def cast_string_columns(df: DataFrame, cols, length: int = 255) -> DataFrame:
    """Upper-case string cut to ``length``, NULL kept (O-65b)."""
    return df.withColumns({c: casts.to_upper_string(c, length)
                           for c in _as_list(cols) if c in df.columns})


def cast_bool_columns(df: DataFrame, cols) -> DataFrame:
    """Truthiness per source type (O-65c)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: casts.to_truthy_bool(c, types[c]) for c in _as_list(cols)})


def nan_to_null_columns(df: DataFrame, cols=None) -> DataFrame:
    """NaN -> NULL on float columns before a write (O-23)."""
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cols = [c for c in (_as_list(cols) or floats) if c in floats]
    return df.withColumns({c: casts.nan_to_null(c) for c in cols})


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name, missing columns -> NULL (O-67). Input must be a list/tuple."""
    if not isinstance(frames, (list, tuple)) or not frames:
        raise ValueError("union_by_name expects a non-empty list or tuple of DataFrames")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """SQL UNION (distinct) over positionally aligned branches (O-68)."""
    return reduce(lambda a, b: a.union(b), frames).distinct()
