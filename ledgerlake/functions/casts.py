"""Column type coercions of the transformer library, as ``Column`` expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.util import to_col


def to_double(c) -> Column:
    """Float cast; a non-numeric value raises under ANSI mode (as the reference does)."""
    return to_col(c).cast("double")


def to_nullable_long(c) -> Column:
    """Nullable integer cast; NULL stays NULL, garbage raises (ANSI)."""
    return to_col(c).cast("long")


def to_strict_long(c, name: str = "value") -> Column:
    """Non-null integer: raises on NULL like numpy ``int64``."""
    col = to_col(c)
    return F.when(col.isNull(), F.raise_error(F.lit(f"NULL in non-null integer {name}"))) \
        .otherwise(col.cast("long"))


def to_upper_string(c, length: int = 255) -> Column:
    """Upper-case text cut to ``length``; NULL kept."""
    return F.substring(F.upper(to_col(c).cast("string")), 1, length)


def to_truthy_bool(c, dtype: T.DataType) -> Column:
    """Python truthiness per source type: '' / 0 / NULL -> False, NaN -> True."""
    col = to_col(c)
    if isinstance(dtype, T.StringType):
        expr = col != F.lit("")
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        expr = F.isnan(col) | (col != F.lit(0.0))
    elif isinstance(dtype, T.NumericType):
        expr = col != F.lit(0)
    elif isinstance(dtype, T.BooleanType):
        expr = col
    else:
        expr = col.isNotNull()
    return F.coalesce(expr, F.lit(False))


def nan_to_null(c) -> Column:
    col = to_col(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)
