"""Calendar and timestamp helpers (time-zone independent: everything is TIMESTAMP_NTZ/DATE)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.util import to_col

# --- fixed values --------------------------------------------------------------------
# Default exact format of the source timestamps, and its shape as a regex.
DEFAULT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DEFAULT_TS_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
# PostgreSQL TO_CHAR 'Month' / 'Day' pad names with blanks to this width.
PG_NAME_WIDTH = 9
# --------------------------------------------------------------------------------------


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal that does not depend on any time zone.

    ``F.lit(datetime)`` builds a session-zone TIMESTAMP from the Python process' local
    zone; compared with a TIMESTAMP_NTZ column it shifts when the two zones differ.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


def month_shift(c, months: int = -1) -> Column:
    """``(d - INTERVAL 'n month')::date``: clamps to the month end (03-31 -> 02-28)."""
    return F.add_months(F.to_date(to_col(c)), months)


def strict_timestamp(c, fmt: str = DEFAULT_TS_FORMAT) -> Column:
    """Parse with an exact format; anything else (incl. a date-only string) -> NULL."""
    col = to_col(c).cast("string")
    if fmt == DEFAULT_TS_FORMAT:
        return F.when(col.rlike(DEFAULT_TS_SHAPE), col.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def month_name_padded(c) -> Column:
    return F.rpad(F.date_format(to_col(c), "MMMM"), PG_NAME_WIDTH, " ")


def day_name_padded(c) -> Column:
    return F.rpad(F.date_format(to_col(c), "EEEE"), PG_NAME_WIDTH, " ")


def is_weekend(c) -> Column:
    """ISO day of week in (6, 7): Saturday or Sunday."""
    return F.dayofweek(to_col(c)).isin(1, 7)


def timestamp_text(c) -> Column:
    """Timestamp -> text the way PostgreSQL prints it (fraction only when non-zero)."""
    col = to_col(c)
    base = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    frac = F.date_format(col, "SSSSSS")
    return F.when(frac == "000000", base).otherwise(
        F.concat(base, F.lit("."), F.regexp_replace(frac, "0+$", "")))
