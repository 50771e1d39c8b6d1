"""Calendar dimension (O-16, M-13): one row per day, end date exclusive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import dates

# --- fixed values --------------------------------------------------------------------
# Span of the warehouse calendar (end exclusive -> last day 2030-12-30, 5,843 rows).
CALENDAR_START = dt.date(2015, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)
# --------------------------------------------------------------------------------------


def date_spine_between(df: DataFrame, start: Column, end_exclusive: Column,
                       name: str = "date_day") -> DataFrame:
    """Explode ``[start, end)`` given as columns of a one-row frame."""
    return df.where(start < end_exclusive).select(
        F.explode(F.sequence(start, F.date_sub(end_exclusive, 1))).alias(name))


def date_spine(spark: SparkSession, start: dt.date = CALENDAR_START,
               end: dt.date = CALENDAR_END, name: str = "date_day") -> DataFrame:
    one = spark.range(1)
    return date_spine_between(one, F.lit(start), F.lit(end), name)


def dim_date(spine: DataFrame, day_col: str = "date_day") -> DataFrame:
    d = F.col(day_col)
    return spine.select(
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        dates.month_name_padded(d).alias("month_name"),
        dates.day_name_padded(d).alias("day_name"),
        dates.is_weekend(d).alias("is_weekend"),
    )
