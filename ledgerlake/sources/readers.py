"""Typed readers: Parquet tables, SQL/JDBC extracts with bind parameters, CSV files, seeds.

Schemas are declared, never inferred.  Filters and projections are written on the
DataFrame so Catalyst pushes them into the scan (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources.fs import exists as path_exists

# --- fixed values --------------------------------------------------------------------
# Strings pandas' CSV reader turns into missing values by default (subset that occurs
# in hand-edited seed files).
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                    "n/a", "nan", "null")
# Above this many literals an IN-list becomes a semi join against a small frame.
IN_LIST_JOIN_THRESHOLD = 1000
# --------------------------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               where: Column | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def sql_extract(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """Run a query with named ``:name`` parameters bound by Spark (O-01).

    Errors propagate (the reference turned them into an empty frame, T-15).
    """
    return spark.sql(query, args=params or {})


def jdbc_extract(spark: SparkSession, url: str, query: str, properties: dict | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Parallel JDBC read of a source query (O-01); needs a driver jar and a server."""
    reader = (spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size))
    if partition_column:
        reader = (reader.option("dbtable", f"({query}) src")
                  .option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions or 8))
    else:
        reader = reader.option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def in_list_filter(df: DataFrame, column: str, values, negate: bool = False) -> DataFrame:
    """``col IN (...)`` / ``NOT IN`` for a list parameter (O-02, O-38), one meaning at every length.

    A NULL in the list never matches; ``NOT IN`` a list that holds a NULL gives no rows; ``NOT IN``
    a list without one drops NULL operands; ``IN`` the empty list gives no rows and ``NOT IN`` the
    empty list keeps all, NULL operands included (as with an empty subquery).  Only the plan
    depends on the length: short lists are literals (pushed into the scan), long ones a
    semi/anti join whose strategy Spark picks from the sizes.
    """
    given = list(values)
    values = [v for v in given if v is not None]
    if negate and len(values) < len(given):
        return df.where(F.lit(False))
    if not values:
        return df if negate else df.where(F.lit(False))
    if len(values) <= IN_LIST_JOIN_THRESHOLD:
        cond = F.col(column).isin(values)
        return df.where(~cond if negate else cond)
    dtype = df.schema[column].dataType
    vals = df.sparkSession.createDataFrame([(v,) for v in values], T.StructType([T.StructField("__ll_v", dtype)]))
    if negate:
        df = df.where(F.col(column).isNotNull())
    return df.join(vals, df[column] == vals["__ll_v"], "left_anti" if negate else "left_semi")


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


class CsvHeaderError(ValueError):
    """A CSV header that lacks a declared column, holds an unknown one, or names one twice."""


def _csv_reader(spark: SparkSession, sep: str, multiline: bool):
    """RFC 4180: fields may be quoted, a quote inside one is doubled, and a quoted field may hold
    separators and line breaks.  A byte order mark is skipped."""
    return (spark.read.option("sep", sep).option("encoding", "UTF-8").option("quote", '"').option("escape", '"')
            .option("multiLine", multiline).option("maxCharsPerColumn", -1))


def csv_header(spark: SparkSession, path: str, sep: str = ",", multiline: bool = True) -> list[str]:
    """The names in the first line, as written; [] for a file without one."""
    first = _csv_reader(spark, sep, multiline).option("header", False).csv(path).first() if path_exists(spark, path) else None
    return [] if first is None else [c or "" for c in first]


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ",",
             unknown: str = "error", multiline: bool = True) -> DataFrame:
    """All-string CSV with a header; ``columns`` are bound by trimmed header name, whatever their
    order in the file (None: all columns of the file, in its order).

    A declared column that the header lacks, a name that it holds twice and, unless
    ``unknown="ignore"``, a column that is not declared raise ``CsvHeaderError`` before any row is
    read; a second file of the folder with another header fails the job (Spark compares every
    file's header with the first one's).  Empty fields are NULL.  ``multiline=False`` lets Spark
    split large files, for data known to hold no line breaks inside quotes.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    raw = csv_header(spark, path, sep, multiline)
    names = [c.strip("\ufeff").strip() for c in raw]
    repeated = sorted({c for c in names if names.count(c) > 1})
    wanted = list(names if columns is None else columns)
    missing = [c for c in wanted if c not in names]
    extra = [c for c in names if c not in wanted]
    if repeated or missing or (extra and unknown == "error"):
        raise CsvHeaderError(f"{path}: header {names}, repeated {repeated}, missing {missing}, unknown {extra}")
    if not raw:
        return spark.createDataFrame([], string_schema(wanted))
    df = (_csv_reader(spark, sep, multiline).option("header", True).option("enforceSchema", False)
          .schema(string_schema(raw)).csv(path)).toDF(*names)
    return df.select(*[F.col(f"`{c}`") for c in wanted])


def _missing_to_null(df: DataFrame, na_tokens: Sequence[str]) -> DataFrame:
    tokens = list(na_tokens)
    return df.select(*[F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c) for c in df.columns])


def csv_strict(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               na_tokens: Sequence[str] = PANDAS_NA_TOKENS, multiline: bool = True) -> DataFrame:
    """All-string CSV with a header (O-03): missing file -> FileNotFoundError, no data rows ->
    ValueError, header other than declared -> CsvHeaderError; pandas' NA spellings become NULL."""
    df = read_csv(spark, path, columns, multiline=multiline)
    if df.isEmpty():
        raise ValueError(f"CSV without rows: {path}")
    return _missing_to_null(df, na_tokens)


def csv_lenient(spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ",",
                na_tokens: Sequence[str] = PANDAS_NA_TOKENS, multiline: bool = True) -> DataFrame:
    """All-string CSV with a separator (O-04): undeclared columns are passed over, no rows are no
    error; pandas' NA spellings become NULL."""
    return _missing_to_null(read_csv(spark, path, columns, sep, unknown="ignore", multiline=multiline), na_tokens)


def read_seed(spark: SparkSession, path: str, schema: T.StructType, unknown: str = "error") -> DataFrame:
    """Typed seed CSV (O-05): columns are bound by name, a byte order mark and blanks around header
    names and values are dropped."""
    raw = read_csv(spark, path, [f.name for f in schema.fields], unknown=unknown)
    return raw.select(*[_seed_cast(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields])


def _seed_cast(c: Column, dtype: T.DataType) -> Column:
    c = F.nullif(F.trim(c), F.lit(""))
    if isinstance(dtype, T.BooleanType):
        return F.lower(c).isin("true", "t", "1", "yes", "y")
    return c.cast(dtype)
