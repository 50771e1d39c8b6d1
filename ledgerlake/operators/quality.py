"""Declarative data-quality checks (O-94..O-97).

Each check is a small aggregation; ``run_checks`` unions them into one report frame
``(check, model, column, severity, failures)`` — one row per check, so collecting it is
bounded by the number of checks, not by the data.  ``report_in_steps`` gives the same report of many
checks: it runs a few of them at a time.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlake.session import cut_lineage, measured_broadcasts

ERROR = "error"
WARN = "warn"
#: Steps of ``report_in_steps`` under way at a time.
AT_ONCE = 3


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Duplicated non-NULL values of ``column`` (one row per value)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def relationship_failures(child: DataFrame, column: str, parent: DataFrame,
                          parent_column: str) -> DataFrame:
    """Non-NULL child values with no parent row."""
    c = child.where(F.col(column).isNotNull())
    return c.join(parent, c[column] == parent[parent_column], "left_anti")


@dataclass(frozen=True)
class Check:
    kind: str                       # unique | not_null | relationships
    model: str
    column: str
    severity: str = ERROR
    parent: str | None = None       # model name of the parent (relationships)
    parent_column: str | None = None


def failures(check: Check, models: dict[str, DataFrame]) -> DataFrame:
    df = models[check.model]
    if check.kind == "unique":
        return unique_failures(df, check.column)
    if check.kind == "not_null":
        return not_null_failures(df, check.column)
    if check.kind == "relationships":
        return relationship_failures(df, check.column, models[check.parent], check.parent_column)
    raise ValueError(f"unknown check {check.kind}")


def _report_row(ch: Check, failures_col):
    return [F.lit(ch.kind).alias("check"), F.lit(ch.model).alias("model"), F.lit(ch.column).alias("column"),
            F.lit(ch.severity).alias("severity"), failures_col.cast("long").alias("failures")]


def _n_rows(df: DataFrame, copies: str | None, condition=None):
    """Rows (where a condition holds), each counted as often as its ``copies`` say."""
    if copies is None:
        return F.count(F.lit(1)) if condition is None else F.count_if(condition)
    return F.coalesce(F.sum(df[copies] if condition is None else F.when(condition, df[copies])), F.lit(0))


def _repeated_values(df: DataFrame, column: str, copies: str | None = None) -> DataFrame:
    """One row: values of the column that occur more than once.  Only this column is read, and
    shuffled as the type it has."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(_n_rows(df, copies).alias("n"))
    return counted.agg(F.count_if(F.col("n") > 1).alias("__ll_dup"))


def _orphan_rows(child: DataFrame, ch: Check, models: dict[str, DataFrame], copies: str | None = None) -> DataFrame:
    """One row: child rows without a parent.  The different values of the child's column meet the
    parent, not its rows."""
    values = (child.where(F.col(ch.column).isNotNull()).groupBy(F.col(ch.column).alias("__ll_value"))
              .agg(_n_rows(child, copies).alias("n")))
    parent = models[ch.parent].select(F.col(ch.parent_column).alias("__ll_key"))
    orphans = values.join(parent, F.col("__ll_value") == F.col("__ll_key"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("__ll_orphans"))


def write_counting_nulls(df: DataFrame, columns: Sequence[str], name: str) -> tuple[DataFrame, dict[str, int]]:
    """``cut_lineage`` and the number of NULLs of some columns, counted while the rows are written.

    The count sits right before the write, in the job's last stage, where Spark takes the figures
    of one finished attempt a task: a lost executor does not make it higher.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        return cut_lineage(df, name), {}
    seen = Observation(f"nulls-{uuid.uuid4().hex}")
    out = cut_lineage(df.observe(seen, *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]), name)
    found = seen.get
    return out, {c: found[f"n{i}"] for i, c in enumerate(columns)}


def run_checks(checks: Sequence[Check], models: dict[str, DataFrame],
               null_counts: dict[tuple[str, str], int] | None = None,
               copies: dict[str, str] | None = None) -> DataFrame:
    """One report row per check.  All not-null checks of a model share one scan; a unique check or a
    relationship reads its own column alone.  ``null_counts`` holds the NULLs of (model, column)
    known from writing the model: those checks read nothing.  ``copies``: the column of a model that
    says how many equal rows a row stands for."""
    known, copies = null_counts or {}, copies or {}
    by_model: dict[str, list[Check]] = {}
    relations: list[Check] = []
    for ch in checks:
        if ch.kind not in ("unique", "not_null", "relationships"):
            raise ValueError(f"unknown check {ch.kind}")
        (relations if ch.kind == "relationships" else by_model.setdefault(ch.model, [])).append(ch)
    frames = []
    for model, chs in by_model.items():
        unique = list(dict.fromkeys(ch.column for ch in chs if ch.kind == "unique"))
        filled = list(dict.fromkeys(ch.column for ch in chs if ch.kind == "not_null" and (model, ch.column) not in known))
        df, n = models[model], copies.get(model)
        for column in unique:
            rows = [F.struct(*_report_row(ch, F.col("__ll_dup"))) for ch in chs if ch.kind == "unique" and ch.column == column]
            frames.append(_repeated_values(df, column, n).select(F.inline(F.array(*rows))))
        if filled:
            # only rows with a NULL are counted, so the condition goes below joins and down to the scan
            some = df.where(functools.reduce(lambda a, b: a | b, [F.col(c).isNull() for c in filled]))
            counts = some.agg(*[_n_rows(some, n, F.col(c).isNull()).alias(f"__ll_{c}") for c in filled])
            rows = [F.struct(*_report_row(ch, F.col(f"__ll_{ch.column}"))) for ch in chs if ch.kind == "not_null" and ch.column in filled]
            frames.append(counts.select(F.inline(F.array(*rows))))
    for ch in relations:
        counts = _orphan_rows(models[ch.model], ch, models, copies.get(ch.model))
        frames.append(counts.select(*_report_row(ch, F.col("__ll_orphans"))))
    written = [F.struct(*_report_row(ch, F.lit(known[ch.model, ch.column])))
               for ch in checks if ch.kind == "not_null" and (ch.model, ch.column) in known]
    if written:
        spark = next(iter(models.values())).sparkSession
        frames.append(spark.range(1).select(F.inline(F.array(*written))))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def steps(checks: Sequence[Check], null_counts: dict[tuple[str, str], int] | None = None) -> list[list[Check]]:
    """Checks in the groups that ``run_checks`` counts by one query: those with known NULLs, the other
    not-null checks of a model, the unique checks of a column, a relationship."""
    out: dict[tuple, list[Check]] = {}
    for ch in checks:
        if ch.kind == "not_null":
            key = ("known",) if (ch.model, ch.column) in (null_counts or {}) else (ch.kind, ch.model)
        else:
            key = (ch.kind, ch.model, ch.column, ch.parent, ch.parent_column)
        out.setdefault(key, []).append(ch)
    return list(out.values())


def report_in_steps(checks: Sequence[Check], models: dict[str, DataFrame],
                    null_counts: dict[tuple[str, str], int] | None = None,
                    copies: dict[str, str] | None = None) -> DataFrame:
    """``run_checks``, counted while the report is set up: ``AT_ONCE`` steps run at a time and the report
    holds their counts (one row a check).

    As one plan, all checks start their stages and broadcasts together, and every finished stage posts the
    whole plan anew: the driver holds all of that.  Here it holds what a few checks need, and no side of a
    join is broadcast by an estimate (``measured_broadcasts``)."""
    spark = next(iter(models.values())).sparkSession
    count = inheritable_thread_target(spark)(lambda step: run_checks(step, models, null_counts, copies).collect())
    with measured_broadcasts(spark), ThreadPoolExecutor(AT_ONCE) as pool:
        found = [r for rows in pool.map(count, steps(checks, null_counts)) for r in rows]
    rows = [F.struct(*_report_row(Check(r["check"], r["model"], r["column"], r["severity"]), F.lit(r["failures"]))) for r in found]
    return spark.range(1).select(F.inline(F.array(*rows)))


def enforce(report: DataFrame) -> list:
    """Raise if any error-severity check failed; return warn rows (bounded collect)."""
    rows = report.where(F.col("failures") > 0).collect()
    errors = [r for r in rows if r["severity"] == ERROR]
    if errors:
        raise AssertionError("data-quality errors: " + ", ".join(
            f"{r['check']}({r['model']}.{r['column']})={r['failures']}" for r in errors))
    return rows
