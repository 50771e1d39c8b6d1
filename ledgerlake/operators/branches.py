"""Extracts that read a relation several times, with one scan of it (O-12, O-14, O-48b, O-68)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import cut_lineage

_ROW = "__ll_row"


@dataclass(frozen=True)
class Branch:
    """One SELECT of a UNION: its source table, its WHERE, and a value for each output column."""

    table: str
    where: Column
    values: Mapping[str, Column]


def union_of_branches(tables: Mapping[str, DataFrame], branches: Sequence[Branch], schema: T.StructType,
                      distinct: bool = True) -> DataFrame:
    """UNION (ALL) of branches, each source table read once: a row gives one output row for every
    branch of its table whose condition is true, then all are made distinct at once.  Columns a
    branch does not name are NULL."""
    def row(b: Branch) -> Column:
        unknown = set(b.values) - set(schema.names)
        if unknown:
            raise ValueError(f"branch of {b.table} gives unknown columns {sorted(unknown)}")
        given = [b.values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        return F.when(b.where, F.struct(*given))

    out = None
    for name in dict.fromkeys(b.table for b in branches):
        rows = F.array_compact(F.array(*[row(b) for b in branches if b.table == name]))
        part = tables[name].select(F.inline(rows))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no branches")
    return out.distinct() if distinct else out


def role_lookup(df: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str], columns: Sequence[str],
                required: Sequence[str] = ()) -> DataFrame:
    """Join one dimension under several roles with one scan and one join of it.

    ``roles`` maps a role to the column of ``df`` that holds its key; the result has the columns of
    ``df`` and ``<role>_<column>`` for every role.  Rows whose key is unknown have NULLs there, as in
    a left join, and are dropped where the role is ``required``, as in an inner one.  ``dim_key`` must
    be unique (the job fails where a used key is not).

    The keys of all roles become narrow (row, role, key) rows that meet the dimension together; the
    wide rows are shuffled once, by row number, however many roles there are.
    """
    taken = {f"{r}_{c}" for r in roles for c in columns} & set(df.columns)
    if taken or set(required) - set(roles):
        raise ValueError(f"columns {sorted(taken)} are taken" if taken else f"unknown roles {sorted(set(required) - set(roles))}")
    rows = cut_lineage(df.withColumn(_ROW, F.monotonically_increasing_id()), "roles")      # numbers must not change
    keys = rows.select(_ROW, F.inline(F.array(*[F.struct(F.lit(r).alias("__ll_role"), F.col(k).alias("__ll_key"))
                                                for r, k in roles.items()]))).where(F.col("__ll_key").isNotNull())
    found = keys.join(dim.select(F.col(dim_key).alias("__ll_key"), F.struct(*columns).alias("__ll_found")), "__ll_key")

    def of(role: str, value: Column) -> Column:
        return F.when(F.col("__ll_role") == role, value)

    wide = found.groupBy(_ROW).agg(*[F.first(of(r, F.col("__ll_found")), ignorenulls=True).alias(f"__ll_{r}") for r in roles],
                                   *[F.count(of(r, F.lit(1))).alias(f"__ll_n_{r}") for r in roles])
    out = rows.join(wide, _ROW, "left")
    for r in required:
        out = out.where(F.col(f"__ll_n_{r}") >= 1)
    twice = F.greatest(*[F.col(f"__ll_n_{r}") for r in roles], F.lit(0).cast("long")) > 1
    checked = F.when(twice, F.raise_error(F.lit(f"{dim_key} is not unique in the looked-up relation"))).otherwise(F.lit(True))
    return (out.where(F.coalesce(checked.cast("boolean"), F.lit(True)))
            .select(*df.columns, *[F.col(f"__ll_{r}").getField(c).alias(f"{r}_{c}") for r in roles for c in columns]))
