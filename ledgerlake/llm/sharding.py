"""Proportional stratified interleaving: shards that all match the source mixture.

Within each source the rows are ranked in a seeded random order; the rank as a fraction of the
source's size spreads every source evenly over the unit interval; the rows sorted by fraction
are cut into equal runs.  Any run of that order holds each source in proportion (to within one
row), and runs differ by at most one row.

Both orders are range-partitioned parallel sorts over narrow rows, so a source with a third of
all rows is split like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ident
from ledgerlake.operators.keys import global_row_number
from ledgerlake.session import cut_lineage

SHARDS = 8
SEED = 11


def interleave(rows: DataFrame, source_col: str = "source", tie_cols: tuple[str, ...] = ("doc_id",),
               shards: int = SHARDS, seed: int = SEED, num_partitions: int | None = None) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in each shard).

    ``tie_cols`` seed and settle the order; rows equal in source and all of them are
    interchangeable.  A null source is a stratum of its own and null ties sort first; fewer rows
    than shards leave shards empty; an empty table gives an empty result.  Column names that
    start with ``__llm_`` are reserved; columns named shard or slot are replaced.
    """
    rows = rows.drop("shard", "slot")
    ties = [ident(c) for c in tie_cols]
    first = rows.withColumn("__llm_mix", F.xxhash64(F.lit(seed), *ties))
    source = ident(source_col)
    ranked = global_row_number(first, [source.asc_nulls_first(), F.col("__llm_mix").asc(),
                                       *[t.asc_nulls_first() for t in ties]],
                               "__llm_rank", start=0, num_partitions=num_partitions)
    # one row a source: where it begins in the order and how many rows it has
    strata = cut_lineage(ranked.groupBy(source.alias("__llm_source"))
                         .agg(F.min("__llm_rank").alias("__llm_first"), F.count(F.lit(1)).alias("__llm_n")),
                         "shard-strata")
    total = strata.agg(F.sum("__llm_n")).first()[0] or 0
    spread = (ranked.join(strata, source.eqNullSafe(F.col("__llm_source")))
              .withColumn("__llm_part", (2 * (F.col("__llm_rank") - F.col("__llm_first")) + 1).cast("double")
                          / (2 * F.col("__llm_n"))))
    placed = global_row_number(spread.drop("__llm_rank", "__llm_source", "__llm_n"),
                               [F.col("__llm_part").asc(), F.xxhash64(F.lit(seed), F.col("__llm_first")).asc(),
                                F.col("__llm_first").asc()],
                               "__llm_at", start=0, num_partitions=num_partitions)
    # exact in integers: a shard begins at the ceiling of shard * total / shards
    shard = F.expr(f"(__llm_at * {shards}) div {max(total, 1)}")
    begin = F.expr(f"((__llm_at * {shards}) div {max(total, 1)} * {total} + {shards - 1}) div {shards}")
    return placed.select(*[ident(c) for c in rows.columns], shard.cast("int").alias("shard"),
                         (F.col("__llm_at") - begin).alias("slot"))
