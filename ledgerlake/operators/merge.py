"""Write semantics of the loaders, as snapshot merges.

Spark's built-in Parquet tables have no row-level MERGE, so every load returns the *new
snapshot* of the target as a DataFrame: ``target ⟗ source`` on the conflict keys, one
shuffle per side on the keys, no driver loop, no batches.  Persist it with
``write_snapshot`` to a new location (never overwrite a path that the plan still reads).

Modes (O-17..O-22):
* ``append``        INSERT: target ∪ source
* ``insert_ignore`` ON CONFLICT DO NOTHING: target ∪ (source ▷ target)
* ``upsert``        ON CONFLICT DO UPDATE SET update_cols = excluded.* (a NULL in the
                    source overwrites: presence is tracked with a flag, not coalesce)
* ``update_only``   UPDATE ... FROM: matched rows change, nothing is inserted
NULL keys never match (SQL ``=``), so such rows are inserted again (T-12).
"""

from __future__ import annotations

from collections.abc import Sequence
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import ntz_literal
from ledgerlake.operators.transforms import nan_to_null_columns, require_columns

CREATION_COL = "creation_date"
UPDATE_COL = "update_date"
_S = "__ll_in_source"
_T = "__ll_in_target"
SEQ = "__ll_seq"
BATCH = "__ll_batch"


class PersistMode(str, Enum):
    INSERT = "insert"
    IGNORE = "ignore"
    UPDATE = "update"


def _lit_ts(load_ts) -> Column:
    if isinstance(load_ts, Column):
        return load_ts
    if load_ts is None:
        return F.localtimestamp()
    return ntz_literal(load_ts)


def with_audit_columns(df: DataFrame, load_ts=None) -> DataFrame:
    """Server-default audit columns on insert (O-24)."""
    ts = _lit_ts(load_ts)
    return df.withColumns({CREATION_COL: ts, UPDATE_COL: ts})


def _any_null(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        cond = F.col(k).isNull() if cond is None else cond | F.col(k).isNull()
    return cond


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys are all non-NULL, rows with a NULL key).

    A NULL key never matches under ``=`` (T-12), so those rows bypass the merge join:
    otherwise every one of them hashes to the same shuffle partition — one task holding
    all of them, a skew that AQE cannot split in a full outer join.
    """
    nulls = _any_null(keys)
    return df.where(~nulls), df.where(nulls)


def append(target: DataFrame | None, source: DataFrame) -> DataFrame:
    if target is None:
        return source
    return target.unionByName(source, allowMissingColumns=True)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  order: Sequence[Column] | None = None) -> DataFrame:
    """ON CONFLICT DO NOTHING.  A key repeated inside the source is inserted once, by its
    first row in load ``order`` (a total order), as the database keeps the first row of
    the statement and skips the later ones; without ``order`` the source keys are taken
    to be unique (a DataFrame has no statement order to pick "first" from)."""
    keys = list(keys)
    require_columns(source, keys, "conflict columns")
    src, src_null = split_null_keys(source, keys)
    if order is not None:
        from ledgerlake.operators.dedup import keep_first
        src = keep_first(src, keys, list(order))
    tgt = target.where(~_any_null(keys))
    fresh = src.join(tgt, [src[k] == tgt[k] for k in keys], "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True).unionByName(src_null, allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, load_ts=None,
           audit: bool = False, reject_repeated_keys: bool = False) -> DataFrame:
    """INSERT .. ON CONFLICT (keys) DO UPDATE SET update_cols (O-19).

    ``reject_repeated_keys=True`` fails the query (inside the job) when the source repeats
    a non-NULL key, as the database refuses to update one row twice in a statement; off
    by default because it adds a grouping of the source (``resolve_batches`` applies the
    same rule per batch)."""
    keys = list(keys)
    require_columns(source, keys, "conflict columns")
    require_columns(target, keys, "conflict columns")
    if update_cols is None:
        update_cols = [c for c in source.columns if c not in keys]
    update_cols = list(update_cols)
    ts = _lit_ts(load_ts)
    target, target_null = split_null_keys(target, keys)
    source, source_null = split_null_keys(source, keys)
    if reject_repeated_keys:
        from ledgerlake.operators.joins import expect_unique
        source = expect_unique(source, keys, "upsert source")
    t = target.withColumn(_T, F.lit(True)).alias("t")
    s = source.withColumn(_S, F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full")
    in_s = F.col(f"s.{_S}").isNotNull()
    in_t = F.col(f"t.{_T}").isNotNull()
    out_cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    sel = []
    for c in out_cols:
        tc = F.col(f"t.{c}") if c in target.columns else F.lit(None)
        sc = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        if c in keys:
            e = F.when(in_t, tc).otherwise(sc)
        elif audit and c == CREATION_COL:
            e = F.when(in_t, tc).otherwise(ts)
        elif audit and c == UPDATE_COL:
            e = F.when(in_s & (~in_t | F.lit(UPDATE_COL in update_cols)), ts).otherwise(tc)
        elif c in update_cols:
            e = F.when(in_s, sc).otherwise(tc)
        else:
            e = F.when(in_t, tc).otherwise(sc)
        sel.append(e.alias(c))
    merged = joined.select(*sel)
    # NULL-key rows: stored ones stay, incoming ones are inserted (audited like inserts)
    inserted_null = source_null
    if audit and CREATION_COL in out_cols:
        inserted_null = inserted_null.withColumns({CREATION_COL: ts, UPDATE_COL: ts})
    return (merged.unionByName(target_null.select(*[c for c in target.columns]), allowMissingColumns=True)
            .unionByName(inserted_null, allowMissingColumns=True).select(*out_cols))


def update_only(target: DataFrame, source: DataFrame, key: str, set_cols: dict[str, str],
                load_ts=None, update_date_col: str | None = UPDATE_COL,
                last_by: Sequence[str] | None = None) -> DataFrame:
    """UPDATE target SET col = source.col .. WHERE key matches; never inserts (O-22).

    ``set_cols`` maps target column -> source column.  The source loader runs one UPDATE
    per source row in load order, so for a repeated key the last row wins: pass the
    load-order columns as ``last_by`` (together unique).  Without it the source keys are
    taken to be unique.
    """
    tgt, tgt_null = split_null_keys(target, [key])
    src = source.where(F.col(key).isNotNull())
    if last_by:
        from ledgerlake.operators.dedup import keep_first
        src = keep_first(src, [key], [F.col(c).desc_nulls_first() for c in last_by])
    s = src.select(
        F.col(key).alias("__ll_key"), F.lit(True).alias(_S),
        *[F.col(v).alias(f"__ll_src_{k}") for k, v in set_cols.items()])
    joined = tgt.join(s, tgt[key] == s["__ll_key"], "left")
    hit = F.col(_S).isNotNull()
    sets = {k: F.when(hit, F.col(f"__ll_src_{k}")).otherwise(F.col(k)) for k in set_cols}
    if update_date_col and update_date_col not in set_cols:
        sets[update_date_col] = F.when(hit, _lit_ts(load_ts)).otherwise(F.col(update_date_col))
    return joined.withColumns(sets).select(*target.columns).unionByName(tgt_null)


def number_batches(source: DataFrame, order: Sequence[Column], batch_size: int,
                   num_partitions: int | None = None) -> DataFrame:
    """Rows numbered in extract ``order`` (a total order) and cut into batches, from 0.  The number
    is a parallel global row number, not a driver loop."""
    from ledgerlake.operators.keys import global_row_number
    numbered = global_row_number(source, order, SEQ, num_partitions=num_partitions)
    return numbered.withColumn(BATCH, F.call_function("div", F.col(SEQ) - 1, F.lit(batch_size)))


def _present(keys: Sequence[str]) -> Column:
    return ~_any_null(keys)


def failing_batch(batched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the first batch that holds a key twice (NULL: none).  Only keys and batch numbers
    are shuffled."""
    twice = (batched.where(_present(keys)).groupBy(*keys, BATCH).agg(F.count(F.lit(1)).alias("__ll_n"))
             .where(F.col("__ll_n") > 1))
    return twice.agg(F.min(BATCH).alias(BATCH))


def latest_rows(batched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row of each key in load order, and all rows with a NULL key; numbers dropped.  The
    last row is a partial aggregate, so a key with many rows reaches its reducer as one a task."""
    rest = [c for c in batched.columns if c not in (*keys, SEQ, BATCH)]
    columns = [c for c in batched.columns if c not in (SEQ, BATCH)]
    last = (batched.where(_present(keys)).groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest], F.col(SEQ)), F.col(SEQ)).alias("__ll_row")))
    return (last.select(*[F.col(f"`{c}`") if c in keys else F.col("__ll_row").getField(c).alias(c) for c in columns])
            .unionByName(batched.where(~_present(keys)).drop(SEQ, BATCH)))


def last_by_columns(source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ascending ``order`` columns (NULLs first), and all rows with a NULL
    key.  A partial aggregate: one row a key and task is shuffled, and no row is numbered."""
    lead = [c for c in order if c not in keys]
    rest = [c for c in source.columns if c not in (*keys, *lead)]
    last = (source.where(_present(keys)).groupBy(*keys)
            .agg(F.max(F.struct(*[F.col(f"`{c}`") for c in (*lead, *rest)])).alias("__ll_row")))
    return (last.select(*[F.col(f"`{c}`") if c in keys else F.col("__ll_row").getField(c).alias(c) for c in source.columns])
            .unionByName(source.where(~_present(keys))))


def resolve_batches(source: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                    batch_size: int = 10_000, num_partitions: int | None = None) -> DataFrame:
    """Reproduce the batched loader in one plan (O-21): rows are cut into batches of
    ``batch_size`` in extract ``order`` (a total order); a key repeated inside one batch
    fails the load (the database rejected such a batch), across batches the later batch
    wins.  ``versions.load_in_batches`` keeps the batches before a failing one instead.

    A row with a NULL in its key never conflicts (a UNIQUE constraint treats NULLs as
    distinct, T-12): such rows are numbered with the others, so the batch boundaries do
    not move, and then bypass the duplicate check and the keep-last.

    ``order`` may be column names (ascending, NULLs first).  Batches of one row then need no numbers:
    the last row of a key is its greatest by those columns (all columns must be orderable)."""
    keys = list(keys)
    if batch_size == 1 and all(isinstance(c, str) for c in order):
        return last_by_columns(source, keys, order)      # no batch can hold a key twice
    order = [F.col(c).asc() if isinstance(c, str) else c for c in order]
    batched = number_batches(source, order, batch_size, num_partitions)
    last = latest_rows(batched, keys)
    if batch_size == 1:                     # no batch can hold a key twice
        return last
    refused = failing_batch(batched, keys).scalar()
    k = keys[0]
    return last.withColumn(k, F.when(refused.isNull(), F.col(k)).otherwise(
        F.raise_error(F.lit("duplicate conflict key inside one load batch")).cast(source.schema[k].dataType)))


def persist(target: DataFrame | None, source: DataFrame, mode: PersistMode | str,
            keys: Sequence[str] | None = None, update_cols: Sequence[str] | None = None,
            load_ts=None, audit: bool = False, order: Sequence[Column | str] | None = None,
            batch_size: int = 10_000) -> DataFrame:
    """One entry point for the three persistence modes with the loader's guards
    (O-20, O-98): bad mode, missing conflict columns -> ValueError; NaN -> NULL first.

    At most one source row per non-NULL key reaches the merge, so a repeated key never
    multiplies rows.  With ``order`` (a total order: the load order) the source is resolved as
    the batched loader does (O-21): IGNORE keeps the first row of a key, UPDATE the row of the
    latest batch, and a key repeated inside one UPDATE batch fails the job.  Without it any
    repeated key fails the job, in both modes."""
    if not isinstance(source, DataFrame):
        raise ValueError("source must be a DataFrame")
    mode = PersistMode(mode)
    src = nan_to_null_columns(source)
    if mode == PersistMode.INSERT:
        return append(target, src)
    if not keys:
        raise ValueError(f"mode {mode.value} needs conflict columns")
    keys = list(keys)
    require_columns(src, keys, "conflict columns")
    if mode == PersistMode.IGNORE:
        if order is None:
            src = unique_keys(src, keys)
        return insert_ignore(target, src, keys, order)
    src = unique_keys(src, keys) if order is None else resolve_batches(src, keys, order, batch_size)
    return upsert(target, src, keys, update_cols, load_ts, audit)


def unique_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source; the job fails when a key without NULL parts repeats (T-12: a key with a NULL
    part never conflicts)."""
    from ledgerlake.operators.joins import expect_unique
    keyed, null_keyed = split_null_keys(source, list(keys))
    return expect_unique(keyed, list(keys), "merge source").unionByName(null_keyed)


def load_once(target: DataFrame, source: DataFrame) -> DataFrame:
    """Load only when the target is empty (O-27), as one lazy plan:
    ``target ∪ (source WHERE NOT EXISTS (SELECT 1 FROM target))``."""
    return target.unionByName(source.where(~target.exists()), allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (the reference's database would raise).  A key
    with a NULL part is never a duplicate, as under a UNIQUE constraint (T-12)."""
    keyed = df.dropna(how="any", subset=list(keys))
    return (keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate conflict keys {list(keys)} in one load")


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                   max_records_per_file: int | None = None) -> None:
    """Full-refresh materialisation to a fresh path (O-25)."""
    w = df.write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed_snapshot(df: DataFrame, table: str, keys: Sequence[str], buckets: int,
                            in_bucket_layout: bool = False) -> None:
    """Store a merge target bucketed and sorted by its conflict keys.

    The next ``upsert`` joins the snapshot on those keys without shuffling it: only the
    (small) increment is exchanged into the bucket layout.  Write each snapshot under a
    new table name and swap, never overwrite the table the merge reads.

    A frame in another layout is first hash-partitioned into ``buckets`` tasks, so each
    task writes one bucket file (otherwise every upstream task writes a file into every
    bucket).  The result of ``upsert`` against a bucketed snapshot is already in the
    layout (each merge task holds one bucket; the few NULL-key rows add a few files):
    pass ``in_bucket_layout=True`` to skip that shuffle of the whole target.
    """
    out = df if in_bucket_layout else df.repartition(buckets, *keys)
    (out.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .format("parquet").saveAsTable(table))


def materialize_table(df: DataFrame, name: str) -> None:
    """``+materialized: table`` -> ``saveAsTable`` overwrite (O-25, O-28)."""
    df.write.mode("overwrite").saveAsTable(name)


def materialize_view(df: DataFrame, name: str) -> None:
    """``+materialized: view`` -> a (temporary) view over the lazy plan (O-26)."""
    df.createOrReplaceTempView(name)
