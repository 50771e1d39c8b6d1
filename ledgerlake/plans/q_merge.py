"""Driver queries for the write semantics: snapshot merges, audit columns, guards and the
incremental refresh loop (O-17..O-24, O-27, O-52, O-93)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions.dates import ntz_literal
from ledgerlake.operators import aggregates, merge
from ledgerlake.operators import transforms as tf
from ledgerlake.plans.registry import query
from ledgerlake.plans.tables import Tables

# --- fixed values (query parameters) ------------------------------------------------
TARGET_SEGMENTS = ("BUILDING", "AUTOMOBILE", "MACHINERY")
SOURCE_SEGMENTS = ("MACHINERY", "HOUSEHOLD")
FIRST_LOAD_TS = dt.datetime(2024, 1, 1, 0, 0, 0)
SECOND_LOAD_TS = dt.datetime(2024, 2, 1, 0, 0, 0)
INITIAL_CUTOFF = dt.datetime(1998, 1, 1, 0, 0, 0)
# --------------------------------------------------------------------------------------

_CTE = """
WITH tgt AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
             WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')),
     src AS (SELECT c_custkey, upper(c_name) AS c_name,
                    CASE WHEN c_nationkey = 3 THEN NULL ELSE c_acctbal + 1 END AS c_acctbal,
                    c_mktsegment
             FROM customer WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD'))
"""


def _target(t):
    return (t.customer.where(F.col("c_mktsegment").isin(*TARGET_SEGMENTS))
            .select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))


def _source(t):
    return (t.customer.where(F.col("c_mktsegment").isin(*SOURCE_SEGMENTS))
            .select("c_custkey", F.upper("c_name").alias("c_name"),
                    F.when(F.col("c_nationkey") == 3, None)
                     .otherwise(F.col("c_acctbal") + 1).alias("c_acctbal"),
                    "c_mktsegment"))


@query("append_snapshot", "O-17 O-20", sql=_CTE + """
SELECT * FROM tgt UNION ALL SELECT * FROM src
""")
def append_snapshot(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return merge.persist(_target(t), _source(t), "insert")


@query("upsert_ignore", "O-18", sql=_CTE + """
SELECT * FROM tgt
UNION ALL
SELECT s.* FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.c_custkey = s.c_custkey)
""")
def upsert_ignore(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return merge.persist(_target(t), _source(t), "ignore", keys=["c_custkey"])


@query("upsert_update", "O-19", sql=_CTE + """
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
FROM tgt t FULL JOIN src s ON t.c_custkey = s.c_custkey
""")
def upsert_update(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return merge.persist(_target(t), _source(t), "update", keys=["c_custkey"],
                         update_cols=["c_name", "c_acctbal"])


def _line_source(t):
    """Lines under a coarser key, so most keys repeat; every 7th order has a NULL key."""
    k = F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.call_function("div", "l_orderkey", F.lit(40)))
    return t.lineitem.select(k.alias("k"), "l_orderkey", "l_linenumber", "l_quantity",
                             (F.col("l_partkey") + F.col("l_suppkey")).alias("payload"))


_LINE_CTE = """
WITH src AS (SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_orderkey // 40 END AS k, l_orderkey, l_linenumber, l_quantity,
                    l_partkey + l_suppkey AS payload FROM lineitem),
     tgt AS (SELECT k, min(l_orderkey) AS l_orderkey, CAST(0 AS INTEGER) AS l_linenumber, min(l_quantity) - 1 AS l_quantity,
                    CAST(-1 AS BIGINT) AS payload FROM src WHERE k % 2 = 0 GROUP BY k)
"""


def _line_target(t):
    return (_line_source(t).where(F.col("k") % 2 == 0).groupBy("k")
            .agg(F.min("l_orderkey").alias("l_orderkey"), F.lit(0).cast("int").alias("l_linenumber"),
                 (F.min("l_quantity") - 1).alias("l_quantity"), F.lit(-1).cast("long").alias("payload")))


LINE_ORDER = ("l_orderkey", "l_linenumber", "payload", "l_quantity")      # total: ties are equal rows
LINE_COLUMNS = ("k", "l_orderkey", "l_linenumber", "l_quantity", "payload")


@query("batched_upsert", "O-21 O-19 O-61", sql="""
WITH seq AS (SELECT *, row_number() OVER (ORDER BY l_linenumber, l_orderkey, l_partkey + l_suppkey, l_quantity) AS n FROM lineitem),
     last AS (SELECT arg_max((l_orderkey, l_linenumber, l_quantity, l_partkey + l_suppkey), n) AS r FROM seq GROUP BY l_orderkey)
SELECT r[1] AS l_orderkey, r[2] AS l_linenumber, r[3] AS l_quantity, r[4] AS payload FROM last
""")
def batched_upsert(spark, sf_dir):
    """An order's lines arrive in line order, each in a later batch: the last line wins."""
    t = Tables(spark, sf_dir)
    src = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_partkey") + F.col("l_suppkey")).alias("payload"))
    return merge.resolve_batches(src, ["l_orderkey"], [F.col(c).asc() for c in ("l_linenumber", "l_orderkey", "payload", "l_quantity")],
                                 batch_size=1, num_partitions=9)


@query("merge_ignore_repeated_keys", "O-18 O-21", sql=_LINE_CTE + """
SELECT k, l_orderkey, l_linenumber, l_quantity, payload FROM tgt
UNION ALL SELECT * FROM src WHERE k IS NULL
UNION ALL
SELECT k, r[1], r[2], r[3], r[4] FROM (
  SELECT k, arg_min((l_orderkey, l_linenumber, l_quantity, payload), (l_orderkey, l_linenumber, payload, l_quantity)) AS r
  FROM src WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM tgt) GROUP BY k)
""")
def merge_ignore_repeated_keys(spark, sf_dir):
    """Repeated and NULL keys: the first row in load order is inserted, NULL keys always."""
    t = Tables(spark, sf_dir)
    return merge.persist(_line_target(t), _line_source(t), "ignore", keys=["k"],
                         order=[F.col(c).asc() for c in LINE_ORDER]).select(*LINE_COLUMNS)


@query("merge_update_repeated_keys", "O-19 O-20 O-21", sql=_LINE_CTE + """
, last AS (SELECT k, arg_max((l_orderkey, l_linenumber, l_quantity, payload), (l_orderkey, l_linenumber, payload, l_quantity)) AS r
           FROM src WHERE k IS NOT NULL GROUP BY k)
SELECT coalesce(t.k, s.k) AS k, coalesce(t.l_orderkey, s.r[1]) AS l_orderkey, coalesce(t.l_linenumber, s.r[2]) AS l_linenumber,
       coalesce(s.r[3], t.l_quantity) AS l_quantity, coalesce(s.r[4], t.payload) AS payload
FROM tgt t FULL JOIN last s ON s.k = t.k
UNION ALL SELECT * FROM src WHERE k IS NULL
""")
def merge_update_repeated_keys(spark, sf_dir):
    """Repeated and NULL keys: one row a batch, so the last row in load order updates."""
    t = Tables(spark, sf_dir)
    return merge.persist(_line_target(t), _line_source(t), "update", keys=["k"], update_cols=["l_quantity", "payload"],
                         order=[F.col(c).asc() for c in LINE_ORDER], batch_size=1).select(*LINE_COLUMNS)


@query("update_only", "O-22", sql=_CTE + """
SELECT t.c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       t.c_mktsegment
FROM tgt t LEFT JOIN src s ON t.c_custkey = s.c_custkey
""")
def update_only(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return merge.update_only(_target(t), _source(t), "c_custkey",
                             {"c_name": "c_name", "c_acctbal": "c_acctbal"}, update_date_col=None)


@query("nan_to_null", "O-23", sql="""
WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value END AS value
           FROM events)
SELECT event_id, CASE WHEN isnan(value) THEN NULL ELSE value END AS value FROM e
""")
def nan_to_null(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(float("nan")))
                     .otherwise(F.col("value")).alias("value"))
    return tf.nan_to_null_columns(e)


@query("audit_columns", "O-24", sql=_CTE + """
, tgt_a AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS creation_date,
                   TIMESTAMP '2024-01-01 00:00:00' AS update_date FROM tgt)
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.creation_date ELSE TIMESTAMP '2024-02-01 00:00:00' END AS creation_date,
       CASE WHEN s.c_custkey IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE t.update_date END AS update_date
FROM tgt_a t FULL JOIN src s ON t.c_custkey = s.c_custkey
""")
def audit_columns(spark, sf_dir):
    t = Tables(spark, sf_dir)
    target = merge.with_audit_columns(_target(t), FIRST_LOAD_TS)
    return merge.upsert(target, _source(t), ["c_custkey"], update_cols=["c_name", "update_date"],
                        load_ts=SECOND_LOAD_TS, audit=True)


@query("load_once_guard", "O-27 O-61c", sql=_CTE + """
SELECT 'empty_target' AS scenario, c_custkey, c_name FROM src
UNION ALL
SELECT 'loaded_target' AS scenario, c_custkey, c_name FROM tgt
""")
def load_once_guard(spark, sf_dir):
    t = Tables(spark, sf_dir)
    src = _source(t).select("c_custkey", "c_name")
    empty = t.customer.where(F.col("c_mktsegment") == "NONE").select("c_custkey", "c_name")
    loaded = _target(t).select("c_custkey", "c_name")
    return (merge.load_once(empty, src).withColumn("scenario", F.lit("empty_target"))
            .unionByName(merge.load_once(loaded, src).withColumn("scenario", F.lit("loaded_target"))))


@query("incremental_refresh", "O-93 O-52 O-09 O-19 M-20", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice FROM orders
""")
def incremental_refresh(spark, sf_dir):
    """Full load up to a cutoff, then one incremental run driven by the stored high-water
    mark (re-reading the boundary, so the merge sees conflicts) == one full load."""
    t = Tables(spark, sf_dir)
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice"]
    orders = t.orders.select(*cols)
    empty = orders.where(F.lit(False))
    # run 1: empty target -> NULL mark -> everything up to the cutoff the extract holds
    extract1 = orders.where(F.col("o_orderdate") <= ntz_literal(INITIAL_CUTOFF))
    first = merge.persist(empty, extract1.where(aggregates.after_watermark(
        "o_orderdate", aggregates.high_water_mark(empty, "o_orderdate"))), "update", keys=["o_orderkey"])
    # run 2: stored mark, boundary re-read (inclusive) so the merge sees conflicts
    hwm = aggregates.high_water_mark(first, "o_orderdate")
    increment = orders.where(aggregates.after_watermark("o_orderdate", hwm, inclusive=True))
    return merge.persist(first, increment, "update", keys=["o_orderkey"])
