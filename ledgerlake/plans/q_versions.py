"""Driver queries over versioned tables: batches of several rows and their ledger, merges of the
touched buckets, the key registry (O-19, O-21, O-25, O-89, O-93)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import merge, versions
from ledgerlake.plans.registry import query
from ledgerlake.plans.tables import Tables
from ledgerlake.session import scratch_path

# --- fixed values (query parameters) ------------------------------------------------
BATCH_SIZES = (1, 7, 1000)
COMMIT_SIZE = 400
REPEATED_ORDER = 999            # in the third batch of COMMIT_SIZE rows
BUCKETS = 16
# --------------------------------------------------------------------------------------

ORDER_SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("status", T.StringType()),
                             T.StructField("seq", T.LongType())])


def _twice(t):
    """All orders, then all of them again with another status: each key repeats far from itself."""
    o = t.orders.select(F.col("o_orderkey").cast("long").alias("k"), F.col("o_orderstatus").alias("status"))
    return o.withColumn("pass", F.lit(1)).unionByName(o.withColumn("pass", F.lit(2)).withColumn("status", F.concat("status", F.lit("2"))))


@query("batched_upsert_sizes", "O-21 O-19", sql=f"""
SELECT b AS batch_size, o_orderkey AS k, o_orderstatus || '2' AS status, 2 AS "pass"
FROM orders, (SELECT unnest([{', '.join(map(str, BATCH_SIZES))}]) AS b)
""")
def batched_upsert_sizes(spark, sf_dir):
    """Batches of one, seven and a thousand rows: the second pass's batches win."""
    t = Tables(spark, sf_dir)
    out = None
    for size in BATCH_SIZES:
        last = merge.resolve_batches(_twice(t), ["k"], [F.col("pass").asc(), F.col("k").asc()], size)
        last = last.select(F.lit(size).alias("batch_size"), "k", "status", "pass")
        out = last if out is None else out.unionByName(last)
    return out


@query("batched_prefix_commit", "O-21 O-93", sql=f"""
WITH src AS (SELECT o_orderkey AS k, o_orderstatus AS status, row_number() OVER (ORDER BY o_orderkey) AS seq FROM orders),
bad AS (SELECT *, CASE WHEN k = {REPEATED_ORDER} THEN {REPEATED_ORDER - 1} ELSE k END AS key, (seq - 1) // {COMMIT_SIZE} AS b FROM src),
stop AS (SELECT coalesce(min(b), 1000000000) AS b FROM (SELECT key, b FROM bad GROUP BY key, b HAVING count(*) > 1)),
stored AS (SELECT k, 'old' AS status, 0 AS seq FROM src WHERE k % 5 = 0),
kept AS (SELECT key AS k, status, seq FROM bad, stop WHERE bad.b < stop.b)
SELECT 'failed' AS run, k, status, seq, NULL::BIGINT AS committed, NULL::BIGINT AS failed_batch
FROM (SELECT * FROM kept UNION ALL SELECT * FROM stored WHERE k NOT IN (SELECT k FROM kept))
UNION ALL SELECT 'failed ledger', NULL, NULL, NULL, b, b + 1 FROM stop
UNION ALL SELECT 'mended', k, status, seq, NULL, NULL FROM src
UNION ALL SELECT 'mended ledger', NULL, NULL, NULL, (max(seq) - 1) // {COMMIT_SIZE} + 1, NULL FROM src
""")
def batched_prefix_commit(spark, sf_dir):
    """The third batch holds a key twice: the two before it stay, the ledger says so, and the
    mended source goes on from there."""
    t = Tables(spark, sf_dir)
    src = t.orders.select(F.col("o_orderkey").cast("long").alias("k"), F.col("o_orderstatus").alias("status"))
    src = merge.number_batches(src, [F.col("k").asc()], COMMIT_SIZE).drop(merge.BATCH).withColumnRenamed(merge.SEQ, "seq")
    bad = src.withColumn("k", F.when(F.col("k") == REPEATED_ORDER, REPEATED_ORDER - 1).otherwise(F.col("k")))
    table = versions.BucketedTable(versions.VersionLog(spark, scratch_path(spark, "batches")), "orders", ORDER_SCHEMA, ["k"], BUCKETS)
    table.merge(src.where("k % 5 = 0").select("k", F.lit("old").alias("status"), F.lit(0).cast("long").alias("seq")))
    parts = []
    for run, source in (("failed", bad), ("mended", src)):
        try:
            versions.load_in_batches(table, source, [F.col("seq").asc()], "orders", batch_size=COMMIT_SIZE)
        except versions.BatchFailed:
            pass                            # the ledger tells of it
        none = F.lit(None)
        parts.append(table.read().select(F.lit(run).alias("run"), "k", "status", "seq", none.cast("long").alias("committed"),
                                         none.cast("long").alias("failed_batch")))
        parts.append(versions.ledger(table.log).select(
            F.lit(f"{run} ledger").alias("run"), none.cast("long").alias("k"), none.cast("string").alias("status"),
            none.cast("long").alias("seq"), "committed", "failed_batch"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("merge_touched_buckets", "O-19 O-93 O-25", sql="""
WITH inc AS (SELECT min(c_custkey) AS lo FROM customer)
SELECT c_custkey AS k, CASE WHEN c_custkey = lo THEN 'new' ELSE c_mktsegment END AS status, c_nationkey::BIGINT AS seq,
       1::BIGINT AS rewritten FROM customer, inc
UNION ALL SELECT -1, 'added', 0, 2 FROM inc
""")
def merge_touched_buckets(spark, sf_dir):
    """An increment of one stored and one new key rewrites its buckets alone; ``rewritten`` is 2 on
    the added row only where at most two buckets got new files."""
    t = Tables(spark, sf_dir)
    log = versions.VersionLog(spark, scratch_path(spark, "buckets"))
    table = versions.BucketedTable(log, "customer", ORDER_SCHEMA, ["k"], BUCKETS)
    c = t.customer.select(F.col("c_custkey").cast("long").alias("k"), F.col("c_mktsegment").alias("status"),
                          F.col("c_nationkey").cast("long").alias("seq"))
    table.merge(c)
    low = c.agg(F.min("k").alias("k"))
    increment = (c.join(low, "k").withColumn("status", F.lit("new"))
                 .unionByName(spark.createDataFrame([(-1, "added", 0)], ORDER_SCHEMA)))
    touched = table.merge(increment)
    before, after = (log.read(v)["tables"]["customer"]["buckets"] for v in (1, 2))
    new = [b for b in after if after[b] != before.get(b)]
    ok = len(new) <= 2 and sorted(map(int, new)) == touched
    return table.read().withColumn("rewritten", F.when(F.col("k") == -1, F.lit(2 if ok else len(new))).otherwise(F.lit(1)).cast("long"))


@query("dim_keys_three_refreshes", "O-89 M-12", sql="""
WITH k AS (SELECT CAST(s_suppkey AS VARCHAR) AS code, s_suppkey % 4 AS g FROM supplier),
     one AS (SELECT code, row_number() OVER (ORDER BY code) AS id FROM k WHERE g <> 3),
     two AS (SELECT code, (SELECT max(id) FROM one) + row_number() OVER (ORDER BY code) AS id FROM k WHERE g = 3),
     ids AS (SELECT * FROM one UNION ALL SELECT * FROM two)
SELECT 1 AS refresh, code, id FROM ids JOIN k USING (code) WHERE g <> 3
UNION ALL SELECT 2, code, id FROM ids JOIN k USING (code) WHERE g <> 2
UNION ALL SELECT 3, code, id FROM ids JOIN k USING (code)
""")
def dim_keys_three_refreshes(spark, sf_dir):
    """A quarter of the sellers is new in the second refresh, when another one is gone; all are
    there in the third.  Ids follow the registry: none is reused, the returning keep theirs."""
    s = Tables(spark, sf_dir).supplier.select(F.col("s_suppkey").cast("string").alias("code"), (F.col("s_suppkey") % 4).alias("g"))
    registry = versions.KeyRegistry(versions.VersionLog(spark, scratch_path(spark, "registry")), "sellers", ["code"], "id")
    out = None
    for refresh, there in ((1, F.col("g") != 3), (2, F.col("g") != 2), (3, F.lit(True))):
        now = s.where(there).select("code")
        part = now.join(registry.register(now), "code").select(F.lit(refresh).alias("refresh"), "code", "id")
        out = part if out is None else out.unionByName(part)
    return out
