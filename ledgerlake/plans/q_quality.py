"""Driver queries for the data-quality vocabulary (O-94..O-97)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import quality as dq
from ledgerlake.plans.registry import query
from ledgerlake.plans.tables import Tables


def _models(t):
    orders = t.orders.withColumn("prioridad", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return {"orders": orders, "lineitem": t.lineitem, "part": t.part,
            "customer_activo": t.customer.where(F.col("c_acctbal") > 0)}


@query("dq_unique", "O-94", sql="""
SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey HAVING count(*) > 1
""")
def dq_unique(spark, sf_dir):
    return dq.unique_failures(Tables(spark, sf_dir).orders, "o_custkey")


@query("dq_not_null", "O-95", sql="""
SELECT o_orderkey FROM orders WHERE NULLIF(o_orderpriority, '5-LOW') IS NULL
""")
def dq_not_null(spark, sf_dir):
    m = _models(Tables(spark, sf_dir))
    return dq.not_null_failures(m["orders"], "prioridad").select("o_orderkey")


@query("dq_relationships", "O-96", sql="""
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE o.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal > 0 AND c.c_custkey = o.o_custkey)
""")
def dq_relationships(spark, sf_dir):
    m = _models(Tables(spark, sf_dir))
    return dq.relationship_failures(m["orders"], "o_custkey", m["customer_activo"], "c_custkey") \
        .select("o_orderkey", "o_custkey")


CHECKS = [
    dq.Check("unique", "orders", "o_orderkey", dq.ERROR),
    dq.Check("unique", "orders", "o_custkey", dq.WARN),
    dq.Check("not_null", "orders", "prioridad", dq.WARN),
    dq.Check("not_null", "lineitem", "l_partkey", dq.ERROR),
    dq.Check("relationships", "orders", "o_custkey", dq.ERROR, "customer_activo", "c_custkey"),
    dq.Check("relationships", "lineitem", "l_partkey", dq.ERROR, "part", "p_partkey"),
    dq.Check("unique", "lineitem", "l_orderkey", dq.WARN),
]


@query("dq_report", "O-97 O-94 O-95 O-96", sql="""
SELECT 'unique' AS "check", 'orders' AS model, 'o_orderkey' AS "column", 'error' AS severity,
       (SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS failures
UNION ALL SELECT 'unique', 'orders', 'o_custkey', 'warn',
       (SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'not_null', 'orders', 'prioridad', 'warn',
       (SELECT count(*) FROM orders WHERE NULLIF(o_orderpriority, '5-LOW') IS NULL)
UNION ALL SELECT 'not_null', 'lineitem', 'l_partkey', 'error', (SELECT count(*) FROM lineitem WHERE l_partkey IS NULL)
UNION ALL SELECT 'relationships', 'orders', 'o_custkey', 'error',
       (SELECT count(*) FROM orders o WHERE o.o_custkey IS NOT NULL AND NOT EXISTS
          (SELECT 1 FROM customer c WHERE c.c_acctbal > 0 AND c.c_custkey = o.o_custkey))
UNION ALL SELECT 'relationships', 'lineitem', 'l_partkey', 'error',
       (SELECT count(*) FROM lineitem l WHERE l.l_partkey IS NOT NULL AND NOT EXISTS
          (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey))
UNION ALL SELECT 'unique', 'lineitem', 'l_orderkey', 'warn',
       (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
""")
def dq_report(spark, sf_dir):
    return dq.run_checks(CHECKS, _models(Tables(spark, sf_dir)))
