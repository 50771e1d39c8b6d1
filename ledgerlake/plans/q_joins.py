"""Driver queries for the join patterns (O-48..O-51)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators import joins
from ledgerlake.plans.registry import query
from ledgerlake.plans.tables import Tables

# --- fixed values (query parameters) ------------------------------------------------
REASSIGNMENTS = (("GRUPO DISTRIBUIDOR A", dt.date(1997, 1, 1)),
                 ("GRUPO DISTRIBUIDOR B", dt.date(1999, 1, 1)))
VALIDITY_START = dt.date(1996, 1, 1)
DEFAULT_PART_KEY = 0
HOT_SERIAL = 1                  # gets every third order's lines
VALID_DAYS = 45
# --------------------------------------------------------------------------------------


@query("star_join", "O-48", sql="""
SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, c.c_name, p.p_name, s.s_name, l.l_quantity
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey JOIN part p ON p.p_partkey = l.l_partkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
""")
def star_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li, o, c, p, s = t.lineitem, t.orders, t.customer, t.part, t.supplier
    return (li.join(o, o.o_orderkey == li.l_orderkey).join(c, c.c_custkey == o.o_custkey)
            .join(p, p.p_partkey == li.l_partkey).join(s, s.s_suppkey == li.l_suppkey)
            .select("l_orderkey", "l_linenumber", "o_orderdate", "c_name", "p_name", "s_name", "l_quantity"))


@query("left_override_join", "O-48c", sql="""
WITH lst AS (SELECT c_custkey, 'CLIENTE EN MORA' AS motivo FROM customer WHERE c_acctbal < 0)
SELECT o.o_orderkey, o.o_custkey, COALESCE(l.motivo, 'SIN MOTIVO') AS motivo, l.c_custkey IS NOT NULL AS is_listed
FROM orders o LEFT JOIN lst l ON l.c_custkey = o.o_custkey
""")
def left_override_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lst = t.customer.where(F.col("c_acctbal") < 0).select("c_custkey", F.lit("CLIENTE EN MORA").alias("motivo"))
    o = t.orders
    j = o.join(lst, lst.c_custkey == o.o_custkey, "left")
    return j.select("o_orderkey", "o_custkey", F.coalesce("motivo", F.lit("SIN MOTIVO")).alias("motivo"),
                    F.col("c_custkey").isNotNull().alias("is_listed"))


@query("full_outer_override", "O-48d", sql="""
WITH corr AS (SELECT p_partkey + 5 AS p_partkey, upper(p_name) AS p_name,
                     CASE WHEN p_size < 5 THEN NULL ELSE 'CORREGIDO' END AS p_type
              FROM part WHERE p_size < 10)
SELECT COALESCE(c.p_partkey, b.p_partkey) AS p_partkey, COALESCE(c.p_name, b.p_name) AS p_name,
       COALESCE(c.p_type, b.p_type) AS p_type
FROM part b FULL JOIN corr c ON b.p_partkey = c.p_partkey
""")
def full_outer_override(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    corr = p.where(F.col("p_size") < 10).select(
        (F.col("p_partkey") + 5).alias("p_partkey"), F.upper("p_name").alias("p_name"),
        F.when(F.col("p_size") < 5, None).otherwise(F.lit("CORREGIDO")).alias("p_type"))
    return joins.full_override(p.select("p_partkey", "p_name", "p_type"), corr, "p_partkey",
                               ["p_name", "p_type"])


@query("composite_key_join", "O-48e", sql="""
WITH g AS (SELECT l_orderkey, l_partkey, count(*) AS n_lines, max(l_linenumber) AS last_line
           FROM lineitem GROUP BY l_orderkey, l_partkey)
SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, g.n_lines, g.last_line
FROM lineitem l JOIN g ON g.l_orderkey = l.l_orderkey AND g.l_partkey = l.l_partkey
""")
def composite_key_join(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    g = li.groupBy("l_orderkey", "l_partkey").agg(F.count(F.lit(1)).alias("n_lines"),
                                                  F.max("l_linenumber").alias("last_line"))
    return li.join(g, ["l_orderkey", "l_partkey"]).select(
        "l_orderkey", "l_partkey", "l_linenumber", "n_lines", "last_line")


_INTERVALS_SQL = """
WITH ord AS (SELECT o.o_orderkey, c.c_nationkey, CAST(o.o_orderdate AS DATE) AS fecha
             FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
ny AS (SELECT DISTINCT c_nationkey, CAST(year(fecha) AS INTEGER) AS y FROM ord),
iv AS (SELECT ny.c_nationkey AS id_sucursal, CAST(ny.c_nationkey * 100 + (ny.y - 1990) AS INTEGER) AS id_punto_emision,
              make_date(ny.y, 1, 1) AS fecha_apertura, make_date(ny.y + 1, 1, 1) AS fecha_cierre
       FROM ny JOIN nation n ON n.n_nationkey = ny.c_nationkey
       JOIN region r ON r.r_regionkey = n.n_regionkey AND r.r_name <> 'ASIA'
       UNION ALL
       SELECT n.n_nationkey, CAST(9000 + n.n_nationkey AS INTEGER), make_date(1997, 7, 1), make_date(1998, 1, 1)
       FROM nation n WHERE n.n_regionkey = 0)
"""


def _intervals(t):
    """Yearly branch intervals ``[Jan 1, next Jan 1)`` for every (nation, year) that has
    orders, outside one region, plus overlapping half-year intervals (fan-out)."""
    n, r = t.nation, t.region
    ny = _orders_nation(t).select("c_nationkey", F.year("fecha").alias("y")).distinct()
    nat = n.join(r, (r.r_regionkey == n.n_regionkey) & (r.r_name != "ASIA")).select("n_nationkey")
    yearly = ny.join(nat, nat.n_nationkey == ny.c_nationkey).select(
        F.col("c_nationkey").alias("id_sucursal"),
        (F.col("c_nationkey") * 100 + (F.col("y") - 1990)).cast("int").alias("id_punto_emision"),
        F.make_date("y", F.lit(1), F.lit(1)).alias("fecha_apertura"),
        F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).alias("fecha_cierre"))
    extra = n.where(F.col("n_regionkey") == 0).select(
        F.col("n_nationkey").alias("id_sucursal"), (F.lit(9000) + F.col("n_nationkey")).cast("int").alias("id_punto_emision"),
        F.lit(dt.date(1997, 7, 1)).alias("fecha_apertura"), F.lit(dt.date(1998, 1, 1)).alias("fecha_cierre"))
    return yearly.unionByName(extra)


def _orders_nation(t):
    o, c = t.orders, t.customer
    return o.join(c, c.c_custkey == o.o_custkey).select(
        "o_orderkey", "c_nationkey", F.to_date("o_orderdate").alias("fecha"))


@query("interval_join", "O-48f", sql=_INTERVALS_SQL + """
SELECT 'inner' AS kind, o.o_orderkey, i.id_punto_emision
FROM ord o JOIN iv i ON i.id_sucursal = o.c_nationkey AND o.fecha >= i.fecha_apertura AND o.fecha < i.fecha_cierre
UNION ALL
SELECT 'left' AS kind, o.o_orderkey, i.id_punto_emision
FROM ord o LEFT JOIN iv i ON i.id_sucursal = o.c_nationkey AND o.fecha >= i.fecha_apertura AND o.fecha < i.fecha_cierre
""")
def interval_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    iv, o = _intervals(t), _orders_nation(t)
    out = []
    for how in ("inner", "left"):
        j = joins.interval_join(o, iv, [("c_nationkey", "id_sucursal")], "fecha",
                                "fecha_apertura", "fecha_cierre", how)
        out.append(j.select(F.lit(how).alias("kind"), "o_orderkey", "id_punto_emision"))
    return out[0].unionByName(out[1])


@query("interval_join_hot_serial", "O-48f", sql=f"""
WITH pts AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN {HOT_SERIAL} ELSE l_suppkey END AS serial,
                    l_shipdate::DATE AS fecha FROM lineitem),
     iv AS (SELECT DISTINCT serial AS numser, date_trunc('week', fecha)::DATE AS apertura FROM pts),
     val AS (SELECT numser, apertura, apertura + {VALID_DAYS} AS cierre FROM iv WHERE day(apertura) <= 7),
     kinds AS (SELECT unnest(['left', 'left_semi', 'left_anti']) AS kind)
SELECT kind, l_orderkey, l_linenumber, apertura
FROM kinds, pts LEFT JOIN val ON numser = serial AND fecha >= apertura AND fecha < cierre WHERE kind = 'left'
UNION ALL
SELECT kind, l_orderkey, l_linenumber, NULL FROM kinds, pts
WHERE kind = CASE WHEN EXISTS (SELECT 1 FROM val WHERE numser = serial AND fecha >= apertura AND fecha < cierre)
                  THEN 'left_semi' ELSE 'left_anti' END
""")
def interval_join_hot_serial(spark, sf_dir):
    """Lines by serial and validity period, where one serial holds over a third of all lines and a
    period in the first week of every month."""
    pts = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(HOT_SERIAL)).otherwise(F.col("l_suppkey")).cast("long").alias("serial"),
        F.to_date("l_shipdate").alias("fecha"))
    val = (pts.select(F.col("serial").alias("numser"), F.trunc("fecha", "week").alias("apertura")).distinct()
           .where(F.dayofmonth("apertura") <= 7).withColumn("cierre", F.date_add("apertura", VALID_DAYS)))
    out = None
    for how in ("left", "left_semi", "left_anti"):
        j = joins.binned_interval_join(pts, val, [("serial", "numser")], "fecha", "apertura", "cierre", how)
        opened = F.col("apertura") if how == "left" else F.lit(None).cast("date")
        j = j.select(F.lit(how).alias("kind"), "l_orderkey", "l_linenumber", opened.alias("apertura"))
        out = j if out is None else out.unionByName(j)
    return out


@query("effective_date_join", "O-48g", sql="""
WITH rd AS (SELECT c_custkey AS codigo_cliente, 'GRUPO DISTRIBUIDOR A' AS grupo, DATE '1997-01-01' AS fecha_cambio
            FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
            UNION ALL
            SELECT c_custkey, 'GRUPO DISTRIBUIDOR B', DATE '1999-01-01' FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
SELECT o.o_orderkey, o.o_custkey, rd.grupo
FROM orders o LEFT JOIN rd ON rd.codigo_cliente = o.o_custkey AND CAST(o.o_orderdate AS DATE) >= rd.fecha_cambio
""")
def effective_date_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    auto = t.customer.where(F.col("c_mktsegment") == "AUTOMOBILE")
    rd = None
    for grupo, since in REASSIGNMENTS:
        part = auto.select(F.col("c_custkey").alias("codigo_cliente"), F.lit(grupo).alias("grupo"),
                           F.lit(since).alias("fecha_cambio"))
        rd = part if rd is None else rd.unionByName(part)
    o = t.orders.withColumn("fecha", F.to_date("o_orderdate"))
    j = joins.effective_join(o, rd, [("o_custkey", "codigo_cliente")], "fecha", "fecha_cambio", "left")
    return j.select("o_orderkey", "o_custkey", "grupo")


@query("validity_window_filter", "O-48h O-40", sql="""
WITH vc AS (SELECT s_suppkey AS codigo_vendedor, DATE '1996-01-01' + s_nationkey * 30 AS fecha_inicio,
                   DATE '1996-01-01' + s_nationkey * 30 + 700 AS fecha_fin
            FROM supplier WHERE s_acctbal > 0)
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN vc ON vc.codigo_vendedor = l.l_suppkey
WHERE CAST(o.o_orderdate AS DATE) BETWEEN vc.fecha_inicio AND vc.fecha_fin
""")
def validity_window_filter(spark, sf_dir):
    t = Tables(spark, sf_dir)
    start = F.date_add(F.lit(VALIDITY_START), F.col("s_nationkey") * 30)
    vc = t.supplier.where(F.col("s_acctbal") > 0).select(
        F.col("s_suppkey").alias("codigo_vendedor"), start.alias("fecha_inicio"),
        F.date_add(start, 700).alias("fecha_fin"))
    li, o = t.lineitem, t.orders
    lo = li.join(o, o.o_orderkey == li.l_orderkey).withColumn("fecha", F.to_date("o_orderdate"))
    j, active = joins.validity_window(lo, vc, [("l_suppkey", "codigo_vendedor")], "fecha",
                                      "fecha_inicio", "fecha_fin")
    return j.where(active).select("l_orderkey", "l_linenumber", "l_suppkey")


@query("constant_key_join", "O-48i", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, d.p_name AS default_name, d.p_brand AS default_brand
FROM lineitem l LEFT JOIN part d ON d.p_partkey = 0
""")
def constant_key_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.attach_default_row(li, t.part, "p_partkey", DEFAULT_PART_KEY,
                                    {"default_name": "p_name", "default_brand": "p_brand"})


@query("anti_join", "O-49", sql="""
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def anti_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return joins.anti_join(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")]).select("o_orderkey", "o_custkey")


@query("semi_or_predicate", "O-50", sql="""
SELECT p.p_partkey, p.p_name FROM part p
WHERE p.p_name LIKE 'red%' OR EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_returnflag = 'R' AND l.l_quantity = 50)
""")
def semi_or_predicate(spark, sf_dir):
    t = Tables(spark, sf_dir)
    sold = t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50))
    return joins.semi_or(t.part, sold, [("p_partkey", "l_partkey")],
                         F.col("p_name").like("red%")).select("p_partkey", "p_name")


@query("aggregate_join_back", "O-51 O-53", sql="""
WITH g AS (SELECT o_custkey, max(o_orderpriority) AS max_priority FROM orders GROUP BY o_custkey)
SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, g.max_priority
FROM orders o LEFT JOIN g ON g.o_custkey = o.o_custkey
""")
def aggregate_join_back(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return joins.join_back_aggregate(o, ["o_custkey"], [F.max("o_orderpriority").alias("max_priority")])
