"""Driver queries for scans, extracts and the calendar (O-01..O-16)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import text
from ledgerlake.operators import aggregates, branches
from ledgerlake.operators import transforms as tf
from ledgerlake.plans.registry import query
from ledgerlake.plans.tables import Tables
from ledgerlake.session import table_path
from ledgerlake.sources import calendar, readers
from ledgerlake.sources.registry import RunMode, SourceSpec, read_sources, sources_for

# --- fixed values (query parameters) ------------------------------------------------
HWM_TS = dt.datetime(1999, 6, 30, 0, 0, 0)   # :max_incremental_date
HWM_ID = 10_000                               # :max_incremental_id
BRANDS = ["Brand#2", "Brand#3", "Brand#5"]    # IN-list parameter
# --------------------------------------------------------------------------------------


@query("scan_param_filter", "O-01 O-09", sql="""
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice
FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-30 00:00:00'
""")
def scan_param_filter(spark, sf_dir):
    # the mark is bound as text and cast in SQL: a TIMESTAMP_NTZ needs no time zone
    q = ("SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice "
         f"FROM parquet.`{table_path(sf_dir, 'orders')}` "
         "WHERE o_orderdate > CAST(:max_incremental_date AS TIMESTAMP_NTZ)")
    return readers.sql_extract(spark, q, {"max_incremental_date": HWM_TS.isoformat(sep=" ")})


@query("scan_id_watermark", "O-10 O-52", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey > (SELECT max(l_orderkey) FROM lineitem WHERE l_orderkey <= 10000)
""")
def scan_id_watermark(spark, sf_dir):
    """The stored mark of the lines loaded so far, then the lines past it."""
    t = Tables(spark, sf_dir)
    mark = aggregates.high_water_mark(t.lineitem, "l_orderkey", F.col("l_orderkey") <= HWM_ID)
    return (t.lineitem.where(aggregates.after_watermark("l_orderkey", mark))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))


@query("scan_in_list", "O-02 O-38", sql="""
WITH p AS (SELECT p_partkey, NULLIF(p_brand, 'Brand#1') AS brand FROM part)
SELECT p_partkey, brand, 'in' AS sel FROM p WHERE brand IN ('Brand#2', 'Brand#3', 'Brand#5')
UNION ALL
SELECT p_partkey, brand, 'not_in' AS sel FROM p WHERE brand NOT IN ('Brand#2', 'Brand#3', 'Brand#5')
UNION ALL SELECT p_partkey, brand, 'null_in' FROM p WHERE brand IN ('Brand#2', NULL)
UNION ALL SELECT p_partkey, brand, 'null_not_in' FROM p WHERE brand NOT IN ('Brand#2', NULL)
UNION ALL SELECT p_partkey, brand, 'empty_not_in' FROM p
UNION ALL SELECT p_partkey, brand, 'long_in' FROM p WHERE p_partkey IN (SELECT 3 * range FROM range(1500))
UNION ALL SELECT p_partkey, brand, 'long_not_in' FROM p WHERE brand NOT IN (SELECT 'Brand#' || 2 * range FROM range(1500))
UNION ALL SELECT p_partkey, brand, 'long_null_not_in' FROM p WHERE p_partkey NOT IN (SELECT 3 * range FROM range(1500) UNION ALL SELECT NULL)
""")
def scan_in_list(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select(
        "p_partkey", F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("brand"))
    inn = readers.in_list_filter(p, "brand", BRANDS).withColumn("sel", F.lit("in"))
    out = readers.in_list_filter(p, "brand", BRANDS, negate=True).withColumn("sel", F.lit("not_in"))
    thirds, evens = [3 * i for i in range(1500)], [f"Brand#{2 * i}" for i in range(1500)]
    more = (("null_in", "brand", ["Brand#2", None], False), ("null_not_in", "brand", ["Brand#2", None], True),
            ("empty_in", "brand", [], False), ("empty_not_in", "brand", [], True),
            ("long_in", "p_partkey", thirds, False), ("long_not_in", "brand", evens, True),
            ("long_null_not_in", "p_partkey", [*thirds, None], True))
    out = inn.unionByName(out)
    for sel, column, values, negate in more:
        out = out.unionByName(readers.in_list_filter(p, column, values, negate).withColumn("sel", F.lit(sel)))
    return out


def _purchases(spark, params):
    t = Tables(spark, params["sf_dir"])
    return (t.events.where(F.col("event_type") == "purchase")
            .select("event_id", "user_id", "ts", "value"))


def _signups(spark, params):
    t = Tables(spark, params["sf_dir"])
    # this source has no ``value`` column: the union fills it with NULL
    return t.events.where(F.col("event_type") == "signup").select("event_id", "user_id", "ts")


SOURCE_REGISTRY = {
    RunMode.FULL: [SourceSpec("purchases", "PORTAL", _purchases),
                   SourceSpec("signups", "CAMUNDA", _signups)],
    RunMode.INCREMENTAL: [SourceSpec("signups", "CAMUNDA", _signups)],
}


@query("source_by_mode", "O-07 O-30 O-67", sql="""
SELECT event_id, user_id, ts, value, 'PORTAL' AS origen FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT event_id, user_id, ts, NULL AS value, 'CAMUNDA' AS origen FROM events WHERE event_type = 'signup'
""")
def source_by_mode(spark, sf_dir):
    return read_sources(spark, sources_for(SOURCE_REGISTRY, "INICIAL"), {"sf_dir": sf_dir})


@query("exclusion_extract", "O-11 O-55", sql="""
SELECT DISTINCT trim(CAST(l_orderkey AS VARCHAR)) AS codigo_factura, 'FACTURA CON IVA 0' AS motivo
FROM lineitem WHERE l_tax = 0 AND CAST(l_orderkey AS VARCHAR) <> ''
""")
def exclusion_extract(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    numfac = F.col("l_orderkey").cast("string")
    return (li.where((F.col("l_tax") == 0) & (numfac != ""))
            .select(F.trim(numfac).alias("codigo_factura"),
                    F.lit("FACTURA CON IVA 0").alias("motivo"))
            .distinct())


@query("request_extract_chain", "O-12 O-13 O-48b", sql="""
SELECT o.o_orderkey, l.l_linenumber, p.p_name, c.c_name,
       n1.n_name AS customer_nation, n2.n_name AS supplier_nation,
       COALESCE(r.r_name, 'SIN REGION') AS region,
       CASE WHEN p.p_type = 'PROMO' THEN 'SF'
            WHEN p.p_type IN ('SMALL', 'MEDIUM') THEN 'FIRMA' ELSE 'OTRO' END AS producto,
       CASE WHEN n2.n_name IS NULL THEN n1.n_name ELSE n2.n_name END AS nation_fallback,
       CASE WHEN o.o_orderstatus = 'F' THEN 'APROBADO' ELSE 'NO APROBADO' END AS estado
FROM orders o
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n1 ON n1.n_nationkey = c.c_nationkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey AND s.s_acctbal > 0
LEFT JOIN nation n2 ON n2.n_nationkey = s.s_nationkey
LEFT JOIN region r ON r.r_regionkey = n2.n_regionkey AND r.r_name <> 'ASIA'
WHERE o.o_orderstatus IN ('F', 'O') OR (o.o_orderstatus = 'P' AND c.c_acctbal < 0)
""")
def request_extract_chain(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o, li, p, c = t.orders.alias("o"), t.lineitem.alias("l"), t.part.alias("p"), t.customer.alias("c")
    n1, n2, s, r = t.nation.alias("n1"), t.nation.alias("n2"), t.supplier.alias("s"), t.region.alias("r")
    j = (o.join(li, F.col("l.l_orderkey") == F.col("o.o_orderkey"))
         .join(p, F.col("p.p_partkey") == F.col("l.l_partkey"))
         .join(c, F.col("c.c_custkey") == F.col("o.o_custkey"))
         .join(n1, F.col("n1.n_nationkey") == F.col("c.c_nationkey"))
         .join(s, (F.col("s.s_suppkey") == F.col("l.l_suppkey")) & (F.col("s.s_acctbal") > 0), "left")
         .join(n2, F.col("n2.n_nationkey") == F.col("s.s_nationkey"), "left")
         .join(r, (F.col("r.r_regionkey") == F.col("n2.n_regionkey")) & (F.col("r.r_name") != "ASIA"),
               "left")
         .where(F.col("o.o_orderstatus").isin("F", "O")
                | ((F.col("o.o_orderstatus") == "P") & (F.col("c.c_acctbal") < 0))))
    return j.select(
        "o.o_orderkey", "l.l_linenumber", "p.p_name", "c.c_name",
        F.col("n1.n_name").alias("customer_nation"), F.col("n2.n_name").alias("supplier_nation"),
        F.coalesce(F.col("r.r_name"), F.lit("SIN REGION")).alias("region"),
        F.when(F.col("p.p_type") == "PROMO", "SF")
         .when(F.col("p.p_type").isin("SMALL", "MEDIUM"), "FIRMA").otherwise("OTRO").alias("producto"),
        F.when(F.col("n2.n_name").isNull(), F.col("n1.n_name")).otherwise(F.col("n2.n_name"))
         .alias("nation_fallback"),
        F.when(F.col("o.o_orderstatus") == "F", "APROBADO").otherwise("NO APROBADO").alias("estado"))


@query("portal_union_distinct", "O-14 O-68", sql="""
SELECT c_custkey AS id, c_name AS nombre, 'PERSONA NATURAL' AS portal FROM customer WHERE c_mktsegment = 'BUILDING'
UNION
SELECT c_custkey AS id, c_name AS nombre, 'PERSONA NATURAL' AS portal FROM customer WHERE c_acctbal > 5000
UNION
SELECT s_suppkey AS id, s_name AS nombre, 'MIEMBRO EMPRESA' AS portal FROM supplier
UNION
SELECT s_suppkey AS id, s_name AS nombre, 'MIEMBRO EMPRESA' AS portal FROM supplier WHERE s_acctbal > 0
""")
def portal_union_distinct(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c, s = t.customer, t.supplier

    def cust(where):
        return c.where(where).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"),
                                     F.lit("PERSONA NATURAL").alias("portal"))

    def supp(where):
        return s.where(where).select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nombre"),
                                     F.lit("MIEMBRO EMPRESA").alias("portal"))
    return tf.union_distinct([cust(F.col("c_mktsegment") == "BUILDING"),
                              cust(F.col("c_acctbal") > 5000), supp(F.lit(True)),
                              supp(F.col("s_acctbal") > 0)])


@query("approved_requests_extract", "O-12 O-48b O-48c", sql="""
SELECT o.o_orderkey AS id_tramite, f.l_linenumber AS linea, u.c_name AS cedula,
       CASE WHEN fs.s_suppkey IS NOT NULL THEN fs.s_name ELSE u.c_name || CAST(o.o_orderkey AS VARCHAR) END AS serial_firma,
       c_2.n_name AS tipo_firma, c_3.n_name AS producto, c_4.n_name AS grupo_vendedor, u_2.c_name AS operador,
       sf.r_name AS control, 'APROBADO' AS estado
FROM orders o
JOIN customer u ON u.c_custkey = o.o_custkey
JOIN lineitem f ON f.l_orderkey = o.o_orderkey
JOIN part d ON d.p_partkey = f.l_partkey
JOIN nation c_2 ON c_2.n_nationkey = d.p_partkey % 30
JOIN events s_0 ON s_0.event_id = o.o_orderkey
JOIN nation c_3 ON c_3.n_nationkey = o.o_orderkey % 25
LEFT JOIN supplier fs ON fs.s_suppkey = f.l_suppkey * 2
LEFT JOIN region sf ON sf.r_regionkey = o.o_orderkey % 7
LEFT JOIN customer u_2 ON u_2.c_custkey = s_0.user_id
LEFT JOIN nation c_4 ON c_4.n_nationkey = u_2.c_nationkey
WHERE o.o_orderstatus IN ('F', 'O') AND u.c_mktsegment <> 'HOUSEHOLD' AND (fs.s_acctbal > 0 OR fs.s_acctbal IS NULL)
""")
def approved_requests_extract(spark, sf_dir):
    """Eleven relations, users under two roles and the catalogue under three, each read once."""
    t = Tables(spark, sf_dir)
    base = (t.orders.where(F.col("o_orderstatus").isin("F", "O")).select("o_orderkey", "o_custkey")
            .join(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t.part.select("p_partkey"), F.col("p_partkey") == F.col("l_partkey"))
            .join(t.events.select("event_id", "user_id"), F.col("event_id") == F.col("o_orderkey"))
            .join(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), F.col("s_suppkey") == F.col("l_suppkey") * 2, "left")
            .join(t.region.select("r_regionkey", "r_name"), F.col("r_regionkey") == F.col("o_orderkey") % 7, "left")
            .where((F.col("s_acctbal") > 0) | F.col("s_acctbal").isNull()))
    users = branches.role_lookup(base, t.customer, "c_custkey", {"u": "o_custkey", "u_2": "user_id"},
                                 ["c_name", "c_mktsegment", "c_nationkey"], required=["u"]).where("u_c_mktsegment <> 'HOUSEHOLD'")
    coded = users.withColumns({"__type": F.col("p_partkey") % 30, "__process": F.col("o_orderkey") % 25})
    full = branches.role_lookup(coded, t.nation, "n_nationkey", {"c_2": "__type", "c_3": "__process", "c_4": "u_2_c_nationkey"},
                                ["n_name"], required=["c_2", "c_3"])
    serial = F.when(F.col("s_suppkey").isNotNull(), F.col("s_name")).otherwise(
        text.strict_concat("u_c_name", F.col("o_orderkey").cast("string")))
    return full.select(F.col("o_orderkey").alias("id_tramite"), F.col("l_linenumber").alias("linea"), F.col("u_c_name").alias("cedula"),
                       serial.alias("serial_firma"), F.col("c_2_n_name").alias("tipo_firma"), F.col("c_3_n_name").alias("producto"),
                       F.col("c_4_n_name").alias("grupo_vendedor"), F.col("u_2_c_name").alias("operador"),
                       F.col("r_name").alias("control"), F.lit("APROBADO").alias("estado"))


PORTAL_SCHEMA = T.StructType([T.StructField("id_tramite", T.LongType()), T.StructField("cedula", T.StringType()),
                              T.StructField("tipo_firma", T.StringType()), T.StructField("ruc_aux", T.StringType()),
                              T.StructField("producto", T.StringType())])


@query("portal_ten_branches", "O-14 O-39 O-68 O-72", sql="""
SELECT c_custkey::BIGINT AS id_tramite, c_name AS cedula, 'PN' AS tipo_firma, c_name || '001' AS ruc_aux, 'FIRMA' AS producto
FROM customer WHERE c_nationkey IN (1, 5) AND c_name NOT LIKE '%prueb%' AND c_name NOT LIKE '%test%'
UNION SELECT c_custkey, c_name, 'PN', c_name || '001', 'FIRMA' FROM customer WHERE c_acctbal > 0
UNION SELECT s_suppkey, s_name, 'ME', CAST(s_nationkey AS VARCHAR), 'FIRMA' FROM supplier WHERE s_nationkey IN (1, 5)
UNION SELECT s_suppkey, s_name, 'RL', CAST(s_nationkey AS VARCHAR), 'FIRMA' FROM supplier WHERE s_acctbal > 0 AND s_name NOT LIKE '%9'
UNION SELECT p_partkey, p_name, 'PN', NULL, 'SF' FROM part WHERE p_type = 'PROMO'
UNION SELECT p_partkey, p_brand, 'ME', NULL, 'SF' FROM part WHERE p_size > 25
UNION SELECT o_orderkey, o_orderstatus, 'RL', o_orderpriority, 'FIRMA' FROM orders WHERE o_orderstatus = 'F'
UNION SELECT o_custkey, o_orderstatus, 'RL', NULL, 'FIRMA' FROM orders WHERE o_orderpriority LIKE '1%'
UNION SELECT n_nationkey, n_name, 'ME', n_name || '001', 'SF' FROM nation WHERE n_regionkey <> 2
UNION SELECT user_id, event_type, 'PN', event_type || '001', 'SF' FROM events WHERE event_type <> 'error'
""")
def portal_ten_branches(spark, sf_dir):
    """Ten branches over six tables, each table scanned once, one distinct."""
    t = Tables(spark, sf_dir)
    col, lit = F.col, F.lit

    def branch(table, where, id_col, who, kind, aux, product):
        values = {"id_tramite": col(id_col), "cedula": col(who), "tipo_firma": lit(kind), "producto": lit(product)}
        return branches.Branch(table, where, values if aux is None else values | {"ruc_aux": aux})

    plain = ~col("c_name").like("%prueb%") & ~col("c_name").like("%test%")
    c_aux, s_aux = text.strict_concat("c_name", lit("001")), col("s_nationkey").cast("string")
    found = [
        branch("customer", col("c_nationkey").isin(1, 5) & plain, "c_custkey", "c_name", "PN", c_aux, "FIRMA"),
        branch("customer", col("c_acctbal") > 0, "c_custkey", "c_name", "PN", c_aux, "FIRMA"),
        branch("supplier", col("s_nationkey").isin(1, 5), "s_suppkey", "s_name", "ME", s_aux, "FIRMA"),
        branch("supplier", (col("s_acctbal") > 0) & ~col("s_name").like("%9"), "s_suppkey", "s_name", "RL", s_aux, "FIRMA"),
        branch("part", col("p_type") == "PROMO", "p_partkey", "p_name", "PN", None, "SF"),
        branch("part", col("p_size") > 25, "p_partkey", "p_brand", "ME", None, "SF"),
        branch("orders", col("o_orderstatus") == "F", "o_orderkey", "o_orderstatus", "RL", col("o_orderpriority"), "FIRMA"),
        branch("orders", col("o_orderpriority").like("1%"), "o_custkey", "o_orderstatus", "RL", None, "FIRMA"),
        branch("nation", col("n_regionkey") != 2, "n_nationkey", "n_name", "ME", text.strict_concat("n_name", lit("001")), "SF"),
        branch("events", col("event_type") != "error", "user_id", "event_type", "PN", text.strict_concat("event_type", lit("001")), "SF")]
    tables = {n: getattr(t, n) for n in ("customer", "supplier", "part", "orders", "nation", "events")}
    return branches.union_of_branches(tables, found, PORTAL_SCHEMA)


@query("fallback_extract", "O-15 O-74 O-88 O-39", sql="""
WITH src AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS ruc,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
              ELSE CAST(DATE '2024-01-01' + c_nationkey AS TIMESTAMP) END AS fecha_aprob,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'FIRMA' ELSE 'SF' END AS producto,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE lower(c_mktsegment) END AS ap2
  FROM customer)
SELECT c_custkey, COALESCE(ruc, left(c_name, 10)) AS id_cliente, fecha_aprob, producto
FROM src
WHERE fecha_aprob IS NOT NULL AND c_name NOT ILIKE 'customer#0000000%' AND ap2 NOT ILIKE '%prueb%'
""")
def fallback_extract(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    src = c.select(
        "c_custkey", "c_name",
        F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_custkey").cast("string")).alias("ruc"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", None)
         .otherwise(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("c_nationkey")).cast("timestamp_ntz"))
         .alias("fecha_aprob"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "FIRMA").otherwise("SF")
         .alias("producto"),
        # second surname, NULL for some rows: NOT ILIKE on NULL drops the row (T-05)
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", None).otherwise(F.lower("c_mktsegment")).alias("ap2"))
    return (src.where(F.col("fecha_aprob").isNotNull()
                      & ~F.col("c_name").ilike("customer#0000000%") & ~F.col("ap2").ilike("%prueb%"))
            .select("c_custkey", F.coalesce("ruc", text.left("c_name", 10)).alias("id_cliente"),
                    "fecha_aprob", "producto"))


@query("calendar", "O-16 O-85 O-86 M-13", sql="""
WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) + 1 AS hi FROM orders),
days AS (SELECT CAST(unnest(generate_series(lo, hi - 1, INTERVAL 1 DAY)) AS DATE) AS date_day FROM span)
SELECT date_day AS "date",
       CAST(year(date_day) AS INTEGER) AS year, CAST(month(date_day) AS INTEGER) AS month,
       CAST(day(date_day) AS INTEGER) AS day, CAST(quarter(date_day) AS INTEGER) AS quarter,
       rpad(strftime(date_day, '%B'), 9, ' ') AS month_name,
       rpad(strftime(date_day, '%A'), 9, ' ') AS day_name,
       isodow(date_day) IN (6, 7) AS is_weekend
FROM days
""")
def calendar_query(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    span = o.agg(F.to_date(F.min("o_orderdate")).alias("lo"),
                 F.date_add(F.to_date(F.max("o_orderdate")), 1).alias("hi"))
    spine = calendar.date_spine_between(span, F.col("lo"), F.col("hi"))
    return calendar.dim_date(spine)


@query("full_extract", "O-08 O-06 O-69", sql="""
SELECT trim(CAST(c_custkey AS VARCHAR)) AS codcli, c_name AS nomcli, CAST(c_nationkey AS VARCHAR) AS cif,
       c_mktsegment AS segmento
FROM customer
""")
def full_extract(spark, sf_dir):
    """Explicit projection of a source table (the extract's ORDER BY has no meaning
    once loaded, so it is dropped)."""
    c = Tables(spark, sf_dir).customer
    return c.select(F.trim(F.col("c_custkey").cast("string")).alias("codcli"), F.col("c_name").alias("nomcli"),
                    F.col("c_nationkey").cast("string").alias("cif"), F.col("c_mktsegment").alias("segmento"))


@query("rejected_extract", "O-13 O-38 O-72 O-83", sql="""
SELECT CAST(e.event_id AS VARCHAR) || '-' || strftime(e.ts, '%Y-%m-%d %H:%M:%S') || '-' || CAST(o.o_orderkey AS VARCHAR) AS id_sintetico,
       e.event_id, e.event_type, o.o_orderstatus, 'NO APROBADO' AS estado
FROM events e JOIN orders o ON o.o_orderkey = e.event_id
WHERE e.event_type NOT IN ('purchase', 'signup')
   OR (e.event_type IN ('purchase', 'signup') AND o.o_orderstatus = 'P')
""")
def rejected_extract(spark, sf_dir):
    """Requests not approved: task not in the approved set, or approved task whose invoice
    is inactive; the synthetic key is id + date + invoice (``||`` semantics)."""
    t = Tables(spark, sf_dir)
    e, o = t.events, t.orders
    approved_tasks = ["purchase", "signup"]
    j = e.join(o, o.o_orderkey == e.event_id)
    cond = ~F.col("event_type").isin(*approved_tasks) | (
        F.col("event_type").isin(*approved_tasks) & (F.col("o_orderstatus") == "P"))
    return j.where(cond).select(
        text.strict_concat(F.col("event_id").cast("string"), F.lit("-"),
                           F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("-"),
                           F.col("o_orderkey").cast("string")).alias("id_sintetico"),
        "event_id", "event_type", "o_orderstatus", F.lit("NO APROBADO").alias("estado"))
