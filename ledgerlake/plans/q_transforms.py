"""Driver queries for projections, predicates, casts and set-style transforms
(O-29..O-47, O-55, O-61..O-65c)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import joins, keys
from ledgerlake.operators import transforms as tf
from ledgerlake.plans.registry import query
from ledgerlake.plans.tables import Tables


@query("rename_const_drop_keep", "O-29 O-30 O-31 O-32", sql="""
SELECT p_partkey, p_name AS nombre, p_brand AS marca, p_size, 'FENIX' AS origen FROM part
""")
def rename_const_drop_keep(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return tf.chain(p, [
        lambda d: tf.rename_columns(d, {"p_name": "nombre", "p_brand": "marca", "absent": "x"}),
        lambda d: tf.add_constant(d, "origen", "FENIX"),
        lambda d: tf.drop_columns(d, ["p_retailprice"]),
        lambda d: tf.keep_columns(d, ["p_partkey", "nombre", "marca", "p_size", "origen"]),
    ])


@query("drop_null_dates", "O-33", sql="""
WITH o AS (SELECT o_orderkey,
                  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS fecha_factura,
                  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS fecha_aprobacion
           FROM orders)
SELECT * FROM o WHERE fecha_factura IS NOT NULL AND fecha_aprobacion IS NOT NULL
""")
def drop_null_dates(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", None).otherwise(F.col("o_orderdate")).alias("fecha_factura"),
        F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderdate")).alias("fecha_aprobacion"))
    return tf.drop_null_dates(o, ["fecha_factura", "fecha_aprobacion"])


@query("equality_flags", "O-34 O-35", sql="""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END AS estado
           FROM orders)
SELECT o_orderkey, estado, COALESCE(estado = 'F', false) AS is_finished,
       COALESCE(estado <> 'F', true) AS is_open FROM o
""")
def equality_flags(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", None)
                       .otherwise(F.col("o_orderstatus")).alias("estado"))
    o = tf.equality_flag(o, "estado", "F", "is_finished")
    return tf.inequality_flag(o, "estado", "F", "is_open")


@query("replace_value", "O-36", sql="""
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_returnflag = 'R' THEN 'RETURNED' ELSE l_returnflag END AS l_returnflag
FROM lineitem
""")
def replace_value(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return tf.replace_value(li, "l_returnflag", "R", "RETURNED")


# --- fixed values: article family rules (first match wins) ---------------------------
FAMILY_RULES_SQL = """
CASE WHEN p_name LIKE 'red%' THEN 'FIRMAS ELECTRONICAS'
     WHEN p_name LIKE '%widget' THEN 'SISTEMA DE FACTURACION'
     WHEN p_type = 'PROMO' AND p_name LIKE '%ring%' THEN 'LICENCIAS'
     WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'SERVICIOS'
     WHEN p_size > 40 THEN 'HARDWARE'
     ELSE 'OTROS' END"""
# --------------------------------------------------------------------------------------


def family_rule(name="p_name", ptype="p_type", size="p_size"):
    n, t, s = F.col(name), F.col(ptype), F.col(size)
    return (F.when(n.like("red%"), "FIRMAS ELECTRONICAS")
            .when(n.like("%widget"), "SISTEMA DE FACTURACION")
            .when((t == "PROMO") & n.like("%ring%"), "LICENCIAS")
            .when(t.isin("SMALL", "MEDIUM"), "SERVICIOS")
            .when(s > 40, "HARDWARE")
            .otherwise("OTROS"))


@query("case_classify", "O-37 O-39 O-43", sql=f"""
SELECT p_partkey, {FAMILY_RULES_SQL} AS familia,
       NULLIF(p_brand, 'Brand#1') IS NOT NULL AS has_brand,
       p_name NOT LIKE '%hot%' AS not_hot
FROM part
""")
def case_classify(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey", family_rule().alias("familia"),
                    F.nullif(F.col("p_brand"), F.lit("Brand#1")).isNotNull().alias("has_brand"),
                    (~F.col("p_name").like("%hot%")).alias("not_hot"))


@query("multi_rule_filter", "O-42 O-50 O-40", sql="""
SELECT DISTINCT l.l_orderkey
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
WHERE (p.p_type = 'PROMO' AND s.s_acctbal > 0)
   OR (p.p_size BETWEEN 10 AND 12 AND l.l_discount >= 0.09)
   OR (l.l_returnflag = 'R' AND p.p_name NOT LIKE '%red%')
   OR s.s_nationkey = 7
   OR (p.p_type = 'STANDARD' AND NOT (s.s_acctbal > 1000))
   OR EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderpriority = '1-URGENT')
""")
def multi_rule_filter(spark, sf_dir):
    t = Tables(spark, sf_dir)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    li, p, s = t.lineitem, t.part, t.supplier
    j = li.join(p, p.p_partkey == li.l_partkey).join(s, s.s_suppkey == li.l_suppkey)
    rule = (((F.col("p_type") == "PROMO") & (F.col("s_acctbal") > 0))
            | (F.col("p_size").between(10, 12) & (F.col("l_discount") >= 0.09))
            | ((F.col("l_returnflag") == "R") & ~F.col("p_name").like("%red%"))
            | (F.col("s_nationkey") == 7)
            | ((F.col("p_type") == "STANDARD") & ~(F.col("s_acctbal") > 1000))
            | joins.exists_in(urgent, [("l_orderkey", "o_orderkey")]))
    return j.where(rule).select("l_orderkey").distinct()


@query("three_valued_filter", "O-41", sql="""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderstatus = 'F' END AS f
           FROM orders)
SELECT 'not_f' AS rule, o_orderkey FROM o WHERE NOT f
UNION ALL
SELECT 'f_or_null' AS rule, o_orderkey FROM o WHERE f = TRUE OR f IS NULL
""")
def three_valued_filter(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", None)
                       .otherwise(F.col("o_orderstatus") == "F").alias("f"))
    a = o.where(~F.col("f")).select(F.lit("not_f").alias("rule"), "o_orderkey")
    b = o.where((F.col("f") == True) | F.col("f").isNull()).select(  # noqa: E712
        F.lit("f_or_null").alias("rule"), "o_orderkey")
    return a.unionByName(b)


@query("star_projection", "O-46 O-80", sql="""
SELECT l.*, l.l_extendedprice * (1 - l.l_discount) AS net_price FROM lineitem l
""")
def star_projection(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.alias("l")
    return li.select("l.*", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"))


@query("coalesce_override", "O-44", sql="""
SELECT p_partkey,
       COALESCE(CASE WHEN p_size > 45 THEN upper(p_name) END, p_name) AS nombre,
       COALESCE(CASE WHEN p_type = 'PROMO' THEN 'PROMOCION' END, CASE WHEN p_size < 5 THEN 'MINI' END, p_type) AS tipo
FROM part
""")
def coalesce_override(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey",
                    F.coalesce(F.when(F.col("p_size") > 45, F.upper("p_name")), F.col("p_name")).alias("nombre"),
                    F.coalesce(F.when(F.col("p_type") == "PROMO", F.lit("PROMOCION")),
                               F.when(F.col("p_size") < 5, F.lit("MINI")), F.col("p_type")).alias("tipo"))


@query("blank_to_null", "O-45 O-47", sql="""
WITH p AS (SELECT p_partkey, p_name, CASE WHEN p_type = 'PROMO' THEN '' ELSE p_brand END AS doc FROM part)
SELECT p_partkey, NULLIF(doc, '') AS doc_or_null,
       CASE WHEN doc = '' THEN p_name ELSE doc END AS doc_or_name
FROM p
""")
def blank_to_null(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select(
        "p_partkey", "p_name", F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_brand")).alias("doc"))
    return p.select("p_partkey", F.nullif(F.col("doc"), F.lit("")).alias("doc_or_null"),
                    F.when(F.col("doc") == "", F.col("p_name")).otherwise(F.col("doc")).alias("doc_or_name"))


@query("sort_values", "O-60 O-89", sql="""
SELECT o_orderkey, o_totalprice,
       CAST(row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS LAST) AS BIGINT) AS sort_position
FROM orders
""")
def sort_values(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc_nulls_last()]
    return keys.global_row_number(o, order, "sort_position")


@query("sort_values_top", "O-61", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS LAST LIMIT 100
""")
def sort_values_top(spark, sf_dir):
    """Top-100 report over the sorted orders."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    return tf.sort_values(o, ["o_totalprice", "o_orderkey"], [False, True]).limit(100)


@query("distinct_rows", "O-55", sql="""
SELECT DISTINCT c.c_mktsegment, n.n_name, o.o_orderstatus
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def distinct_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o, c, n = t.orders, t.customer, t.nation
    return (o.join(c, c.c_custkey == o.o_custkey).join(n, n.n_nationkey == c.c_nationkey)
            .select("c_mktsegment", "n_name", "o_orderstatus").distinct())


@query("cast_datetime", "O-63", sql="""
WITH e AS (SELECT event_id,
                  CASE WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%d')
                       WHEN event_type = 'error' THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
                       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS fecha_txt FROM events)
SELECT event_id, fecha_txt,
       CASE WHEN regexp_full_match(fecha_txt, '\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}')
            THEN TRY_CAST(fecha_txt AS TIMESTAMP) END AS fecha
FROM e
""")
def cast_datetime(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select(
        "event_id",
        F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd"))
         .when(F.col("event_type") == "error", F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("fecha_txt"))
    return tf.cast_datetime_columns(e.withColumn("fecha", F.col("fecha_txt")), ["fecha"])


@query("cast_numeric", "O-64 O-65", sql="""
SELECT event_id, CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(CASE WHEN event_type = 'view' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS user_id
FROM events
""")
def cast_numeric(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select(
        "event_id", F.col("value").cast("string").alias("value"),
        F.get_json_object("props", "$.k").alias("k"),
        F.when(F.col("event_type") == "view", None).otherwise(F.col("user_id").cast("string")).alias("user_id"))
    e = tf.cast_float_columns(e, ["value"])
    return tf.cast_integer_columns(e, ["k", "user_id", "absent_column"])


@query("cast_string", "O-65b O-74", sql="""
SELECT p_partkey, substring(upper(p_name), 1, 5) AS p_name, substring(upper(CAST(p_size AS VARCHAR)), 1, 5) AS p_size
FROM part
""")
def cast_string(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name", "p_size")
    return tf.cast_string_columns(p, ["p_name", "p_size"], length=5)


@query("cast_bool", "O-65c", sql="""
WITH e AS (SELECT event_id,
                  CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'error' THEN NULL ELSE event_type END AS s,
                  CASE WHEN event_type = 'click' THEN 0 WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE)
                       WHEN event_type = 'view' THEN NULL ELSE value END AS v
           FROM events)
SELECT event_id, COALESCE(s <> '', false) AS s, COALESCE(isnan(v) OR v <> 0, false) AS v FROM e
""")
def cast_bool(spark, sf_dir):
    et = F.col("event_type")
    e = Tables(spark, sf_dir).events.select(
        "event_id",
        F.when(et == "view", "").when(et == "error", None).otherwise(et).alias("s"),
        F.when(et == "click", F.lit(0.0)).when(et == "error", F.lit(float("nan")))
         .when(et == "view", None).otherwise(F.col("value")).alias("v"))
    return tf.cast_bool_columns(e, ["s", "v"])


@query("categorical_codes", "O-62", sql="""
WITH codes AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS BIGINT) AS event_type_code
               FROM (SELECT DISTINCT event_type FROM events))
SELECT e.event_id, e.event_type, c.event_type_code FROM events e JOIN codes c USING (event_type)
""")
def categorical_codes(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("event_id", "event_type")
    return keys.category_codes(e, "event_type", "event_type_code")
