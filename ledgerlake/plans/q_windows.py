"""Driver queries for aggregations, ordered dedups, partition windows and keys
(O-52..O-60, O-66, O-89)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import aggregates, dedup, keys
from ledgerlake.plans.registry import query
from ledgerlake.plans.tables import Tables


@query("high_water_mark", "O-52", sql="""
SELECT max(ts) AS hwm,
       max(CASE WHEN event_type = 'purchase' THEN ts END) AS hwm_purchase,
       max(CASE WHEN event_type = 'signup' THEN ts END) AS hwm_signup,
       max(CASE WHEN event_type = 'refund' THEN ts END) AS hwm_refund
FROM events
""")
def high_water_mark(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    per_type = aggregates.high_water_mark_by(e, "ts", "event_type", ["purchase", "signup", "refund"])
    # both aggregates scan once: Catalyst merges the two scalar subqueries' sources
    overall = aggregates.high_water_mark_frame(e, "ts", alias="hwm")
    return overall.select("hwm", *[per_type.select(c).scalar().alias(c) for c in per_type.columns])


@query("group_sum_many_keys", "O-54", sql="""
SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
       CAST(l_quantity AS INTEGER) AS cantidad,
       CASE WHEN l_linenumber > 5 THEN NULL ELSE l_linenumber END AS line_bucket,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS total_price,
       CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS total_qty
FROM lineitem GROUP BY ALL
""")
def group_sum_many_keys(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ship_year"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        F.when(F.col("l_linenumber") > 5, None).otherwise(F.col("l_linenumber")).alias("line_bucket"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_quantity").cast("decimal(18,2)").alias("qty"))
    return aggregates.group_sum(
        li, ["l_returnflag", "l_linestatus", "ship_year", "cantidad", "line_bucket"],
        {"total_price": F.sum("price").cast("decimal(38,2)"),
         "total_qty": F.sum("qty").cast("decimal(38,2)")})


_REQ_CTE = """
WITH e AS (SELECT event_id, user_id, event_type,
                  CASE WHEN event_type = 'view' THEN NULL ELSE 'SF-' || CAST(user_id AS VARCHAR) END AS serial_firma,
                  CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS fecha,
                  CASE WHEN event_type = 'purchase' THEN 'NUEVO' WHEN event_type = 'signup' THEN 'RENOVACION' END AS tipo_venta
           FROM events)
"""


def _requests(t):
    et = F.col("event_type")
    return t.events.select(
        "event_id", "user_id", "event_type",
        F.when(et == "view", None).otherwise(F.concat(F.lit("SF-"), F.col("user_id").cast("string")))
         .alias("serial_firma"),
        F.when(et == "error", None).otherwise(F.col("ts")).alias("fecha"),
        F.when(et == "purchase", "NUEVO").when(et == "signup", "RENOVACION").alias("tipo_venta"))


@query("dedup_keep_best", "O-56 O-61d", sql=_REQ_CTE + """
SELECT event_id, serial_firma, fecha, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY serial_firma
      ORDER BY CASE WHEN event_type = 'purchase' THEN 1 ELSE 2 END, fecha DESC NULLS FIRST, event_id) AS rn
  FROM e) WHERE rn = 1
""")
def dedup_keep_best(spark, sf_dir):
    r = _requests(Tables(spark, sf_dir))
    order = [F.when(F.col("event_type") == "purchase", 1).otherwise(2),
             F.col("fecha").desc_nulls_first(), F.col("event_id").asc()]
    return dedup.keep_first(r, ["serial_firma"], order).select("event_id", "serial_firma", "fecha", "event_type")


@query("dedup_keep_first", "O-57", sql=_REQ_CTE + """
SELECT user_id, event_id, fecha FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY fecha ASC NULLS LAST, event_id) AS rn FROM e)
WHERE rn = 1
""")
def dedup_keep_first(spark, sf_dir):
    r = _requests(Tables(spark, sf_dir))
    order = [F.col("fecha").asc_nulls_last(), F.col("event_id").asc()]
    return dedup.keep_first(r, ["user_id"], order).select("user_id", "event_id", "fecha")


@query("dedup_pick_by_value", "O-58", sql=_REQ_CTE + """
SELECT user_id, tipo_venta, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tipo_venta ASC NULLS LAST, event_id) AS rn FROM e)
WHERE rn = 1
""")
def dedup_pick_by_value(spark, sf_dir):
    r = _requests(Tables(spark, sf_dir))
    order = [F.col("tipo_venta").asc_nulls_last(), F.col("event_id").asc()]
    return dedup.keep_first(r, ["user_id"], order).select("user_id", "tipo_venta", "event_id")


@query("drop_duplicates_subset", "O-61b O-66", sql="""
WITH e AS (SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS uid,
                  CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE event_type END AS etype
           FROM events),
nn AS (SELECT * FROM e WHERE NOT (uid IS NULL AND etype IS NULL))
SELECT 'first' AS keep, event_id, uid, etype FROM (
  SELECT *, row_number() OVER (PARTITION BY uid, etype ORDER BY event_id) AS rn FROM nn) WHERE rn = 1
UNION ALL
SELECT 'last' AS keep, event_id, uid, etype FROM (
  SELECT *, row_number() OVER (PARTITION BY uid, etype ORDER BY event_id DESC) AS rn FROM nn) WHERE rn = 1
UNION ALL
SELECT 'none' AS keep, event_id, uid, etype FROM (
  SELECT *, count(*) OVER (PARTITION BY uid, etype) AS n FROM nn) WHERE n = 1
""")
def drop_duplicates_subset(spark, sf_dir):
    et = F.col("event_type")
    e = Tables(spark, sf_dir).events.select(
        "event_id", F.when(et == "view", None).otherwise(F.col("user_id")).alias("uid"),
        F.when(et.isin("view", "click"), None).otherwise(et).alias("etype"))
    out = None
    for keep, label in (("first", "first"), ("last", "last"), (False, "none")):
        d = dedup.drop_duplicates(e, ["uid", "etype"], keep=keep, row_order=["event_id"])
        d = d.select(F.lit(label).alias("keep"), "event_id", "uid", "etype")
        out = d if out is None else out.unionByName(d)
    return out


@query("representative_per_combo", "O-58b", sql="""
WITH p AS (SELECT p_partkey, p_type, p_size, p_brand, split_part(p_name, ' ', 1) AS word FROM part),
rep AS (SELECT p_type, p_size, p_brand, word, p_partkey AS rep_partkey FROM (
          SELECT *, row_number() OVER (PARTITION BY p_type, p_size, p_brand, word ORDER BY p_partkey) AS rn FROM p)
        WHERE rn = 1)
SELECT p.p_partkey, rep.rep_partkey FROM p JOIN rep USING (p_type, p_size, p_brand, word)
""")
def representative_per_combo(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select(
        "p_partkey", "p_type", "p_size", "p_brand", F.split("p_name", " ").getItem(0).alias("word"))
    combo = ["p_type", "p_size", "p_brand", "word"]
    rep = dedup.keep_first(p, combo, [F.col("p_partkey").asc()]).select(
        *combo, F.col("p_partkey").alias("rep_partkey"))
    return p.join(rep, combo).select("p_partkey", "rep_partkey")


@query("conditional_min_window", "O-59", sql="""
WITH e AS (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, ts,
                  CASE WHEN event_type IN ('purchase', 'click') THEN 'FIRMA'
                       WHEN event_type = 'signup' THEN 'SF' ELSE 'OTRO' END AS producto,
                  CASE WHEN event_type IN ('purchase', 'signup') THEN 'APROBADO' ELSE 'NO APROBADO' END AS estado
           FROM events)
SELECT event_id, producto,
       CASE WHEN producto = 'FIRMA' THEN min(CASE WHEN estado = 'APROBADO' THEN ts END) OVER (PARTITION BY user_id, producto)
            WHEN producto = 'SF' THEN min(CASE WHEN estado = 'APROBADO' THEN ts END) OVER (PARTITION BY k, producto)
       END AS primera_aprobacion
FROM e
""")
def conditional_min_window(spark, sf_dir):
    et = F.col("event_type")
    e = Tables(spark, sf_dir).events.select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("long").alias("k"), "ts",
        F.when(et.isin("purchase", "click"), "FIRMA").when(et == "signup", "SF").otherwise("OTRO").alias("producto"),
        F.when(et.isin("purchase", "signup"), "APROBADO").otherwise("NO APROBADO").alias("estado"))
    approved = F.col("estado") == "APROBADO"
    e = aggregates.conditional_min_over(e, ["user_id", "producto"], F.col("ts"), approved, "first_by_person")
    e = aggregates.conditional_min_over(e, ["k", "producto"], F.col("ts"), approved, "first_by_company")
    return e.select("event_id", "producto",
                    F.when(F.col("producto") == "FIRMA", F.col("first_by_person"))
                     .when(F.col("producto") == "SF", F.col("first_by_company")).alias("primera_aprobacion"))


@query("window_sum_share", "O-60 O-82", sql="""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_cents
           FROM lineitem)
SELECT *, CASE WHEN order_cents = 0 THEN 0 ELSE amount_cents / order_cents END AS share FROM (
  SELECT *, CAST(sum(amount_cents) OVER (PARTITION BY l_orderkey) AS BIGINT) AS order_cents FROM l)
""")
def window_sum_share(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("amount_cents"))
    li = aggregates.sum_over(li, ["l_orderkey"], F.col("amount_cents"), "order_cents")
    from ledgerlake.functions.numeric import safe_ratio
    return li.withColumn("order_cents", F.col("order_cents").cast("long")).withColumn(
        "share", safe_ratio(F.col("amount_cents"), F.col("order_cents")).cast("double"))


@query("surrogate_keys", "O-89 T-19", sql="""
SELECT CAST(row_number() OVER (ORDER BY p_brand, p_type) AS BIGINT) AS id_articulo, p_brand, p_type
FROM (SELECT DISTINCT p_brand, p_type FROM part)
""")
def surrogate_keys(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return keys.dense_keys(p, ["p_brand", "p_type"], "id_articulo")
