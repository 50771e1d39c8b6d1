"""Driver queries for scalar text, regex, money and date functions (O-69..O-88)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.functions import dates, numeric, text
from ledgerlake.operators import transforms as tf
from ledgerlake.plans.registry import query
from ledgerlake.plans.tables import Tables

CENT = Decimal("0.01")


@query("text_trim_upper", "O-69 O-70 O-71", sql="""
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' || c_name || chr(9)
                                  ELSE ' ' || lower(c_name) || chr(10) || ' ' END AS raw FROM customer)
SELECT c_custkey, trim(raw) AS sql_trim,
       upper(regexp_replace(raw, '^\\s+|\\s+$', '', 'g')) AS stripped_upper
FROM c
""")
def text_trim_upper(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("  "), "c_name", F.lit("\t")))
         .otherwise(F.concat(F.lit(" "), F.lower("c_name"), F.lit("\n "))).alias("raw"))
    c = c.withColumn("sql_trim", text.trim_spaces("raw")).withColumn("stripped_upper", F.col("raw"))
    c = tf.upper_columns(tf.trim_text_columns(c, ["stripped_upper"]), ["stripped_upper", "absent"])
    return c.select("c_custkey", "sql_trim", "stripped_upper")


@query("concat_nulls", "O-72", sql="""
WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS seg
           FROM customer)
SELECT c_custkey, concat(c_name, '-', seg) AS pg_style, c_name || '-' || seg AS strict_style FROM c
""")
def concat_nulls(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select(
        "c_custkey", "c_name", F.when(F.col("c_mktsegment") == "BUILDING", None)
                                 .otherwise(F.col("c_mktsegment")).alias("seg"))
    return c.select("c_custkey", text.pg_concat("c_name", F.lit("-"), "seg").alias("pg_style"),
                    text.strict_concat("c_name", F.lit("-"), "seg").alias("strict_style"))


@query("left_slice", "O-74", sql="""
SELECT c_custkey, left(c_name, 10) AS ruc_aux, substring(c_mktsegment, 1, 3) AS seg3 FROM customer
""")
def left_slice(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", text.left("c_name", 10).alias("ruc_aux"), text.left("c_mktsegment", 3).alias("seg3"))


_PLAN_CTE = """
WITH p AS (SELECT p_partkey,
  CASE WHEN p_type = 'PROMO' THEN 'FIRMA ' || CAST(p_size AS VARCHAR) || ' MESES'
       WHEN p_type = 'SMALL' THEN 'FIRMA ' || CAST(p_size AS VARCHAR) || ' MES'
       WHEN p_type = 'LARGE' THEN 'PLAN ' || CAST(p_size AS VARCHAR) || ' ANIOS'
       WHEN p_type = 'MEDIUM' THEN 'PLAN  ILIMITADO'
       ELSE upper(p_name) END AS nombre
  FROM part)
"""


def plan_names(t):
    ty, sz = F.col("p_type"), F.col("p_size").cast("string")
    return t.part.select("p_partkey", (
        F.when(ty == "PROMO", F.concat(F.lit("FIRMA "), sz, F.lit(" MESES")))
        .when(ty == "SMALL", F.concat(F.lit("FIRMA "), sz, F.lit(" MES")))
        .when(ty == "LARGE", F.concat(F.lit("PLAN "), sz, F.lit(" ANIOS")))
        .when(ty == "MEDIUM", F.lit("PLAN  ILIMITADO"))
        .otherwise(F.upper("p_name"))).alias("nombre"))


@query("replace_sub", "O-73", sql=_PLAN_CTE + """
SELECT p_partkey, replace(nombre, 'ANIO', 'ANO') AS nombre, replace(nombre, 'RED', 'ROJO') AS nombre_rojo FROM p
""")
def replace_sub(spark, sf_dir):
    p = plan_names(Tables(spark, sf_dir))
    return p.select("p_partkey", F.replace("nombre", F.lit("ANIO"), F.lit("ANO")).alias("nombre"),
                    F.replace("nombre", F.lit("RED"), F.lit("ROJO")).alias("nombre_rojo"))


# --- fixed values: plan-term patterns (alternatives longest first: POSIX picks the
# longest, Java the first) ----------------------------------------------------------------
TERM_PATTERN = r"(\d+ (MESES|MES|ANIOS|ANIO))"
PLAN_PATTERN = r"^(FIRMA|PLAN)"
# --------------------------------------------------------------------------------------


@query("regex_extract", "O-75", sql=_PLAN_CTE + """
SELECT p_partkey,
       CASE WHEN regexp_matches(nombre, '(\\d+ (MESES|MES|ANIOS|ANIO))') THEN regexp_extract(nombre, '(\\d+ (MESES|MES|ANIOS|ANIO))', 1) END AS vigencia,
       CASE WHEN regexp_matches(nombre, '^(FIRMA|PLAN)') THEN regexp_extract(nombre, '^(FIRMA|PLAN)', 1) END AS tipo_plan
FROM p
""")
def regex_extract(spark, sf_dir):
    p = plan_names(Tables(spark, sf_dir))
    return p.select("p_partkey", text.regex_extract_or_null("nombre", TERM_PATTERN).alias("vigencia"),
                    text.regex_extract_or_null("nombre", PLAN_PATTERN).alias("tipo_plan"))


@query("regex_match", "O-76", sql=_PLAN_CTE + """
SELECT p_partkey, regexp_matches(nombre, '^FIRMA \\d+ MES') AS is_firma_mensual FROM p
""")
def regex_match(spark, sf_dir):
    p = plan_names(Tables(spark, sf_dir))
    return p.select("p_partkey", F.col("nombre").rlike(r"^FIRMA \d+ MES").alias("is_firma_mensual"))


@query("regex_replace", "O-77", sql=_PLAN_CTE + """
SELECT p_partkey, regexp_replace(nombre, '^(FIRMA|PLAN) ', '\\1.CN ') AS nombre_cn FROM p
""")
def regex_replace(spark, sf_dir):
    p = plan_names(Tables(spark, sf_dir))
    return p.select("p_partkey", F.regexp_replace("nombre", r"^(FIRMA|PLAN) ", "$1.CN ").alias("nombre_cn"))


@query("clean_special", "O-78 O-92", sql="""
SELECT conv_id, turn, regexp_replace(strip_accents(replace(text, 'ß', 'ss')), '[\\x00-\\x1F\\x7F]', '', 'g') AS text
FROM conversations
""")
def clean_special(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations.select("conv_id", "turn", "text")
    return tf.clean_special_columns(c, ["text", "absent"])


_NORMALIZE_SQL = ("nullif(trim(regexp_replace(regexp_replace(upper(strip_accents(replace("
                  "regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), 'ß', 'ss'))), '[^A-Z0-9 ]', '', 'g'), ' +', ' ', 'g')), '')")


@query("normalize_text", "O-79 O-92", sql=f"""
SELECT 'documents' AS src, doc_id AS id, {_NORMALIZE_SQL.format(c='text')} AS text FROM documents
UNION ALL
SELECT 'conversations' AS src, conv_id * 1000 + turn AS id, {_NORMALIZE_SQL.format(c='text')} AS text FROM conversations
""")
def normalize_text(spark, sf_dir):
    t = Tables(spark, sf_dir)
    docs = t.documents.select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), "text")
    conv = t.conversations.select(F.lit("conversations").alias("src"),
                                  (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    # whole texts: no length cut
    return tf.normalize_text_columns(docs.unionByName(conv), ["text"], length=None)


_AMOUNTS_CTE = """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS cantidad,
                  CAST(l_extendedprice AS DECIMAL(18, 2)) AS precio,
                  CAST(round(l_discount * 100) AS INTEGER) AS desct,
                  CAST(round(l_tax * 100) AS INTEGER) AS iva FROM lineitem),
a AS (SELECT *, CAST(cantidad * precio * (100 - desct) * 0.01 AS DECIMAL(18, 4)) AS subtotal_articulo,
             CAST(cantidad * precio * desct * 0.01 AS DECIMAL(18, 4)) AS descuento_articulo FROM l)
"""


def line_amounts_frame(t):
    """Line money as ``decimal(18,4)``: narrow on purpose, so that later products stay
    within 38 digits and Spark never trims their scale (which would round twice)."""
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("cantidad"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("precio"),
        F.round(F.col("l_discount") * 100).cast("int").alias("desct"),
        F.round(F.col("l_tax") * 100).cast("int").alias("iva"))
    cent = F.lit(CENT)
    return li.select(
        "*", (F.col("cantidad") * F.col("precio") * (100 - F.col("desct")) * cent)
        .cast("decimal(18,4)").alias("subtotal_articulo"),
        (F.col("cantidad") * F.col("precio") * F.col("desct") * cent).cast("decimal(18,4)")
        .alias("descuento_articulo"))


@query("line_amounts", "O-80", sql=_AMOUNTS_CTE + """
SELECT l_orderkey, l_linenumber, l_partkey, cantidad, precio, desct, subtotal_articulo, descuento_articulo FROM a
""")
def line_amounts(spark, sf_dir):
    return line_amounts_frame(Tables(spark, sf_dir)).drop("iva")


@query("round_half_up", "O-81", sql=_AMOUNTS_CTE + """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(round(subtotal_articulo * iva * 0.01, 2) AS DECIMAL(38, 2)) AS total_iva,
       CAST(round(-descuento_articulo * 0.001, 2) AS DECIMAL(38, 2)) AS neg_rounded,
       CAST(round(subtotal_articulo, 0) AS DECIMAL(38, 0)) AS whole
FROM a
""")
def round_half_up(spark, sf_dir):
    a = line_amounts_frame(Tables(spark, sf_dir))
    return a.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        numeric.round_half_up(F.col("subtotal_articulo") * F.col("iva") * F.lit(CENT), 2)
        .cast("decimal(38,2)").alias("total_iva"),
        numeric.round_half_up(-F.col("descuento_articulo") * F.lit(Decimal("0.001")), 2)
        .cast("decimal(38,2)").alias("neg_rounded"),
        numeric.round_half_up(F.col("subtotal_articulo"), 0).cast("decimal(38,0)").alias("whole"))


@query("month_shift", "O-84 O-83", sql="""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha FROM orders)
SELECT o_orderkey, fecha, CAST(fecha - INTERVAL 1 MONTH AS DATE) AS fecha_shift,
       CAST(last_day(fecha) - INTERVAL 1 MONTH AS DATE) AS month_end_shift
FROM o
""")
def month_shift(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", F.to_date("o_orderdate").alias("fecha"))
    return o.select("o_orderkey", "fecha", dates.month_shift("fecha").alias("fecha_shift"),
                    dates.month_shift(F.last_day("fecha")).alias("month_end_shift"))


@query("date_parts", "O-85", sql="""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha FROM orders)
SELECT o_orderkey, CAST(year(fecha) AS INTEGER) AS year, CAST(month(fecha) AS INTEGER) AS month,
       CAST(day(fecha) AS INTEGER) AS day, CAST(quarter(fecha) AS INTEGER) AS quarter,
       isodow(fecha) IN (6, 7) AS is_weekend
FROM o
""")
def date_parts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", F.to_date("o_orderdate").alias("fecha"))
    f = F.col("fecha")
    return o.select("o_orderkey", F.year(f).alias("year"), F.month(f).alias("month"),
                    F.dayofmonth(f).alias("day"), F.quarter(f).alias("quarter"),
                    dates.is_weekend(f).alias("is_weekend"))


@query("timestamp_text", "O-83", sql="""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') ||
       CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''
            ELSE '.' || rtrim(lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0'), '0') END AS ts_text,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS date_text
FROM events
""")
def timestamp_text(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.select("event_id", dates.timestamp_text("ts").alias("ts_text"),
                    F.to_date("ts").cast("string").alias("date_text"))


# Literal pairs (text, ASCII spelling): punctuation, currency, combining marks, ligatures, fractions,
# Greek, Cyrillic, kana, fullwidth forms, other scripts.
SPELLED = (
    ("\u201cquoted\u201d \u2018x\u2019 \u2013 y \u2014 z\u2026", "\"quoted\" 'x' - y -- z..."),
    ("\u20ac5 \u00a33 \u00a57 \u00a9 \u00ae \u2122 \u00b0C \u00abq\u00bb", "EUR5 PS3 Y=7 (c) (r) TM degC <<q>>"),
    ("Jose\u0301 nin\u0303o u\u0308ber A\u030angstro\u0308m", "Jose nino uber Angstrom"),
    ("\u00c6sir \u0153uvre Stra\u00dfe \u0141\u00f3d\u017a \u00bd \u2167 \ufb01n \u2460", "AEsir oeuvre Strasse Lodz 1/2 VIII fin 1"),
    ("\u0395\u03bb\u03bb\u03b7\u03bd\u03b9\u03ba\u03ac \u03a8\u03c5\u03c7\u03ae \u0398\u03ad\u03c2", "Ellenika Psukhe Thes"),
    ("\u041c\u043e\u0441\u043a\u0432\u0430 \u0429\u0443\u043a\u0430 \u042e\u043b\u0438\u044f \u0439\u043e\u0434 \u0451\u0436",
     "Moskva Shchuka Iuliia iod ezh"),
    ("\u304c\u3064 \u30ab\u30bf \uff21\uff22\uff11 a\u00a0b\u2003c", "gatu kata AB1 a b c"),
    ("\u4e2d\u6587 x \u05d0 y \U0001f600 z", " x  y  z"),
)


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("transliterate_scripts", "O-78 O-79", sql=f"""
SELECT c_custkey, c_name || ' ' || s AS clean, nullif(trim(regexp_replace(regexp_replace(upper(c_name || ' ' || s), '[^A-Z0-9 ]', '', 'g'),
       ' +', ' ', 'g')), '') AS normal
FROM customer JOIN (VALUES {', '.join(f"({i}, {_sql_text(s)})" for i, (_, s) in enumerate(SPELLED))}) AS v(i, s) ON c_custkey % {len(SPELLED)} = i
""")
def transliterate_scripts(spark, sf_dir):
    """Names followed by text in other scripts, cleaned and normalised; the spellings are literals."""
    raw = F.element_at(F.array(*[F.lit(t) for t, _ in SPELLED]), (F.col("c_custkey") % len(SPELLED) + 1).cast("int"))
    c = Tables(spark, sf_dir).customer.select("c_custkey", F.concat_ws(" ", "c_name", raw).alias("t"))
    return c.select("c_custkey", text.clean_special("t").alias("clean"), text.normalize_text("t").alias("normal"))
