"""Driver queries that write a table with Spark into the shared scratch folder and read it back
through the file operators (O-03..O-05, O-25, O-26, O-28), and the ones about time and key
refreshes (O-87, O-89)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import merge
from ledgerlake.plans import gold
from ledgerlake.plans.registry import query
from ledgerlake.plans.tables import Tables
from ledgerlake.session import scratch_path
from ledgerlake.sources import readers


_scratch = scratch_path


def _csv(spark, df, name: str, sep: str = ",") -> str:
    path = _scratch(spark, name)
    df.write.option("header", True).option("sep", sep).csv(path)
    return path


@query("csv_strict_scan", "O-03", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer
""")
def csv_strict_scan(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_nationkey")
    return readers.csv_strict(spark, _csv(spark, c, "strict"), c.columns)


@query("csv_lenient_scan", "O-04", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ', x' AS c_name,
       CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def csv_lenient_scan(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select(
        "c_custkey", F.concat("c_name", F.lit(", x")).alias("c_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "NA").when(F.col("c_mktsegment") == "FURNITURE", "null")
         .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return readers.csv_lenient(spark, _csv(spark, c, "lenient", ";"), c.columns, sep=";")


@query("typed_seed_scan", "O-05", sql="""
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, o_orderstatus = 'F' AS done,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority
FROM orders
""")
def typed_seed_scan(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias(" id"),
        F.to_date("o_orderdate").cast("string").alias("day"),
        F.when(F.col("o_orderstatus") == "F", "TRUE").otherwise("no").alias("done"),
        F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.col("o_orderpriority")).alias("priority"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()),
                           T.StructField("done", T.BooleanType()), T.StructField("priority", T.StringType())])
    return readers.read_seed(spark, _csv(spark, o, "seed"), schema)


def _rfc_csv(spark, df, name: str, sep: str = ",") -> str:
    """A CSV folder with doubled quotes, quoted separators and quoted line breaks."""
    path = _scratch(spark, name)
    df.write.option("header", True).option("sep", sep).option("escape", '"').option("quoteAll", True).csv(path)
    return path


@query("csv_quoted_reordered", "O-03", sql=r"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, 'say "' || c_name || '", and' || chr(10) || 'a second line' AS c_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def csv_quoted_reordered(spark, sf_dir):
    """A file with its columns in another order, a byte order mark, quotes, separators and line
    breaks inside fields, read by name."""
    c = Tables(spark, sf_dir).customer.select(
        F.when(F.col("c_mktsegment") == "BUILDING", "N/A").otherwise(F.col("c_mktsegment")).alias("\ufeffc_mktsegment"),
        F.format_string('say "%s", and\na second line', "c_name").alias(" c_name "), F.col("c_custkey").cast("string").alias("c_custkey"))
    return readers.csv_strict(spark, _rfc_csv(spark, c, "quoted"), ["c_custkey", "c_name", "c_mktsegment"])


@query("csv_lenient_unknown", "O-04", sql=r"""
SELECT p_name || '; "' || p_brand || '"' AS p_name, CAST(p_partkey AS VARCHAR) AS p_partkey FROM part
""")
def csv_lenient_unknown(spark, sf_dir):
    """A semicolon file with columns nobody declared and the declared ones in another order."""
    p = Tables(spark, sf_dir).part.select(F.lit("x").alias("unused"), "p_partkey", F.lit(None).cast("string").alias("empty"),
                                          F.format_string('%s; "%s"', "p_name", "p_brand").alias("p_name"))
    return readers.csv_lenient(spark, _rfc_csv(spark, p, "unknown", ";"), ["p_name", "p_partkey"], sep=";")


@query("typed_seed_reordered", "O-05", sql=r"""
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, o_orderstatus = 'F' AS done,
       o_orderpriority || ' "' || o_orderstatus || '"' || chr(10) || '-' AS note FROM orders
""")
def typed_seed_reordered(spark, sf_dir):
    """A seed whose columns come in another order than its declared schema."""
    o = Tables(spark, sf_dir).orders.select(
        F.format_string('%s "%s"\n-', "o_orderpriority", "o_orderstatus").alias("\ufeffnote"),
        F.when(F.col("o_orderstatus") == "F", " true ").otherwise("0").alias(" done"),
        F.to_date("o_orderdate").cast("string").alias("day "), F.col("o_orderkey").cast("string").alias("id"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()),
                           T.StructField("done", T.BooleanType()), T.StructField("note", T.StringType())])
    return readers.read_seed(spark, _rfc_csv(spark, o, "reordered"), schema)


@query("materialized_layers", "O-25 O-26 O-28", sql="""
SELECT 'snapshot' AS kind, c_custkey, c_name FROM customer 
UNION ALL SELECT 'view', c_custkey, upper(c_name) FROM customer 
UNION ALL SELECT 'table', c_custkey, lower(c_name) FROM customer
""")
def materialized_layers(spark, sf_dir):
    """A full-refresh snapshot, a view over it and a stored table."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    path, name = _scratch(spark, "snapshot"), f"ledgerlake_{uuid.uuid4().hex[:12]}"
    merge.write_snapshot(c, path)
    stored = spark.read.parquet(path)
    merge.materialize_view(stored.withColumn("c_name", F.upper("c_name")), f"{name}_v")
    merge.materialize_table(stored.withColumn("c_name", F.lower("c_name")), f"{name}_t")
    parts = (("snapshot", stored), ("view", spark.table(f"{name}_v")), ("table", spark.table(f"{name}_t")))
    out = None
    for kind, df in parts:
        part = df.select(F.lit(kind).alias("kind"), "c_custkey", "c_name")
        out = part if out is None else out.unionByName(part)
    return out


@query("load_time_stamp", "O-87 O-24", sql="""
SELECT s_suppkey, true AS is_now, true AS same_stamp FROM supplier
""")
def load_time_stamp(spark, sf_dir):
    """Rows loaded without a given time carry the statement's current time."""
    loaded = merge.with_audit_columns(Tables(spark, sf_dir).supplier.select("s_suppkey"))
    age = F.abs(F.unix_timestamp(F.col("creation_date").cast("timestamp")) - F.unix_timestamp(F.current_timestamp()))
    return loaded.select("s_suppkey", (age < 24 * 3600).alias("is_now"),
                         (F.col("creation_date") == F.col("update_date")).alias("same_stamp"))


@query("dim_refresh_stable_keys", "O-89 M-12", sql="""
WITH old AS (SELECT s_suppkey, row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS id FROM supplier WHERE s_suppkey % 3 = 0),
     fresh AS (SELECT s_suppkey, (SELECT max(id) FROM old) + row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS id
               FROM supplier WHERE s_suppkey % 3 <> 0)
SELECT id AS id_vendedor, CAST(s_suppkey AS VARCHAR) AS codigo_vendedor, upper(s_name) AS nombre_vendedor
FROM (SELECT * FROM old UNION ALL SELECT * FROM fresh) JOIN supplier USING (s_suppkey)
""")
def dim_refresh_stable_keys(spark, sf_dir):
    """Sellers of an earlier snapshot keep their ids, new ones follow."""
    s = Tables(spark, sf_dir).supplier.select(F.col("s_suppkey").cast("string").alias("codigo"),
                                              F.upper("s_name").alias("nombre"), (F.col("s_suppkey") % 3 == 0).alias("known"))
    previous = gold.dim_sellers(s.where("known"))
    return gold.dim_sellers(s, previous)
