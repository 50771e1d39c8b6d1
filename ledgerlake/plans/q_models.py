"""Driver queries for the composite warehouse models (M-01..M-19) on the stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.plans import gold
from ledgerlake.plans.registry import query
from ledgerlake.plans.warehouse import Warehouse
from ledgerlake.plans.warehouse_sql import with_warehouse

_CACHE: dict = {}


def _stamp(spark, sf_dir) -> tuple:
    """Modification times of the input tables, through their Hadoop file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((st.getPath().getName(), st.getModificationTime()) for st in fs.listStatus(path)))


def warehouse(spark, sf_dir, *layers: str) -> Warehouse:
    """One warehouse (layers built once, lineage cut) per session, input directory and state of
    its files, with ``layers`` and all that they read built."""
    key = (spark.sparkContext.applicationId, sf_dir, _stamp(spark, sf_dir))
    if key not in _CACHE:
        _CACHE[key] = Warehouse(spark, sf_dir)
    return _CACHE[key].build(*layers)


def _sel(cols):
    return "SELECT " + ", ".join(cols) + " FROM "


REQ_COLS = ("cedula", "fecha_aprobacion", "numero_factura", "ruc", "tipo_firma", "serial_firma",
            "fecha_inicio_tramite", "ruc_aux", "medio", "sf_control", "producto", "grupo_vendedor", "estado",
            "fecha_factura", "fecha_primer_aprobado", "tipo_venta", "id_tramite", "origen")


@query("request_classification", "M-01 O-37 O-44 O-56 O-59", sql=with_warehouse("SELECT * FROM s_requests"))
def request_classification(spark, sf_dir):
    return warehouse(spark, sf_dir, "s_requests").s_requests().select(*REQ_COLS)


@query("article_classification", "M-02 O-48d O-73 O-75", sql=with_warehouse("SELECT * FROM s_articles"))
def article_classification(spark, sf_dir):
    return warehouse(spark, sf_dir, "s_articles").s_articles()


@query("invoice_silver", "M-05 O-47 O-48f O-51 O-57 O-76 O-77", sql=with_warehouse("SELECT * FROM s_invoices"))
def invoice_silver(spark, sf_dir):
    return warehouse(spark, sf_dir, "s_invoices").s_invoices()


@query("dim_article", "M-08 M-02 O-50 O-89", sql=with_warehouse("SELECT * FROM d_articles"))
def dim_article(spark, sf_dir):
    return warehouse(spark, sf_dir, "d_articles").d_articles()


@query("dim_customer", "M-09 M-03 O-89", sql=with_warehouse("SELECT * FROM d_customers"))
def dim_customer(spark, sf_dir):
    return warehouse(spark, sf_dir, "d_customers").d_customers()


@query("dim_code", "M-10 M-04 O-55 O-73", sql=with_warehouse("SELECT * FROM d_codes"))
def dim_code(spark, sf_dir):
    return warehouse(spark, sf_dir, "d_codes").d_codes()


@query("dim_invoice", "M-11 O-49 O-57 O-58 O-89", sql=with_warehouse("SELECT * FROM d_invoices"))
def dim_invoice(spark, sf_dir):
    return warehouse(spark, sf_dir, "d_invoices").d_invoices()


@query("dim_seller", "M-12 M-07 O-89", sql=with_warehouse("SELECT * FROM d_sellers"))
def dim_seller(spark, sf_dir):
    return warehouse(spark, sf_dir, "d_sellers").d_sellers()


@query("seller_group", "M-14 O-37 O-42 O-48c O-48g O-48i", sql=with_warehouse(
    "SELECT id_factura, codigo_documento, id_articulo, is_nc, grupo_vendedor FROM f_stg"))
def seller_group(spark, sf_dir):
    return warehouse(spark, sf_dir, "staged").staging().select("id_factura", "codigo_documento", "id_articulo", "is_nc",
                                                               "grupo_vendedor")


@query("credit_note_inheritance", "M-14 O-51 O-53", sql=with_warehouse(
    "SELECT id_factura, codigo_documento, id_articulo, is_nc, grupo_vendedor FROM f_nc"))
def credit_note_inheritance(spark, sf_dir):
    stg = warehouse(spark, sf_dir, "staged").staged()
    return gold.expand(gold.inherit_credit_note_group(stg).select("id_factura", "codigo_documento", "id_articulo", "is_nc",
                                                                  "grupo_vendedor", gold.COPIES))


@query("cents_allocation", "M-14 O-60 O-80 O-81 O-82 T-08 T-09", sql=with_warehouse(
    "SELECT id_factura, id_articulo, CAST(suma_subtotales AS DECIMAL(38, 4)) AS suma_subtotales, total_sin_iva, "
    "excluir_ajuste_centavos, subtotal_articulo FROM f_sub"))
def cents_allocation(spark, sf_dir):
    stg = warehouse(spark, sf_dir, "staged").staged()
    x = gold.allocate_cents(gold.inherit_credit_note_group(stg))
    return gold.expand(x.select("id_factura", "id_articulo", F.col("suma_subtotales").cast("decimal(38,4)").alias("suma_subtotales"),
                                "total_sin_iva", "excluir_ajuste_centavos", "subtotal_articulo", gold.COPIES))


@query("fact_billing", "M-14", sql=with_warehouse("SELECT * FROM fact"))
def fact_billing(spark, sf_dir):
    return warehouse(spark, sf_dir, "billed").fact()


@query("mart_agreements_customers", "M-15 O-48 O-55", sql=with_warehouse("SELECT * FROM m_agr_cust"))
def mart_agreements_customers(spark, sf_dir):
    return warehouse(spark, sf_dir, "billed", "d_invoices", "d_customers").m_agreements_customers()


@query("mart_agreements_invoices", "M-16 O-48 O-55", sql=with_warehouse("SELECT * FROM m_agr_inv"))
def mart_agreements_invoices(spark, sf_dir):
    return warehouse(spark, sf_dir, "billed", "d_invoices").m_agreements_invoices()


@query("mart_indirect", "M-17 O-38 O-46", sql=with_warehouse("SELECT * FROM m_indirect"))
def mart_indirect(spark, sf_dir):
    return warehouse(spark, sf_dir, "billed", "d_codes", "d_invoices").m_indirect().withColumn("total_factura", F.col("total_factura").cast("decimal(20,4)"))


@query("mart_agreements_fact", "M-18 O-46", sql=with_warehouse("SELECT * FROM m_agr_fact"))
def mart_agreements_fact(spark, sf_dir):
    return warehouse(spark, sf_dir, "billed", "d_invoices").m_agreements_fact().withColumn("total_factura",
                                                                   F.col("total_factura").cast("decimal(20,4)"))


@query("mart_sales", "M-19 O-48e O-54 O-55 O-58b", sql=with_warehouse("SELECT * FROM m_sales"))
def mart_sales(spark, sf_dir):
    return warehouse(spark, sf_dir, "billed", "d_codes", "d_invoices", "d_articles").m_sales()


@query("silver_customers", "M-03 O-38 O-69 O-71", sql=with_warehouse("SELECT * FROM s_customers"))
def silver_customers(spark, sf_dir):
    return warehouse(spark, sf_dir, "s_customers").s_customers()


@query("silver_codes", "M-04 O-71", sql=with_warehouse("SELECT * FROM s_codes"))
def silver_codes(spark, sf_dir):
    return warehouse(spark, sf_dir, "s_codes").s_codes()


@query("silver_lines", "M-06 O-69", sql=with_warehouse("SELECT * FROM s_lines"))
def silver_lines(spark, sf_dir):
    return warehouse(spark, sf_dir, "s_lines").s_lines()


@query("silver_sellers", "M-07 O-69 O-71", sql=with_warehouse("SELECT * FROM s_sellers"))
def silver_sellers(spark, sf_dir):
    return warehouse(spark, sf_dir, "s_sellers").s_sellers()


from ledgerlake.operators import quality as _dq  # noqa: E402
from ledgerlake.plans import checks as _checks  # noqa: E402


@query("dq_warehouse", "O-94 O-95 O-96 O-97 M-01..M-14", sql=with_warehouse(_checks.check_sql()))
def dq_warehouse(spark, sf_dir):
    """Every declared check on every layer, one report row per check; the NULLs of written layers and
    seeds are those counted while they were written."""
    w = warehouse(spark, sf_dir)
    models = _checks.models(w)
    return _dq.report_in_steps(_checks.WAREHOUSE_CHECKS, models, w.null_counts, _checks.COPIES)
