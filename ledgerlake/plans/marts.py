"""Reporting marts (M-15..M-19), views over the fact and its dimensions.  The fact may be compact
(``gold.COPIES``); the marts' rows never are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import dedup, joins
from ledgerlake.plans.config import WarehouseConfig
from ledgerlake.plans.gold import AGREEMENT_GROUP, INVOICED, copies_of, expand

# --- fixed values ------------------------------------------------------------------
BILLING_FAMILY = "SISTEMA DE FACTURACION"
MANUAL_SF_PREFIX = "SF.MAN."
SALES_KEYS = ("id_factura", "fecha_emision", "fecha_emision_fenix", "id_cliente", "id_vendedor", "id_sucursal",
              "id_codigo", "grupo_vendedor", "id_articulo", "cantidad_articulos")
# -----------------------------------------------------------------------------------


def _with_total(fact: DataFrame) -> DataFrame:
    return fact.withColumn("total_factura", F.col("subtotal_articulo") + F.col("total_iva"))


def agreements_customers(dinv: DataFrame, fact: DataFrame, dcli: DataFrame) -> DataFrame:
    """M-15: distinct customers with agreement lines on invoiced documents."""
    f = fact.where(F.col("grupo_vendedor") == AGREEMENT_GROUP).select("id_factura", "id_cliente")
    d = dinv.where(F.col("estado_factura") == INVOICED).select(F.col("id_factura").alias("__df_id"))
    there = f.join(d, F.col("id_factura") == F.col("__df_id"), "left_semi").select(F.col("id_cliente").alias("__f_id"))
    return dcli.join(there, F.col("id_cliente") == F.col("__f_id"), "left_semi").select(
        "id_cliente", *[c for c in dcli.columns if c != "id_cliente"]).distinct()


def agreements_invoices(dinv: DataFrame, fact: DataFrame) -> DataFrame:
    """M-16: distinct invoice rows with agreement lines."""
    f = fact.where(F.col("grupo_vendedor") == AGREEMENT_GROUP).select(F.col("id_factura").alias("__f_id"))
    return dinv.join(f, dinv.id_factura == F.col("__f_id"), "left_semi").distinct()


def indirect_channel(fact: DataFrame, dco: DataFrame, dinv: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    """M-17: lines of indirect groups (a line without a code, or with a NULL group, drops)."""
    c = dco.select(F.col("id_codigo").alias("__dc_id"))
    d = dinv.select(F.col("id_factura").alias("__df_id"))
    lines = fact.where(~F.col("grupo_vendedor").isin(*cfg.direct_groups))
    j = lines.join(c, F.col("id_codigo") == F.col("__dc_id")).join(d, F.col("id_factura") == F.col("__df_id"))
    return expand(_with_total(j.select(*fact.columns)))


def agreements_fact(fact: DataFrame, dinv: DataFrame) -> DataFrame:
    """M-18."""
    d = dinv.select(F.col("id_factura").alias("__df_id"))
    j = fact.join(d, fact.id_factura == F.col("__df_id")).where(F.col("grupo_vendedor") == AGREEMENT_GROUP)
    return expand(_with_total(j.select(*fact.columns)))


def sales(fact: DataFrame, dco: DataFrame, dinv: DataFrame, dart: DataFrame,
          expect_unique: bool = False) -> DataFrame:
    """M-19: billing-system lines re-pointed to a representative manual article with the
    same four attributes, then re-aggregated (quantity is a grouping key).

    The invoice -> article map is joined by invoice only, so an invoice with two billing
    codes of different attributes fans out, as in the source model (T-07);
    ``expect_unique=True`` makes the query fail there instead."""
    attrs = ["vigencia", "familia", "tipo_plan", "concepto"]
    reps = dedup.keep_first(dart.where(F.col("codigo_articulo").like(MANUAL_SF_PREFIX + "%")), attrs,
                            [F.col("id_articulo").asc()]).select(*attrs, F.col("id_articulo").alias("id_articulo_sf"))
    dc = dco.select(F.col("id_codigo").alias("__dc_id"), F.col("vigencia").alias("__dc_vig"),
                    F.col("familia_producto").alias("__dc_fam"), F.col("plan").alias("__dc_plan"),
                    F.col("concepto_1").alias("__dc_c1"))
    d = dinv.select(F.col("id_factura").alias("__df_id"))
    sf_invoices = (fact.join(dc.where(F.col("__dc_fam") == BILLING_FAMILY), fact.id_codigo == F.col("__dc_id"))
                   .join(d, fact.id_factura == F.col("__df_id"), "left_semi")
                   .select(F.col("id_factura").alias("__sf_id"), "__dc_vig", "__dc_fam", "__dc_plan", "__dc_c1")
                   .distinct())
    sf_with_article = sf_invoices.join(
        reps, (F.col("vigencia") == F.col("__dc_vig")) & (F.col("familia") == F.col("__dc_fam"))
        & (F.col("tipo_plan") == F.col("__dc_plan")) & (F.col("concepto") == F.col("__dc_c1"))
    ).select("__sf_id", "id_articulo_sf")
    if expect_unique:
        sf_with_article = joins.expect_unique(sf_with_article, ["__sf_id"], "invoice -> SF article map")
    pre = (fact.join(dc.select("__dc_id", F.col("__dc_fam").alias("__fam")), fact.id_codigo == F.col("__dc_id"))
           .join(sf_with_article, fact.id_factura == F.col("__sf_id"), "left"))
    pre = pre.withColumn("id_articulo", F.when(F.col("__sf_id").isNotNull() & (F.col("__fam") == BILLING_FAMILY),
                                               F.col("id_articulo_sf")).otherwise(F.col("id_articulo")))
    copies = copies_of(fact).cast("decimal(19,0)")
    return pre.groupBy(*SALES_KEYS).agg(*[F.sum(F.col(c) * copies).cast("decimal(38,4)").alias(c)
                                          for c in ("valor_unitario", "subtotal_articulo")])
