"""Bronze-shaped stand-ins derived from the test tables.

The warehouse models read the reference's bronze tables and seeds.  Here every one of
them is *derived by Spark* from the test tables (role map: orders = invoice header,
lineitem = invoice line, customer = customer, supplier = seller, part = article,
nation = branch, events = approval requests), so the models' work grows with the data.
``STANDINS_SQL`` is the same derivation for DuckDB (the oracle).

Document convention: order ``2k`` is an invoice, order ``2k+1`` its credit note, both in
document ``k``.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.operators import keys
from ledgerlake.plans.config import WarehouseConfig
from ledgerlake.plans.tables import Tables

# --- fixed values ------------------------------------------------------------------
# The configuration of the stand-in data: invented customers and tax ids, the labels and
# default code rows of the source system.
CONFIG = WarehouseConfig(
    corporate_cifs=("CORP1", "CORP2", "CORP3"), commercial_customers=(("7", dt.date(1998, 1, 1)),),
    special_customers=("13",), special_group="GRUPO ESPECIAL", corporate_group="LICENCIAS CORPORATIVAS",
    default_group="GRUPO SECURITY DATA", manual_code="MANUAL.FACT.MANUAL", agreement_code="CONVE.FACT.MANUAL")
# -----------------------------------------------------------------------------------

_VAT_RATE = Decimal("0.12")


def half_key(c) -> Column:
    """Document number of an order: ``key div 2`` (integral, exact for any long)."""
    return F.call_function("div", F.col(c) if isinstance(c, str) else c, F.lit(2))


def invoice_number(orderkey: Column) -> Column:
    return F.when(orderkey % 2 == 1, F.concat(F.lit("DV"), orderkey.cast("string"))) \
        .otherwise(F.concat(F.lit("FA"), orderkey.cast("string")))


def article_code(partkey: Column, ptype: Column, size: Column) -> Column:
    return F.when((ptype == "PROMO") & (size > 40), F.concat(F.lit("SF.MAN."), partkey.cast("string"))) \
        .otherwise(F.concat(F.lit("ART"), F.lpad(partkey.cast("string"), 6, "0")))


def bronze_invoices(t: Tables):
    o, c = t.orders, t.customer
    j = o.join(c, c.c_custkey == o.o_custkey)
    k, prio, st = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    nat = F.col("c_nationkey").cast("string")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    iva = F.when((prio == "4-NOT SPECIFIED") & (st == "O"), F.lit(Decimal("0.00"))) \
        .otherwise(F.round(price * F.lit(_VAT_RATE), 2)).cast("decimal(18,2)")
    return j.select(
        k.alias("id_numfac"), invoice_number(k).alias("numfac"),
        F.when((prio == "5-LOW") & (st == "P"), F.lit("")).otherwise(half_key(k).cast("string")).alias("numdoc"),
        F.col("o_custkey").cast("string").alias("cliente"),
        F.concat(F.lit("00"), nat).alias("numser"),
        F.lpad(k.cast("string"), 9, "0").alias("pedido"),
        prio.alias("comen1"),
        F.when(prio == "1-URGENT", F.concat(F.lit("cod descuento ALIANZA"), nat))
         .when(prio == "2-HIGH", F.concat(F.lit("renovacion agente "), st))
         .when(prio == "3-MEDIUM", F.concat(F.lit("CODDESCUENTO FEUE"), nat, F.lit(" renovacion")))
         .otherwise(F.lit(" venta directa ")).alias("comen2"),
        F.when(st == "F", F.concat(F.lit("firma."), F.lower("c_mktsegment"), F.lit(".std")))
         .when((st == "O") & (F.col("c_acctbal") > 5000), F.lit("comercial norte"))
         .when(st == "O", F.lit("tercero distribuidor"))
         .when(F.col("c_acctbal") < 0, F.concat(F.lit("adicional "), nat, F.lit(" comprobantes")))
         .otherwise(F.lit("agente externo")).alias("comen3"),
        price.alias("subtotal"),
        F.lit(Decimal("0.00")).cast("decimal(18,2)").alias("desc0"),
        iva.alias("total_iva"),
        (price + iva).cast("decimal(18,2)").alias("total"),
        F.when(prio == "4-NOT SPECIFIED", F.lit("NO")).otherwise(nat).alias("codven"),
        F.col("o_orderdate").alias("emision"),
        F.col("o_orderdate").alias("fecha_hora"))


def bronze_lines(t: Tables):
    li, p = t.lineitem, t.part
    j = li.join(p, p.p_partkey == li.l_partkey)
    tax = F.col("l_tax")
    return j.select(
        F.col("l_orderkey").alias("id_tranfac"),
        F.col("l_linenumber").cast("string").alias("unico"),
        invoice_number(F.col("l_orderkey")).alias("numfac"),
        article_code(F.col("p_partkey"), F.col("p_type"), F.col("p_size")).alias("codart"),
        F.col("l_quantity").cast("int").alias("cantidad_d"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("precio"),
        F.round(F.col("l_discount") * 100).cast("int").alias("desct"),
        F.when(tax == 0, 0).when(tax < 0.05, 12).otherwise(15).alias("iva"))


def bronze_customers(t: Tables):
    c = t.customer
    return c.select(
        F.col("c_custkey").cast("string").alias("codcli"), F.col("c_name").alias("nomcli"),
        F.when(F.col("c_acctbal") > 9900, F.concat(F.lit("CORP"), F.col("c_nationkey").cast("string")))
         .otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit("001"))).alias("cif"))


def bronze_sellers(t: Tables):
    return t.supplier.select(F.col("s_suppkey").alias("id_codven"), F.col("s_suppkey").cast("string").alias("codven"),
                             F.col("s_name").alias("nomven"))


def bronze_articles(t: Tables):
    p = t.part
    ty, sz, name = F.col("p_type"), F.col("p_size").cast("string"), F.upper("p_name")
    nomart = (F.when(F.col("p_name").like("hot%"), F.concat(F.lit("upgrade "), F.col("p_name")))
              .when(F.col("p_name").like("cold%"), F.concat(F.lit("punto de emision "), F.col("p_name")))
              .when(ty == "PROMO", F.concat(name, F.lit(" FIRMA ELEC "), sz, F.lit(" MESES")))
              .when(ty == "SMALL", F.concat(name, F.lit(" FACT "), (F.col("p_size") * 25).cast("string"), F.lit(" TRANSACC")))
              .when(ty == "LARGE", F.concat(name, F.lit(" FIRMA ELEC "), sz, F.lit(" ANIOS")))
              .when(ty == "MEDIUM", F.concat(name, F.lit(" FACT PLAN  ILIMITADO")))
              .otherwise(F.concat(F.lit(" "), name, F.lit(" "))))
    nomart2 = F.when(ty == "STANDARD", F.lit("licencias")).when(ty == "ECONOMY", F.lit("sistema facturacion")) \
        .otherwise(F.lit(" "))
    return p.select(F.col("p_partkey").alias("id_codart"),
                    article_code(F.col("p_partkey"), ty, F.col("p_size")).alias("codart"),
                    nomart.alias("nomart"), nomart2.alias("nomart2"))


def article_corrections(t: Tables):
    """Seed ``fenix_articulos_corregidos``: corrections of existing codes and rows for
    codes that exist only here (full-outer override)."""
    p = t.part.where(F.col("p_size") == 50)
    existing = p.select(
        article_code(F.col("p_partkey"), F.col("p_type"), F.col("p_size")).alias("codigo"),
        F.concat(F.lit("CORREGIDO "), F.upper("p_name")).alias("nombre"),
        F.lit("1 ANO").alias("vigencia"), F.lit("FIRMAS ELECTRONICAS").alias("familia"),
        F.lit(None).cast("string").alias("tipo_plan"),
        F.concat(F.lit(" concepto "), F.col("p_brand")).alias("concepto"))
    only_here = p.select(
        F.concat(F.lit("SF.MAN.X"), F.col("p_partkey").cast("string")).alias("codigo"),
        F.concat(F.lit("MANUAL "), F.upper("p_name")).alias("nombre"),
        F.lit("1 ANO").alias("vigencia"), F.lit("SISTEMA DE FACTURACION").alias("familia"),
        F.lit("PLAN MANUAL").alias("tipo_plan"), F.lit("CONCEPTO MANUAL").alias("concepto"))
    return existing.unionByName(only_here)


def bronze_codes(t: Tables):
    """Code catalogue: one code per customer segment plus the two default codes."""
    seg = t.customer.select("c_mktsegment").distinct()
    s = F.col("c_mktsegment")
    from_data = seg.select(
        F.concat(F.lit(" firma."), F.lower(s), F.lit(".std")).alias("codigo"),
        F.concat(F.lit("firma "), F.lower(s)).alias("codigo_nombre"),
        F.when(s.isin("BUILDING", "MACHINERY"), F.lit("FIRMAS ELECTRONICAS"))
         .otherwise(F.lit("sistema de facturacion")).alias("familia_producto"),
        F.when(s == "FURNITURE", F.lit("convenios")).otherwise(F.lit("directa")).alias("atencion"),
        F.lit("no").alias("venta_dirigida"),
        F.concat(F.lit("concepto "), F.lower(s)).alias("concepto_1"),
        F.when(s == "BUILDING", F.lit("nuevo")).alias("concepto_2"),
        F.when(s == "HOUSEHOLD", F.lit("PLAN MANUAL")).otherwise(F.lit("plan anual")).alias("plan"),
        F.lit("vigencia 1 ano").alias("vigencia"))
    defaults = seg.where(s == "BUILDING").select(
        F.explode(F.array(F.lit(CONFIG.manual_code), F.lit(CONFIG.agreement_code))).alias("codigo"),
        F.lit("manual").alias("codigo_nombre"), F.lit("SISTEMA DE FACTURACION").alias("familia_producto"),
        F.lit("directa").alias("atencion"), F.lit("no").alias("venta_dirigida"),
        F.lit("concepto manual").alias("concepto_1"), F.lit(None).cast("string").alias("concepto_2"),
        F.lit("PLAN MANUAL").alias("plan"), F.lit("vigencia 1 ano").alias("vigencia"))
    codes = from_data.unionByName(defaults)
    ids = keys.dense_keys(codes, ["codigo"], "id_codigo")
    return codes.join(ids, "codigo")


def bronze_requests(t: Tables):
    """Approval requests (``camunda_operatividad``) from events; request ``i`` refers to
    order ``i``'s invoice number."""
    e, o, c = t.events, t.orders, t.customer
    j = e.join(o, o.o_orderkey == e.event_id).join(c, c.c_custkey == o.o_custkey)
    et, v = F.col("event_type"), F.col("value")
    k = F.get_json_object("props", "$.k").cast("long")
    return j.select(
        F.col("event_id").cast("int").alias("id_tramite"),
        F.lit("CAMUNDA").alias("origen"),
        F.when(et == "view", None).otherwise(
            F.concat(F.lit("sf"), F.col("user_id").cast("string"), F.lit("-"),
                     F.call_function("div", k, F.lit(25)).cast("string")))
         .alias("serial_firma"),
        F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("cedula"),
        F.when(et == "error", None).otherwise(F.col("ts")).alias("fecha_aprobacion"),
        F.concat(F.lit("00"), F.col("c_nationkey").cast("string"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
         .alias("factura"),
        F.concat(F.lit("ruc"), k.cast("string")).alias("ruc"),
        F.lit("persona natural").alias("tipo_firma"),
        F.col("ts").alias("fecha_inicio_tramite"),
        F.concat(F.lit("ra"), k.cast("string")).alias("ruc_aux"),
        F.when(v < 20, F.lit(" token")).otherwise(F.lit("archivo")).alias("medio"),
        k.cast("int").alias("sf_control"),
        F.when(et == "purchase", F.lit("emision")).when(et == "click", F.lit("RENOVACION"))
         .when(et == "signup", F.lit("sf con firma")).when(et == "error", F.lit("EMISION SF"))
         .otherwise(F.lit("otro producto")).alias("producto"),
        F.when(v > 80, F.lit("grupo portal")).when(v > 60, F.lit("GRUPO WEB")).alias("grupo_vendedor"),
        F.when(v > 30, F.lit("APROBADO")).otherwise(F.lit("NO APROBADO")).alias("estado"),
        F.when(et == "click", None).otherwise(F.col("o_orderdate")).alias("fecha_factura"))


def emission_points(t: Tables):
    """``puntos_emision``: two validity intervals per branch series (none for one region)."""
    n, r = t.nation, t.region
    nat = n.join(r, (r.r_regionkey == n.n_regionkey) & (r.r_name != "ASIA"))
    serial = F.concat(F.lit("00"), F.col("n_nationkey").cast("string"))
    first = nat.select((F.col("n_nationkey") + 100).cast("int").alias("id_sucursal"),
                       F.lit(dt.date(1990, 1, 1)).alias("fecha_apertura"),
                       F.lit(dt.date(2000, 1, 1)).alias("fecha_cierre"), serial.alias("serial_punto_emision"))
    second = nat.select((F.col("n_nationkey") + 500).cast("int").alias("id_sucursal"),
                        F.lit(dt.date(2000, 1, 1)).alias("fecha_apertura"),
                        F.lit(dt.date(2010, 1, 1)).alias("fecha_cierre"), serial.alias("serial_punto_emision"))
    return first.unionByName(second)


def _numero_factura(t: Tables, where: Column):
    o, c = t.orders, t.customer
    return o.join(c, c.c_custkey == o.o_custkey).where(where).select(
        F.concat(F.lit("00"), F.col("c_nationkey").cast("string"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
        .alias("numero_factura"))


BRONZE_NAMES = ("fenix_facturas", "fenix_tranfac", "fenix_clientes", "fenix_vendedores", "fenix_articulos",
                "fenix_codigos", "camunda_operatividad")
SEED_NAMES = ("articulos_comercial", "vendedores_comercial", "vendedores_agentes", "reasignacion_comercial",
              "reasignacion_grupo_vendedor", "reasignacion_distribuidores", "reasignacion_subtotal",
              "reasignacion_articulos_comercial", "reasignacion_periodo_fiscal", "reasignacion_islas_temporales",
              "facturas_excluidas", "fenix_articulos_corregidos", "puntos_emision")


def seeds(t: Tables) -> dict:
    """Every seed of the models, derived from the tables."""
    p, s, c, o = t.part, t.supplier, t.customer, t.orders
    code = article_code(F.col("p_partkey"), F.col("p_type"), F.col("p_size"))
    prio, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    start = F.date_add(F.lit(dt.date(1996, 1, 1)), F.col("s_nationkey") * 30)
    auto = c.where(F.col("c_mktsegment") == "AUTOMOBILE")
    return {
        "articulos_comercial": p.where(F.col("p_size") >= 45).select(
            code.alias("codigo_articulo"), (F.col("p_size") >= 48).alias("verificacion_vendedor")),
        "vendedores_comercial": s.where(F.col("s_acctbal") > 5000).select(
            F.col("s_suppkey").cast("string").alias("codigo_vendedor"), start.alias("fecha_inicio"),
            F.date_add(start, 1000).alias("fecha_fin")),
        "vendedores_agentes": s.where(F.col("s_acctbal") < 0).select(
            F.concat(F.lit("AGENTE "), F.col("s_name")).alias("agente"),
            F.col("s_suppkey").cast("string").alias("codigo_vendedor")),
        "reasignacion_comercial": o.where((prio == "1-URGENT") & (st == "F") & (F.col("o_totalprice") > 300000))
        .select(half_key("o_orderkey").cast("string").alias("codigo_documento"), F.lit("REVISION").alias("motivo")).distinct(),
        "reasignacion_grupo_vendedor": o.where(F.col("o_totalprice") > 450000).select(
            half_key("o_orderkey").cast("string").alias("codigo_documento"),
            F.lit("GRUPO ASIGNADO").alias("grupo_asignado")).distinct(),
        "reasignacion_distribuidores": auto.select(
            F.col("c_custkey").cast("string").alias("codigo_cliente"),
            F.lit("GRUPO DISTRIBUIDOR A").alias("grupo_vendedor_reasignado"),
            F.lit(dt.date(1997, 1, 1)).alias("fecha_cambio")).unionByName(auto.select(
                F.col("c_custkey").cast("string").alias("codigo_cliente"),
                F.lit("GRUPO DISTRIBUIDOR B").alias("grupo_vendedor_reasignado"),
                F.lit(dt.date(1999, 1, 1)).alias("fecha_cambio"))),
        "reasignacion_subtotal": _numero_factura(t, (prio == "3-MEDIUM") & (st == "P")),
        "reasignacion_articulos_comercial": p.where(F.col("p_name").like("hot%") & (F.col("p_size") < 5)).select(
            code.alias("codigo_articulo"), F.lit(dt.date(1998, 1, 1)).alias("fecha_cambio")),
        "reasignacion_periodo_fiscal": _numero_factura(t, (F.dayofmonth("o_orderdate") == 1) | (prio == "5-LOW")),
        "reasignacion_islas_temporales": _numero_factura(t, (prio == "2-HIGH") & (st == "O")).select(
            "numero_factura", F.lit(99).alias("id_sucursal")),
        "facturas_excluidas": t.lineitem.where((F.col("l_tax") == 0) & (F.col("l_discount") == 0.1)).select(
            invoice_number(F.col("l_orderkey")).alias("codigo_factura")).distinct()
        .withColumn("motivo", F.lit("FACTURA CON IVA 0")),
        "fenix_articulos_corregidos": article_corrections(t).withColumns(
            {c: F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") for c in ("creation_date", "update_date")}),
        "puntos_emision": emission_points(t),
    }


def bronze(t: Tables) -> dict:
    return {"fenix_facturas": bronze_invoices(t), "fenix_tranfac": bronze_lines(t),
            "fenix_clientes": bronze_customers(t), "fenix_vendedores": bronze_sellers(t),
            "fenix_articulos": bronze_articles(t), "fenix_codigos": bronze_codes(t),
            "camunda_operatividad": bronze_requests(t)}
