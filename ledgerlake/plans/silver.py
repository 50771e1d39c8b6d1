"""Silver layer (M-01..M-07): cleansing, classification and per-document enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import text
from ledgerlake.operators import dedup, joins

# --- fixed values ------------------------------------------------------------------
# Request product spellings mapped to the two product lines.
SF_PRODUCTS = ("EMISION SF SIN FIRMA", "RENOVACION SF SIN FIRMA", "SF SIN FIRMA", "SF CON FIRMA",
               "RENOVACION SF", "EMISION SF")
SIGNATURE_PRODUCTS = ("EMISION", "RENOVACION")
# Seller codes that mean "no seller" and the default seller they map to.
NO_SELLER_CODES = ("0", "28", "123", "NO")
DEFAULT_SELLER = "1001"
# Article name patterns (POSIX leftmost-longest is emulated by ordering alternatives
# longest first for Java regex).
TERM_PATTERN = r"([0-9]+\s+(MESES|MES|ANOS|ANO|SEMANAS|SEMANA))"
PLAN_PATTERN = r"([0-9]+\s+TRANSACC|PLAN\s+ILIMITADO)"
PLAN_NAMES = (("25 TRANSACC", "PLAN MINI"), ("75 TRANSACC", "PLAN BASICO"),
              ("150 TRANSACC", "PLAN ESENCIAL"), ("350 TRANSACC", "PLAN ESTANDAR"),
              ("PLAN ILIMITADO", "PLAN PREMIUM"))
DISCOUNT_CODE_PATTERN = r"COD ?DESCUENTO\s+(\S+)"
NO_DISCOUNT_CODE = "SIN CODIGO DE DESCUENTO"
AGREEMENT_MARKERS = ("ALIANZA", "COLEGIOABOGADO", "ANAMER", "FEUE")
EXTRA_VOUCHERS_PATTERN = "^ADICIONAL [0-9]+ COMPROBANTES$"
EXTRA_VOUCHERS_CODE = "SF.CA.MANUAL"
# Comment prefixes that mean "commercial" (the first one is a misspelling that occurs in
# the source data and is matched on purpose).
COMMERCIAL_COMMENT_PREFIXES = ("COEMRCIAL", "COMERCIAL")
# -----------------------------------------------------------------------------------


def _ut(c):
    return F.trim(F.upper(F.col(c)))


def requests(ops: DataFrame) -> DataFrame:
    """M-01 silver.camunda_operatividad."""
    prod = _ut("producto")
    cleaned = ops.select(
        _ut("cedula").alias("cedula"),
        F.coalesce("fecha_aprobacion", "fecha_inicio_tramite").alias("fecha_aprobacion"),
        _ut("factura").alias("numero_factura"), _ut("ruc").alias("ruc"),
        _ut("tipo_firma").alias("tipo_firma"), _ut("serial_firma").alias("serial_firma"),
        "fecha_inicio_tramite", _ut("ruc_aux").alias("ruc_aux"),
        F.when(_ut("medio") == "TOKEN", "TOKEN").otherwise("ARCHIVO").alias("medio"),
        "sf_control",
        F.when(prod.isin(*SF_PRODUCTS), "SF").when(prod.isin(*SIGNATURE_PRODUCTS), "FIRMA")
         .otherwise(prod).alias("producto"),
        _ut("grupo_vendedor").alias("grupo_vendedor"), "estado", "fecha_factura",
        "id_tramite", "origen")
    approved = F.col("estado") == "APROBADO"
    # first approval per (cedula, product) for FIRMA and per (ruc_aux, product) for SF, as a
    # mapping relation; other products have none and stay out of the join
    in_line = F.coalesce(F.col("producto").isin("FIRMA", "SF"), F.lit(False))
    holder = F.when(F.col("producto") == "FIRMA", F.col("cedula")).otherwise(F.col("ruc_aux"))
    lined = cleaned.where(in_line).withColumn("__holder", holder)
    first = (lined.where(approved).groupBy(F.col("producto").alias("__line"), F.col("__holder").alias("__who"))
             .agg(F.min("fecha_aprobacion").alias("fecha_primer_aprobado")))
    lined = lined.join(first, (F.col("producto") == F.col("__line")) & F.col("__holder").eqNullSafe(F.col("__who")),
                       "left").drop("__line", "__who", "__holder")
    cleaned = lined.unionByName(cleaned.where(~in_line).withColumn("fecha_primer_aprobado",
                                                                  F.lit(None).cast(ops.schema["fecha_aprobacion"].dataType)))
    fa, fp, ff, fi = (F.col(c) for c in ("fecha_aprobacion", "fecha_primer_aprobado", "fecha_factura",
                                         "fecha_inicio_tramite"))
    not_ok = F.col("estado") != "APROBADO"
    tipo = (F.when(approved & (fa == fp), "NUEVO")
            .when(approved & (fa > fp), "RENOVACION")
            .when(not_ok & (ff < fp), "NUEVO")
            .when(not_ok & (ff > fp), "RENOVACION")
            .when(not_ok & ff.isNull() & (fi < fp), "NUEVO")
            .when(not_ok & ff.isNull() & (fi > fp), "RENOVACION")
            .when(fp.isNull(), "NUEVO")
            .otherwise("N/A"))
    enriched = cleaned.withColumn("tipo_venta", tipo)
    # keep the best request per serial: approved first, newest approval first (PG: DESC
    # NULLS FIRST), then the source key as tie-break (T-01, T-02)
    order = [F.when(approved, 1).otherwise(2), F.col("fecha_aprobacion").desc_nulls_first(),
             F.col("origen").asc_nulls_last(), F.col("id_tramite").asc_nulls_last(),
             F.col("numero_factura").asc_nulls_last()]
    best = dedup.keep_first(enriched, ["serial_firma"], order)
    return best.select("cedula", "fecha_aprobacion", "numero_factura", "ruc", "tipo_firma", "serial_firma",
                       "fecha_inicio_tramite", "ruc_aux", "medio", "sf_control", "producto",
                       "grupo_vendedor", "estado", "fecha_factura", "fecha_primer_aprobado", "tipo_venta",
                       "id_tramite", "origen")


def articles(art: DataFrame, corrections: DataFrame) -> DataFrame:
    """M-02 silver.fenix_articulos."""
    cleaned = art.select(F.trim("codart").alias("codigo"),
                         F.replace(_ut("nomart"), F.lit("ANIO"), F.lit("ANO")).alias("nombre"),
                         text.blank_to_null(F.upper("nomart2")).alias("aux_familia"))
    parsed = cleaned.withColumn("vigencia", text.regex_extract_or_null("nombre", TERM_PATTERN)) \
        .withColumn("aux_tipo_plan", text.regex_extract_or_null("nombre", PLAN_PATTERN))
    n, v, tp, af = F.col("nombre"), F.col("vigencia"), F.col("aux_tipo_plan"), F.col("aux_familia")
    familia = (F.when(n.like("UPGRADE%"), "UPGRADE")
               .when(n.like("PUNTO DE EMISION%"), "PUNTO DE EMISION")
               .when(n.like("%FIRMA ELEC%") & v.isNotNull(), "FIRMAS ELECTRONICAS")
               .when(tp.isNotNull() & n.like("%FACT%"), "SISTEMA DE FACTURACION")
               .when(af == "SISTEMA FACTURACION", "SISTEMA DE FACTURACION")
               .otherwise(af))
    plan = None
    for raw, name in PLAN_NAMES:
        plan = (F.when(tp == raw, name) if plan is None else plan.when(tp == raw, name))
    plan = plan.when(tp.like("%TRANSACC"), F.concat(F.lit("PLAN "), tp)).otherwise(tp)
    enriched = parsed.select("codigo", "nombre", "vigencia", familia.alias("familia"), plan.alias("tipo_plan"))
    corr = corrections.select(*[F.trim(c).alias(c) for c in
                                ("codigo", "nombre", "vigencia", "familia", "tipo_plan", "concepto")])
    # concepto exists only in the corrections: coalesce(corrections.concepto, NULL)
    return joins.full_override(enriched.withColumn("concepto", F.lit(None).cast("string")), corr, "codigo",
                               ["nombre", "vigencia", "familia", "tipo_plan", "concepto"])


def customers(cli: DataFrame, corporate_cifs) -> DataFrame:
    """M-03 silver.fenix_clientes (the group test runs on the untrimmed tax id)."""
    return cli.select(F.trim("codcli").alias("codigo"), _ut("nomcli").alias("nombre"),
                      F.trim("cif").alias("cif"),
                      F.coalesce(F.col("cif").isin(*corporate_cifs), F.lit(False)).alias("is_same_corporate_group"))


CODE_ATTRS = ("codigo", "codigo_nombre", "familia_producto", "atencion", "venta_dirigida", "concepto_1",
              "concepto_2", "plan", "vigencia")


def codes(cod: DataFrame) -> DataFrame:
    """M-04 silver.fenix_codigos."""
    return cod.select("id_codigo", *[F.upper(F.trim(c)).alias(c) for c in CODE_ATTRS])


def lines(tr: DataFrame) -> DataFrame:
    """M-06 silver.fenix_tranfac."""
    return tr.select(F.trim("unico").alias("unico"), F.trim("numfac").alias("codigo_factura"),
                     F.trim("codart").alias("codigo_articulo"), F.col("cantidad_d").alias("cantidad_articulos"),
                     F.col("precio").alias("valor_unitario"), F.col("desct").alias("porcentaje_descuento"),
                     F.col("iva").alias("porcentaje_iva"))


def sellers(ven: DataFrame) -> DataFrame:
    """M-07 silver.fenix_vendedores."""
    return ven.select(F.trim("codven").alias("codigo"), _ut("nomven").alias("nombre"))


def first_request_per_invoice(req: DataFrame) -> DataFrame:
    """Earliest request per invoice number (ASC NULLS LAST, tie-break on the source key)."""
    order = [F.col("fecha_aprobacion").asc_nulls_last(), F.col("origen").asc_nulls_last(),
             F.col("id_tramite").asc_nulls_last(), F.col("serial_firma").asc_nulls_last()]
    return dedup.keep_first(req, ["numero_factura"], order)


def invoices(fac: DataFrame, req: DataFrame, cod: DataFrame, points: DataFrame,
             islands: DataFrame, first_req: DataFrame | None = None,
             expect_unique: bool = False) -> DataFrame:
    """M-05 silver.fenix_facturas (``first_req``: precomputed first request per invoice).

    The branch and agreement document lists are joined without DISTINCT, as in the
    source model, so a repeated document fans out (T-07); ``expect_unique=True`` makes
    the query fail on such a document instead."""
    first_req = (first_req if first_req is not None else first_request_per_invoice(req)) \
        .select("numero_factura", "grupo_vendedor")
    codven = F.trim("codven")
    cleaned = fac.where(F.col("total_iva") != 0).select(
        F.trim("numfac").alias("codigo_factura"), F.trim("numdoc").alias("codigo_documento"),
        F.trim("cliente").alias("codigo_cliente"),
        text.pg_concat("numser", "pedido").alias("numero_factura"),
        F.trim("numser").alias("numero_serie"),
        F.upper(F.trim("comen1")).alias("comentario_1"), F.upper(F.trim("comen2")).alias("comentario_2"),
        F.upper(F.trim("comen3")).alias("comentario_3"),
        "subtotal", F.col("desc0").alias("valor_descuento"), "total", "total_iva",
        F.when(codven.isin(*NO_SELLER_CODES), DEFAULT_SELLER).otherwise(codven).alias("codigo_vendedor"),
        F.to_date("emision").alias("fecha_emision"),
        F.trim("numfac").like("DV%").alias("is_nc"))
    # per-document request group: MAX over the document's invoices (T-06: blank
    # documents are still one group here, the blank fallback comes later)
    doc_group = (cleaned.where(~F.col("is_nc")).join(first_req, "numero_factura")
                 .groupBy("codigo_documento").agg(F.max("grupo_vendedor").alias("grupo_vendedor_temp")))
    c3 = F.col("comentario_3")
    # the one group of blank documents is a value of its own, so that invoices move by the document
    # that all later lookups use
    of_blank = doc_group.where(F.col("codigo_documento") == "").select("grupo_vendedor_temp").scalar()
    named = doc_group.select(F.col("codigo_documento").alias("__grp_doc"), F.col("grupo_vendedor_temp").alias("__grp"))
    blank = F.coalesce(F.col("codigo_documento") == "", F.lit(False))
    parsed = (cleaned.withColumn("__blank", blank)
              .withColumn("codigo_documento", F.when(F.col("__blank"), F.col("codigo_factura")).otherwise(F.col("codigo_documento")))
              .join(named, (F.col("codigo_documento") == F.col("__grp_doc")) & ~F.col("__blank"), "left")
              .withColumn("grupo_vendedor_temp", F.when(F.col("__blank"), of_blank).otherwise(F.col("__grp")))
              .drop("__blank", "__grp_doc", "__grp")
              .withColumn("comentario_3", F.when(
                  c3.like(COMMERCIAL_COMMENT_PREFIXES[0] + "%") | c3.like(COMMERCIAL_COMMENT_PREFIXES[1] + "%"),
                  "COMERCIAL").otherwise(c3))
              .withColumn("codigo_descuento", F.coalesce(
                  text.regex_extract_or_null("comentario_2", DISCOUNT_CODE_PATTERN), F.lit(NO_DISCOUNT_CODE))))
    agreement = None
    for m in AGREEMENT_MARKERS:
        term = F.col("codigo_descuento").like(f"%{m}%")
        agreement = term if agreement is None else agreement | term
    agreement_docs = parsed.where(agreement).select(F.col("codigo_documento").alias("__agr_doc"))
    pts = points.alias("pe")
    branch_rule = ((F.col("pe.serial_punto_emision") == F.col("numero_serie"))
                   & (F.col("fecha_emision") >= F.col("pe.fecha_apertura"))
                   & (F.col("fecha_emision") < F.col("pe.fecha_cierre")))
    isl = islands.select(F.col("numero_factura").alias("__isl_nf"), F.col("id_sucursal").alias("__isl_suc"))
    doc_branch = (parsed.where(~F.col("is_nc")).join(pts, branch_rule)
                  .join(isl, F.col("numero_factura") == F.col("__isl_nf"), "left")
                  .select(F.col("codigo_documento").alias("__fs_doc"),
                          F.coalesce("__isl_suc", "pe.id_sucursal").alias("__fs_suc"),
                          F.col("codigo_vendedor").alias("__fs_ven")))
    if expect_unique:
        doc_branch = joins.expect_unique(doc_branch, ["__fs_doc"], "branch documents")
        agreement_docs = joins.expect_unique(agreement_docs, ["__agr_doc"], "agreement documents")
    cat = cod.select(F.col("codigo").alias("__cat_code"))
    e = (parsed.join(doc_branch, F.col("codigo_documento") == F.col("__fs_doc"), "left")
         .join(points.alias("pe"), branch_rule, "left")
         .join(cat, F.col("comentario_3") == F.col("__cat_code"), "left")
         .join(agreement_docs, F.col("codigo_documento") == F.col("__agr_doc"), "left"))
    c3 = F.col("comentario_3")
    return e.select(
        "codigo_factura", "codigo_documento", "codigo_cliente", "numero_factura", "numero_serie",
        "comentario_1", "comentario_2",
        F.when(c3.rlike(EXTRA_VOUCHERS_PATTERN), EXTRA_VOUCHERS_CODE)
         .when(F.col("__cat_code").isNotNull() & F.col("__agr_doc").isNotNull(),
               F.regexp_replace(c3, r"^([^.]+)\.[^.]+", "$1.CN"))
         .otherwise(c3).alias("comentario_3"),
        "codigo_descuento", "subtotal", "valor_descuento", "total", "total_iva",
        F.when(F.col("__fs_ven").isNotNull(), F.col("__fs_ven")).otherwise(F.col("codigo_vendedor"))
         .alias("codigo_vendedor"),
        "fecha_emision",
        F.when(F.col("__fs_suc").isNotNull(), F.col("__fs_suc")).otherwise(F.col("pe.id_sucursal"))
         .alias("id_sucursal"),
        "grupo_vendedor_temp", "is_nc")
