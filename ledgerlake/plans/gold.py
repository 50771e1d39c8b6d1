"""Gold layer (M-08..M-14): star-schema dimensions and the line-grain billing fact."""

from __future__ import annotations

import functools
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import dates, numeric
from ledgerlake.operators import aggregates, dedup, joins, keys
from ledgerlake.plans.config import COMMERCIAL_GROUP, WarehouseConfig
from ledgerlake.plans.silver import AGREEMENT_MARKERS, first_request_per_invoice
from ledgerlake.session import cut_lineage

CENT = Decimal("0.01")

# --- fixed values ------------------------------------------------------------------
AGREEMENT_GROUP = "GRUPO CONVENIOS"
THIRD_PARTY_GROUP = "GRUPO TERCEROS"
DISTRIBUTOR_GROUP = "GRUPO DISTRIBUIDORES"
AGENT_GROUP = "GRUPO AGENTES"
THIRD_PARTY_FAMILIES = ("FIRMAS ELECTRONICAS", "SISTEMA DE FACTURACION")
LICENCE_FAMILY = "LICENCIAS"
VOIDED, INVOICED = "ANULADO", "FACTURADO"
# -----------------------------------------------------------------------------------

#: Column of the compact staging and fact: how many equal rows a row stands for.
COPIES = "__copies"
#: The invoice's sum of subtotals, staged with its lines.
SUM = "suma_subtotales"
#: Family classes that the seller group rules tell apart: (rows of a code in the class, third party, licence).
FAMILY_CLASSES = (("__third_rows", True, False), ("__licence_rows", False, True), ("__other_rows", False, False))


def dim_articles(art: DataFrame, commercial: DataFrame, lns: DataFrame,
                 previous: DataFrame | None = None) -> DataFrame:
    """M-08: articles sold (EXISTS in lines) or manual SF codes, with commercial flags."""
    ac = commercial.select(F.col("codigo_articulo").alias("__ac_code"), "verificacion_vendedor")
    stg = art.join(ac, F.col("codigo") == F.col("__ac_code"), "left").select(
        F.col("codigo").alias("codigo_articulo"), F.col("nombre").alias("nombre_articulo"), "vigencia",
        "familia", "tipo_plan", "verificacion_vendedor",
        F.col("verificacion_vendedor").isNotNull().alias("is_codigo_comercial"), "concepto")
    kept = joins.semi_or(stg, lns, [("codigo_articulo", "codigo_articulo")],
                         F.col("codigo_articulo").like("SF.MAN%"))
    return _with_key(kept, "codigo_articulo", "id_articulo", previous)


def _with_key(df: DataFrame, natural: str, id_col: str, previous: DataFrame | None = None) -> DataFrame:
    """Surrogate key in front: dense by natural key on a first build; with ``previous`` (the last
    snapshot of the dimension) known natural keys keep their ids and new ones follow the
    highest, so a refresh does not renumber (T-19)."""
    if previous is None:
        km = keys.dense_keys(df, [natural], id_col)
    else:
        km = cut_lineage(keys.stable_keys(df.select(natural), previous.select(id_col, natural).distinct(),
                                          [natural], id_col), "stable-keys")
    out = keys.attach_keys(df, km, [natural])
    return out.select(id_col, *[c for c in df.columns])


def dim_customers(cli: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """M-09."""
    stg = cli.select(F.col("codigo").alias("codigo_cliente"), F.col("nombre").alias("nombre_cliente"),
                     "cif", "is_same_corporate_group")
    return _with_key(stg, "codigo_cliente", "id_cliente", previous)


def dim_sellers(ven: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """M-12."""
    stg = ven.select(F.col("codigo").alias("codigo_vendedor"), F.col("nombre").alias("nombre_vendedor"))
    return _with_key(stg, "codigo_vendedor", "id_vendedor", previous)


def dim_codes(cod: DataFrame) -> DataFrame:
    """M-10: strip the ``VIGENCIA `` prefix, distinct rows."""
    return cod.withColumn("vigencia", F.replace(F.col("vigencia"), F.lit("VIGENCIA "), F.lit(""))).distinct()


def dim_invoices(inv: DataFrame, req: DataFrame, dco: DataFrame, excluded: DataFrame,
                 first_req: DataFrame | None = None, previous: DataFrame | None = None) -> DataFrame:
    """M-11: exclusions removed; ANULADO when the document has a credit note; sale type
    from the first request of the document, else from the code catalogue."""
    stg = joins.anti_join(inv, excluded, [("codigo_factura", "codigo_factura")])
    nc_docs = inv.where(F.col("is_nc")).select(F.col("codigo_documento").alias("__nc_doc")).distinct()
    first_req = (first_req if first_req is not None else first_request_per_invoice(req)).select(
        F.col("numero_factura").alias("__rq_nf"), "tipo_venta")
    doc_type = (stg.where(~F.col("is_nc"))
                .join(first_req, F.col("numero_factura") == F.col("__rq_nf"), "left")
                .select(F.col("codigo_documento").alias("__dt_doc"), F.col("tipo_venta").alias("__dt_tipo"),
                        F.col("codigo_factura").alias("__dt_cf")))
    doc_type = dedup.keep_first(doc_type, ["__dt_doc"], [F.col("__dt_tipo").asc_nulls_last(),
                                                         F.col("__dt_cf").asc()])
    cat = dco.select(F.col("codigo").alias("__dc_code"), F.col("concepto_2").alias("__dc_c2"))
    e = (stg.join(nc_docs, F.col("codigo_documento") == F.col("__nc_doc"), "left")
         .join(doc_type, F.col("codigo_documento") == F.col("__dt_doc"), "left")
         .join(cat, F.col("comentario_3") == F.col("__dc_code"), "left"))
    enriched = e.select(
        "codigo_factura", "codigo_documento", "numero_factura", "comentario_1", "comentario_2", "comentario_3",
        "codigo_descuento",
        F.when(F.col("__nc_doc").isNotNull(), VOIDED).otherwise(INVOICED).alias("estado_factura"),
        F.when(F.col("__dt_tipo").isNotNull(), F.col("__dt_tipo"))
         .when(F.col("__dc_c2").isNotNull(), F.col("__dc_c2")).alias("tipo_venta"))
    return _with_key(enriched, "codigo_factura", "id_factura", previous)


def any_of(conditions):
    """True where a condition holds (NULL counts as not)."""
    return functools.reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def first_label(rules, default):
    """Label of the first rule whose condition holds; ``rules``: (label, condition) in order."""
    out = None
    for label, condition in rules:
        label = F.lit(label) if isinstance(label, str) else label
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(default)


def _mentions(column: str, markers):
    return any_of([F.col(column).contains(m) for m in markers])


def _prefixed(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in columns])


def copies_of(df: DataFrame):
    """Rows that a row stands for: its ``COPIES``, or one."""
    return F.col(COPIES) if COPIES in df.columns else F.lit(1)


def expand(df: DataFrame) -> DataFrame:
    """Every row as often as its ``COPIES`` say; a frame without the column stays as it is."""
    if COPIES not in df.columns:
        return df
    kept = [c for c in df.columns if c != COPIES]
    return df.select(*kept, F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES))).alias(COPIES)).select(*kept)


def article_rules(dart: DataFrame) -> DataFrame:
    """One row an article code: which of the commercial rules one of its dimension rows satisfies."""
    code, checked = F.col("is_codigo_comercial"), F.col("verificacion_vendedor")
    return dart.groupBy("codigo_articulo").agg(
        F.bool_or(code & ~checked).alias("__sold_by_all"), F.bool_or(code & checked).alias("__sold_by_some"),
        F.bool_or(~checked).alias("__unchecked"), F.bool_or(checked).alias("__checked"))


def article_classes(dart: DataFrame) -> DataFrame:
    """One row an article code and id with the number of its dimension rows in each family class:
    rows of one code differ for the fact in nothing else, so lines meet a code once."""
    third, licence = any_of([F.col("familia").isin(*THIRD_PARTY_FAMILIES)]), any_of([F.col("familia") == LICENCE_FAMILY])
    return dart.groupBy("codigo_articulo", "id_articulo").agg(
        *[F.count_if((third == F.lit(is_third)) & (licence == F.lit(is_licence))).alias(name)
          for name, is_third, is_licence in FAMILY_CLASSES])


def sold_lines(inv, lns, dart, dcli, dven) -> DataFrame:
    """Invoice lines whose article, customer and seller are in their dimensions, with what the
    commercial rules ask of the article (no surrogate keys)."""
    headers = (inv.join(dcli.select("codigo_cliente"), "codigo_cliente", "left_semi")
               .join(dven.select("codigo_vendedor"), "codigo_vendedor", "left_semi")
               .select("codigo_factura", "codigo_documento", "codigo_cliente", "codigo_vendedor", "fecha_emision",
                       "comentario_2", "comentario_3"))
    return (lns.select("codigo_factura", "codigo_articulo").join(article_rules(dart), "codigo_articulo")
            .join(headers, "codigo_factura"))


def commercial_documents(inv, lns, dart, dcli, dven, seeds, cfg: WarehouseConfig) -> DataFrame:
    """Documents that qualify as commercial: one of the rules holds for one of their lines.

    Each seed becomes a flag of its own grain first: sellers with their commercial periods,
    articles with the day they became commercial, documents reassigned by hand."""
    periods = _prefixed(seeds["vendedores_comercial"], "__period_", "codigo_vendedor", "fecha_inicio", "fecha_fin")
    since = (seeds["reasignacion_articulos_comercial"].groupBy(F.col("codigo_articulo").alias("__since_article"))
             .agg(F.min("fecha_cambio").alias("__since")))
    by_hand = (seeds["reasignacion_comercial"].select(F.col("codigo_documento").alias("__hand_document"))
               .where("__hand_document is not null").distinct())
    sold = sold_lines(inv.where(~F.col("codigo_factura").startswith("DV")), lns, dart, dcli, dven)
    at = F.col("fecha_emision")
    flagged = (sold.join(periods, F.col("codigo_vendedor") == F.col("__period_codigo_vendedor"), "left")
               .join(since, F.col("codigo_articulo") == F.col("__since_article"), "left")
               .join(by_hand, F.col("codigo_documento") == F.col("__hand_document"), "left"))
    renewal = F.col("comentario_2").contains("RENOVACION")
    marked = F.col("comentario_3") == COMMERCIAL_GROUP
    rules = [F.col("__sold_by_all"),
             F.col("__sold_by_some") & at.between(F.col("__period_fecha_inicio"), F.col("__period_fecha_fin")) & ~renewal,
             *[(F.col("codigo_cliente") == customer) & (at >= F.lit(day)) for customer, day in cfg.commercial_customers],
             F.col("comentario_3") == "F.E.F.A.V.",
             marked & F.col("__unchecked"), marked & F.col("__checked") & ~renewal,
             at >= F.col("__since"),
             F.col("__hand_document").isNotNull()]
    return flagged.where(any_of(rules)).select("codigo_documento").distinct()


def agent_documents(inv, dven, seeds) -> DataFrame:
    """Documents sold by an agent or whose comments mention one."""
    agents = seeds["vendedores_agentes"].select(F.col("codigo_vendedor").alias("__agent")).distinct()
    known = inv.join(dven.select("codigo_vendedor"), "codigo_vendedor", "left_semi")
    return (known.join(agents, F.col("codigo_vendedor") == F.col("__agent"), "left")
            .where(any_of([F.col("comentario_3").contains("AGENT"), F.col("comentario_2").contains("AGENT"),
                           F.col("__agent").isNotNull()]))
            .select("codigo_documento").distinct())


def _flag(df: DataFrame, column: str, seed: DataFrame, seed_column: str, name: str, *more: str) -> DataFrame:
    """Left join of a seed by one column: ``name`` tells whether it has the row, ``more`` its columns."""
    side = seed.select(F.col(seed_column).alias("__flag_key"), F.lit(True).alias(name), *more)
    return (df.join(side, F.col(column) == F.col("__flag_key"), "left").drop("__flag_key")
            .withColumn(name, F.coalesce(name, F.lit(False))))


def invoice_headers(inv, dinv, dcli, dven, dco, seeds, commercial, agents, cfg: WarehouseConfig,
                    expect_unique: bool = False) -> DataFrame:
    """Invoice headers that stay, with every attribute the lines take from their document,
    customer, seller and code.  The agreement codes of a document (one per agreement invoice)
    and the distributor changes of a customer multiply headers on repeated keys, as in the
    source model (T-07); ``expect_unique=True`` makes the query fail there instead."""
    kept = joins.anti_join(inv, seeds["facturas_excluidas"], [("codigo_factura", "codigo_factura")])
    agreement = (dinv.where(F.col("codigo_descuento").contains("ALIANZA"))
                 .select(F.col("codigo_documento").alias("__agreement_document"), "id_factura",
                         joins.lookup_default(dco, "codigo", cfg.agreement_code, "id_codigo").alias("__agreement_code"))
                 .where("__agreement_code is not null").distinct().drop("id_factura"))
    changes = _prefixed(seeds["reasignacion_distribuidores"], "__change_", "codigo_cliente",
                        "grupo_vendedor_reasignado", "fecha_cambio")
    if expect_unique:
        agreement = joins.expect_unique(agreement, ["__agreement_document"], "agreement codes per document")
        changes = joins.expect_unique(changes, ["__change_codigo_cliente"], "distributor reassignments")
    numbers = (dinv.select("codigo_factura", "id_factura", F.col("codigo_documento").alias("__dim_document"))
               .join(agreement, F.col("__dim_document") == F.col("__agreement_document"), "left")
               .select("codigo_factura", "id_factura", "__agreement_code"))
    # texts become flags before the headers move, and lookups by one key follow each other
    out = _flag(kept, "comentario_3", dco, "codigo", "__coded", F.col("id_codigo").alias("__code"), "atencion")
    out = out.select(
        "codigo_factura", "codigo_documento", "codigo_cliente", "codigo_vendedor", "numero_factura", "fecha_emision", "is_nc",
        "id_sucursal", "grupo_vendedor_temp", "__code", (F.col("total") - F.col("total_iva")).cast("decimal(18,2)").alias("total_sin_iva"),
        any_of([_mentions("codigo_descuento", AGREEMENT_MARKERS), F.col("atencion") == "CONVENIOS"]).alias("__agreed"),
        any_of([F.col("comentario_3").contains("TERCER")]).alias("__third"),
        any_of([F.col("comentario_3").contains("DISTRIBUI")]).alias("__distributor"))
    out = out.join(dven.select("codigo_vendedor", "id_vendedor"), "codigo_vendedor").drop("codigo_vendedor")
    out = out.join(numbers, "codigo_factura")
    out = _flag(out, "numero_factura", seeds["reasignacion_periodo_fiscal"], "numero_factura", "__earlier")
    out = _flag(out, "numero_factura", seeds["reasignacion_subtotal"], "numero_factura", "__as_is").drop("numero_factura")
    out = _flag(out, "codigo_documento", seeds["reasignacion_grupo_vendedor"], "codigo_documento", "__assigned",
                "grupo_asignado")
    out = _flag(out, "codigo_documento", commercial, "codigo_documento", "__commercial")
    out = _flag(out, "codigo_documento", agents, "codigo_documento", "__agent")
    return (out.join(dcli.select("codigo_cliente", "id_cliente", "is_same_corporate_group"), "codigo_cliente")
            .join(changes, (F.col("codigo_cliente") == F.col("__change_codigo_cliente"))
                  & (F.col("fecha_emision") >= F.col("__change_fecha_cambio")), "left"))


def seller_group_rules(cfg: WarehouseConfig, third_family, licence) -> list:
    """(label, condition) in order; the first that holds names the seller group of a line whose
    article has a third-party or licence family (columns)."""
    third = F.col("__third") & third_family
    reassigned = F.col("__change_grupo_vendedor_reasignado")
    return [(F.col("grupo_asignado"), F.col("__assigned")),
            (AGREEMENT_GROUP, F.col("__agreed")),
            (reassigned, reassigned.isNotNull() & third),
            (cfg.corporate_group, licence & F.col("is_same_corporate_group")),
            (THIRD_PARTY_GROUP, third),
            (DISTRIBUTOR_GROUP, F.col("__distributor")),
            (AGENT_GROUP, F.col("__agent")),
            (cfg.special_group, F.col("codigo_cliente").isin(*cfg.special_customers)),
            (COMMERCIAL_GROUP, F.col("__commercial")),
            (F.col("grupo_vendedor_temp"), F.col("grupo_vendedor_temp").isNotNull())]


def _grouped_copies(labels, counts):
    """Array of (grupo_vendedor, COPIES): equal labels together, with the sum of their counts (zero
    for a label that an earlier one took up)."""
    entries = []
    for i, label in enumerate(labels):
        total = functools.reduce(lambda a, b: a + b, [counts[i]] + [F.when(label.eqNullSafe(labels[j]), counts[j]).otherwise(0)
                                                                    for j in range(i + 1, len(labels))])
        taken = any_of([label.eqNullSafe(labels[j]) for j in range(i)] or [F.lit(False)])
        entries.append(F.struct(label.alias("grupo_vendedor"), F.when(taken, F.lit(0).cast("long")).otherwise(total).alias(COPIES)))
    return F.array(*entries)


def staged_lines(inv, lns, dinv, dcli, dven, dart, dco, seeds, cfg: WarehouseConfig,
                 commercial: DataFrame | None = None, agents: DataFrame | None = None,
                 expect_unique: bool = False) -> DataFrame:
    """``fact_staging`` with equal rows kept once: ``COPIES`` is the number of article rows that give
    a line and seller group.  A code that many articles share (T-07) does not multiply what is
    joined, written and shuffled.

    ``commercial`` / ``agents`` are the precomputed document lists (a caller that
    materialises them once passes them in)."""
    if commercial is None:
        commercial = commercial_documents(inv, lns, dart, dcli, dven, seeds, cfg)
    if agents is None:
        agents = agent_documents(inv, dven, seeds)
    headers = invoice_headers(inv, dinv, dcli, dven, dco, seeds, commercial, agents, cfg, expect_unique)
    manual_code = joins.lookup_default(dco, "codigo", cfg.manual_code, "id_codigo")
    labels = [f"__group{i}" for i in range(len(FAMILY_CLASSES))]
    # all that a line takes from its header, the seller group of each family class included
    headers = headers.select(
        "codigo_factura", "id_factura", "codigo_documento", "is_nc", F.col("fecha_emision").alias("fecha_emision_fenix"),
        F.when(F.col("__earlier"), dates.month_shift("fecha_emision")).otherwise(F.col("fecha_emision"))
         .alias("fecha_emision"),
        "id_cliente", "id_vendedor", "id_sucursal",
        F.coalesce("__code", "__agreement_code", manual_code).alias("id_codigo"),
        "total_sin_iva", F.col("__as_is").alias("excluir_ajuste_centavos"),
        *[first_label(seller_group_rules(cfg, F.lit(is_third), F.lit(is_licence)), F.lit(cfg.default_group)).alias(label)
          for label, (_, is_third, is_licence) in zip(labels, FAMILY_CLASSES)])
    cent = F.lit(CENT)
    qty, price, disc = F.col("cantidad_articulos"), F.col("valor_unitario"), F.col("porcentaje_descuento")
    # the narrow lines meet their articles first, then each header row once
    sold = lns.drop("unico").join(article_classes(dart), "codigo_articulo").join(headers, "codigo_factura")
    subtotal = (qty * price * (100 - disc) * cent).cast("decimal(18,4)")
    rows = sum((F.col(c) for c, *_ in FAMILY_CLASSES), F.lit(0)).cast("decimal(19,0)")
    # an invoice's lines lie together here, so its sum needs no exchange later on
    of_invoice = Window.partitionBy("codigo_factura")
    staged = sold.withColumn("subtotal_articulo", subtotal).withColumn(
        SUM, F.sum(F.col("subtotal_articulo") * rows).over(of_invoice).cast("decimal(28,4)")).select(
        "id_factura", "codigo_documento", "is_nc", "fecha_emision_fenix", "fecha_emision", "id_cliente", "id_vendedor",
        "id_articulo", "id_sucursal", "id_codigo", qty, price, disc,
        "subtotal_articulo", SUM,
        (qty * price * disc * cent).cast("decimal(18,4)").alias("descuento_articulo"),
        "total_sin_iva", "porcentaje_iva", "excluir_ajuste_centavos",
        F.inline(_grouped_copies([F.col(c) for c in labels], [F.col(c) for c, *_ in FAMILY_CLASSES])))
    return staged.where(F.col(COPIES) > 0)


def fact_staging(inv, lns, dinv, dcli, dven, dart, dco, seeds, cfg: WarehouseConfig,
                 commercial: DataFrame | None = None, agents: DataFrame | None = None,
                 expect_unique: bool = False) -> DataFrame:
    """Wide line staging: enriched headers joined once with the lines and their articles."""
    return expand(staged_lines(inv, lns, dinv, dcli, dven, dart, dco, seeds, cfg, commercial, agents, expect_unique)).drop(SUM)


def inherit_credit_note_group(stg: DataFrame) -> DataFrame:
    """Credit notes take MAX(group) of their document's invoices for the same article; the lines of
    invoices stay where they are."""
    is_note = F.coalesce("is_nc", F.lit(False))
    orig = (stg.where(~F.col("is_nc")).groupBy("codigo_documento", "id_articulo")
            .agg(F.max("grupo_vendedor").alias("__gvo"))
            .select(F.col("codigo_documento").alias("__gvo_doc"), F.col("id_articulo").alias("__gvo_art"), "__gvo"))
    notes = (stg.where(is_note)
             .join(orig, (F.col("codigo_documento") == F.col("__gvo_doc")) & (F.col("id_articulo") == F.col("__gvo_art")), "left")
             .withColumn("grupo_vendedor", F.coalesce("__gvo", "grupo_vendedor")).select(*stg.columns))
    return stg.where(~is_note).unionByName(notes)


def allocate_cents(stg: DataFrame) -> DataFrame:
    """Spread ``total_sin_iva - Σ subtotal`` over the invoice's lines in proportion, each
    adjusted line rounded half-up to cents; exact integer arithmetic (T-08):
    ``ROUND(s + s/Σ·(H-Σ), 2) = ROUND(s·H/Σ, 2)``, computed in 1e-4 units as
    ``round_half_up(s4·H4 / (Σ4·100))`` with 38-digit integers.  Σ = 0 -> NULL (T-09);
    un-adjusted lines keep their unrounded value (T-10).  Lines that were staged with their sum
    (``staged_lines``) are not summed again."""
    x = stg if SUM in stg.columns else aggregates.sum_over(stg, ["id_factura"], F.col("subtotal_articulo"), SUM)
    total = F.col(SUM)
    s4 = (F.col("subtotal_articulo") * 10000).cast("decimal(38,0)")
    sum4 = (total * 10000).cast("decimal(38,0)")
    h4 = (F.col("total_sin_iva") * 10000).cast("decimal(38,0)")
    cents = numeric.div_round_half_up(s4 * h4, sum4 * 100)
    diff = F.col("total_sin_iva") - total
    adjusted = (cents.cast("decimal(18,0)") * F.lit(CENT)).cast("decimal(18,4)")
    return x.withColumn("subtotal_articulo", F.when((diff != 0) & ~F.col("excluir_ajuste_centavos"), adjusted)
                        .otherwise(F.col("subtotal_articulo")).cast("decimal(18,4)"))


FACT_COLUMNS = ("id_factura", "fecha_emision", "id_cliente", "id_vendedor", "id_articulo", "id_sucursal",
                "id_codigo", "cantidad_articulos", "valor_unitario", "porcentaje_descuento", "porcentaje_iva",
                "grupo_vendedor", "descuento_articulo", "subtotal_articulo", "total_iva", "fecha_emision_fenix")


def fact_billing(stg: DataFrame, buckets: int | None = None) -> DataFrame:
    """M-14 tail: cents allocation -> VAT per line -> credit-note inheritance (which reads no amounts,
    so only the fact's columns move to it).

    With ``buckets`` the lines are dealt to that many partitions by invoice, the layout of a table
    bucketed by ``id_factura``.  A compact staging gives a compact fact (``COPIES``)."""
    x = allocate_cents(stg)
    vat = numeric.round_half_up(F.col("subtotal_articulo") * F.col("porcentaje_iva")
                                * F.lit(CENT), 2).cast("decimal(18,2)")
    columns = [*FACT_COLUMNS, *[c for c in stg.columns if c == COPIES]]
    x = inherit_credit_note_group(x.withColumn("total_iva", vat).select(*columns, "codigo_documento", "is_nc")).select(*columns)
    return x.repartition(buckets, "id_factura") if buckets else x
