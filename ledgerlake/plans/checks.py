"""The warehouse's declared data-quality checks, as data (O-94..O-97).

Severity follows the source project: keys unique = error, not-null = warn, the article
relationship of the fact = error, seed and bronze checks = error (the tool's default).
``check_sql`` renders the same list as DuckDB SQL over the oracle's CTE names.
"""

from __future__ import annotations

from ledgerlake.operators.quality import ERROR, WARN, Check
from ledgerlake.plans import gold


def _key(model, col, null_sev=WARN, uniq_sev=ERROR):
    return [Check("unique", model, col, uniq_sev), Check("not_null", model, col, null_sev)]


def _filled(model, *columns):
    return [Check("not_null", model, c, ERROR) for c in columns]


WAREHOUSE_CHECKS = [
    # silver
    *_key("s_articles", "codigo"),
    *_key("s_invoices", "codigo_factura"),
    Check("not_null", "s_invoices", "numero_factura", WARN),
    *_key("s_customers", "codigo"),
    Check("not_null", "s_lines", "unico", WARN),
    *_key("s_sellers", "codigo"),
    *_key("s_codes", "id_codigo"),
    Check("unique", "s_codes", "codigo", WARN),
    # gold dimensions
    *_key("d_sellers", "id_vendedor"), *_key("d_sellers", "codigo_vendedor"),
    *_key("d_articles", "id_articulo"), *_key("d_articles", "codigo_articulo"),
    *_key("d_invoices", "id_factura"), *_key("d_invoices", "codigo_factura"),
    *_key("d_customers", "id_cliente"), *_key("d_customers", "codigo_cliente"),
    *_key("d_codes", "id_codigo"), *_key("d_codes", "codigo"),
    # fact
    Check("not_null", "fact", "id_factura", WARN),
    Check("relationships", "fact", "id_cliente", WARN, "d_customers", "id_cliente"),
    Check("relationships", "fact", "id_vendedor", WARN, "d_sellers", "id_vendedor"),
    Check("relationships", "fact", "id_articulo", ERROR, "d_articles", "id_articulo"),
    Check("not_null", "fact", "id_sucursal", WARN),
    Check("relationships", "fact", "id_sucursal", WARN, "puntos_emision", "id_sucursal"),
    # seeds
    *_key("articulos_comercial", "codigo_articulo", ERROR), *_filled("articulos_comercial", "verificacion_vendedor"),
    *_key("fenix_articulos_corregidos", "codigo", ERROR),
    *_filled("fenix_articulos_corregidos", "creation_date", "update_date", "nombre"),
    *_filled("reasignacion_articulos_comercial", "codigo_articulo", "fecha_cambio"),
    *_key("reasignacion_comercial", "codigo_documento", ERROR), *_filled("reasignacion_comercial", "motivo"),
    *_filled("reasignacion_distribuidores", "codigo_cliente", "grupo_vendedor_reasignado", "fecha_cambio"),
    *_key("reasignacion_grupo_vendedor", "codigo_documento", ERROR), *_filled("reasignacion_grupo_vendedor", "grupo_asignado"),
    *_key("reasignacion_islas_temporales", "numero_factura", ERROR), *_filled("reasignacion_islas_temporales", "id_sucursal"),
    *_key("reasignacion_periodo_fiscal", "numero_factura", ERROR),
    *_key("reasignacion_subtotal", "numero_factura", ERROR),
    *_key("vendedores_agentes", "codigo_vendedor", ERROR), *_filled("vendedores_agentes", "agente"),
    *_key("vendedores_comercial", "codigo_vendedor", ERROR), *_filled("vendedores_comercial", "fecha_inicio", "fecha_fin"),
    # bronze sources
    *_key("bronze_vendedores", "id_codven", ERROR), Check("unique", "bronze_vendedores", "codven", ERROR),
    Check("unique", "bronze_clientes", "codcli", ERROR),
    *_key("bronze_facturas", "id_numfac", ERROR), Check("unique", "bronze_facturas", "numfac", ERROR),
    *_key("bronze_tranfac", "id_tranfac", ERROR),
    *_key("bronze_articulos", "id_codart", ERROR), Check("unique", "bronze_articulos", "codart", ERROR),
]


#: Models that are checked in their compact form, with the column that counts a row's copies.
COPIES = {"fact": gold.COPIES}


def models(w) -> dict:
    """Model name -> DataFrame, from a built ``Warehouse`` (the fact in its compact form)."""
    out = {"s_articles": w.s_articles(), "s_invoices": w.s_invoices(), "s_customers": w.s_customers(),
           "s_lines": w.s_lines(), "s_sellers": w.s_sellers(), "s_codes": w.s_codes(),
           "d_sellers": w.d_sellers(), "d_articles": w.d_articles(), "d_invoices": w.d_invoices(),
           "d_customers": w.d_customers(), "d_codes": w.d_codes(), "fact": w.billed(),
           "bronze_vendedores": w.bronze["fenix_vendedores"], "bronze_clientes": w.bronze["fenix_clientes"],
           "bronze_tranfac": w.bronze["fenix_tranfac"],
           "bronze_facturas": w.bronze["fenix_facturas"], "bronze_articulos": w.bronze["fenix_articulos"]}
    out.update(w.seeds)
    return out


def _failures_sql(ch: Check) -> str:
    m, c = ch.model, ch.column
    if ch.kind == "unique":
        return f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
    if ch.kind == "not_null":
        return f"SELECT count(*) FROM {m} WHERE {c} IS NULL"
    return (f"SELECT count(*) FROM {m} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {ch.parent} y WHERE y.{ch.parent_column} = x.{c})")


def check_sql(checks=WAREHOUSE_CHECKS) -> str:
    parts = [f"SELECT '{ch.kind}' AS \"check\", '{ch.model}' AS model, '{ch.column}' AS \"column\", "
             f"'{ch.severity}' AS severity, CAST(({_failures_sql(ch)}) AS BIGINT) AS failures" for ch in checks]
    return "\nUNION ALL\n".join(parts)
