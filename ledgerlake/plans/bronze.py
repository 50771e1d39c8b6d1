"""Bronze loads (M-20): extract -> typed cleaning -> merge into the bronze snapshot.

Each load is one lazy plan; the reference's batch sizes (3,000-10,000 rows, commit per
batch) become partition-parallel writes.  ``LOAD_SPECS`` lists, per bronze table, the
conflict keys and the columns an upsert overwrites.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import aggregates, dedup, merge, versions
from ledgerlake.operators import transforms as tf


@dataclass(frozen=True)
class LoadSpec:
    table: str
    keys: tuple
    update_cols: tuple
    watermark: str | None = None        # column of the incremental high-water mark


# --- fixed values: conflict keys and updated columns per bronze table ----------------
LOAD_SPECS = {
    "fenix_facturas": LoadSpec(
        "fenix_facturas", ("numfac",),
        ("numdoc", "cliente", "numser", "pedido", "comen1", "comen2", "comen3", "subtotal",
         "desc0", "total_iva", "total", "codven", "emision", "fecha_hora"), "fecha_hora"),
    "fenix_tranfac": LoadSpec("fenix_tranfac", ("id_tranfac", "unico"),
                              ("numfac", "codart", "cantidad_d", "precio", "desct", "iva"), "id_tranfac"),
    "fenix_clientes": LoadSpec("fenix_clientes", ("codcli",), ("update_date", "nomcli", "cif", "fecha_act"), "fecha_act"),
    "fenix_vendedores": LoadSpec("fenix_vendedores", ("codven",), ("update_date", "nomven", "fecha_act"), "fecha_act"),
    "fenix_articulos": LoadSpec("fenix_articulos", ("codart",), ("update_date", "nomart", "nomart2")),
    "fenix_codigos": LoadSpec(
        "fenix_codigos", ("codigo",),
        ("codigo", "codigo_nombre", "familia_producto", "atencion", "venta_dirigida", "concepto_1", "concepto_2",
         "plan", "vigencia", "update_date")),
    "camunda_operatividad": LoadSpec(
        "camunda_operatividad", ("id_tramite", "origen", "factura"),
        ("serial_firma", "update_date", "cedula", "fecha_aprobacion", "factura", "ruc", "tipo_firma",
         "fecha_inicio_tramite", "ruc_aux", "medio", "sf_control", "producto", "grupo_vendedor", "estado",
         "fecha_factura"), "fecha_factura"),
    "facturas_excluidas": LoadSpec("facturas_excluidas", ("codigo_factura",), ("update_date", "motivo")),
}
REQUEST_DATETIME_COLS = ("fecha_aprobacion", "fecha_inicio_tramite", "fecha_factura")
REQUEST_INTEGER_COLS = ("sf_control",)
REQUEST_STRING_COLS = ("cedula", "factura", "ruc", "tipo_firma", "serial_firma", "ruc_aux", "medio", "producto",
                       "estado")
# Columns cleaned of special characters on load.
CLEANED_COLUMNS = {"fenix_facturas": ("codven",), "fenix_vendedores": ("codven",),
                   "fenix_articulos": ("nomart", "nomart2"),
                   "fenix_codigos": ("codigo_nombre", "familia_producto", "atencion", "venta_dirigida", "concepto_1",
                                     "concepto_2", "plan", "vigencia")}
REQUEST_STATUSES = ("APROBADO", "NO APROBADO")
# --------------------------------------------------------------------------------------

_PRIO = "__ll_source_priority"


def clean_request_source(df: DataFrame, origin: str, priority: int) -> DataFrame:
    """Per-source chain: exact datetimes, integers, upper-case strings, origin literal."""
    return tf.chain(df, [
        lambda d: tf.cast_datetime_columns(d, [c for c in REQUEST_DATETIME_COLS if c in d.columns]),
        lambda d: tf.cast_integer_columns(d, REQUEST_INTEGER_COLS),
        lambda d: tf.cast_string_columns(d, REQUEST_STRING_COLS),
        lambda d: tf.add_constant(d, "origen", origin),
        lambda d: tf.add_constant(d, _PRIO, priority),
    ])


def integrate_requests(frames: Sequence[DataFrame], order_col: str = "id_tramite") -> DataFrame:
    """Union by name, then keep the first row per ``serial_firma`` and per
    (id_tramite, origen, factura); "first" = source list order, then the extract's
    ``ORDER BY`` column.  Rows with a NULL serial are dropped (the whole key is NULL)."""
    u = tf.union_by_name(list(frames))
    d1 = dedup.drop_duplicates(u, ["serial_firma"], "first", row_order=[_PRIO, order_col, "factura"])
    d2 = dedup.drop_duplicates(d1, ["id_tramite", "origen", "factura"], "first",
                               row_order=[_PRIO, order_col, "factura"])
    return d2.drop(_PRIO)


def load(target: DataFrame, source: DataFrame, spec: LoadSpec, load_ts=None,
         order: Sequence | None = None, batch_size: int = 10_000) -> DataFrame:
    """UPDATE-mode merge of one load into the bronze snapshot (NaN -> NULL, audit cols).  A key
    repeated in the source fails the job, unless ``order`` (the extract's total order) is given:
    then it is resolved batch by batch (``merge.persist``)."""
    src = source
    if "creation_date" in target.columns and "creation_date" not in src.columns:
        src = merge.with_audit_columns(src, load_ts)
    return merge.persist(target, src, "update", keys=list(spec.keys),
                         update_cols=[c for c in spec.update_cols if c in src.columns],
                         load_ts=load_ts, audit="creation_date" in target.columns, order=order, batch_size=batch_size)


def requests_watermarks(target: DataFrame) -> dict:
    """High-water mark of the billing date per request status (None: no such row), one pass."""
    row = aggregates.high_water_mark_by(target, "fecha_factura", "estado", REQUEST_STATUSES).first()
    return {status: row[f"hwm_{status}"] for status in REQUEST_STATUSES}


def clean_special_for(table: str, df: DataFrame) -> DataFrame:
    return tf.clean_special_columns(df, CLEANED_COLUMNS.get(table, ()))


def after_mark(extract: DataFrame, column: str, mark) -> DataFrame:
    """Rows past a stored mark.  The mark is one value (or a literal column), read before the extract
    is planned, so the comparison is with a literal and reaches the scan; None (empty target)
    takes all."""
    return extract if mark is None else extract.where(F.col(column) > F.lit(mark))


def incremental_load(target: DataFrame, extract: DataFrame, spec: LoadSpec, mode: str = "INCREMENTAL",
                     load_ts=None, order: Sequence | None = None, batch_size: int = 10_000) -> DataFrame:
    """One scheduled run of a single-source bronze load (O-93, §3.1): high-water mark of the
    target -> filtered extract -> special-character cleaning -> UPDATE merge.
    ``mode='INICIAL'`` reads the whole extract."""
    src = extract
    if mode == "INCREMENTAL" and spec.watermark:
        src = after_mark(src, spec.watermark, aggregates.high_water_mark(target, spec.watermark))
    return load(target, clean_special_for(spec.table, src), spec, load_ts, order, batch_size)


def incremental_requests(target: DataFrame, extracts: dict[str, DataFrame], origin: str = "CAMUNDA",
                         load_ts=None) -> DataFrame:
    """Incremental run of the request load: one extract a status, each past the mark of its own
    status in the target, then integrated and merged like the full run."""
    marks = requests_watermarks(target)
    cleaned = [clean_request_source(after_mark(extract, "fecha_factura", marks[status]), origin, priority)
               for priority, (status, extract) in enumerate(extracts.items())]
    return load(target, integrate_requests(cleaned), LOAD_SPECS["camunda_operatividad"], load_ts)


def marks_of(spec: LoadSpec) -> list[versions.Mark]:
    """The marks that a load needs of its target: one, or one a status for the requests."""
    if spec.watermark is None:
        return []
    if spec.table == "camunda_operatividad":
        return [versions.Mark(spec.watermark, "estado", status) for status in REQUEST_STATUSES]
    return [versions.Mark(spec.watermark)]


def stored_table(log: versions.VersionLog, spec: LoadSpec, schema, buckets: int = 64) -> versions.BucketedTable:
    """The bronze table of a load as versioned buckets of its conflict keys, with its marks."""
    return versions.BucketedTable(log, spec.table, schema, spec.keys, buckets, marks_of(spec))


def _merge_into(table: versions.BucketedTable, source: DataFrame, spec: LoadSpec, since: int, load_ts, order, batch_size) -> list[int]:
    src = merge.nan_to_null_columns(source)
    audit = merge.CREATION_COL in table.schema.names
    if audit and merge.CREATION_COL not in src.columns:
        src = merge.with_audit_columns(src, load_ts)
    src = merge.unique_keys(src, spec.keys) if order is None else merge.resolve_batches(src, spec.keys, order, batch_size)
    return table.merge(src, [c for c in spec.update_cols if c in src.columns], since=since, load_ts=load_ts, audit=audit)


def incremental_table_load(table: versions.BucketedTable, extract: DataFrame, spec: LoadSpec, mode: str = "INCREMENTAL",
                           load_ts=None, order: Sequence | None = None, batch_size: int = 10_000) -> list[int]:
    """``incremental_load`` into a stored table: the mark comes from the version file, so nothing
    of the target is read before the extract; the merge then rewrites the touched buckets and
    publishes them with their new marks at once.  Returns those buckets."""
    since = table.log.version()
    src = extract
    if mode == "INCREMENTAL" and spec.watermark:
        src = after_mark(src, spec.watermark, table.mark(versions.Mark(spec.watermark), since))
    return _merge_into(table, clean_special_for(spec.table, src), spec, since, load_ts, order, batch_size)


def incremental_requests_into(table: versions.BucketedTable, extracts: dict[str, DataFrame], origin: str = "CAMUNDA",
                              load_ts=None) -> list[int]:
    """``incremental_requests`` into a stored table, each status past its own stored mark."""
    spec = LOAD_SPECS["camunda_operatividad"]
    since = table.log.version()
    cleaned = []
    for priority, (status, extract) in enumerate(extracts.items()):
        mark = table.mark(versions.Mark(spec.watermark, "estado", status), since)
        cleaned.append(clean_request_source(after_mark(extract, spec.watermark, mark), origin, priority))
    return _merge_into(table, integrate_requests(cleaned), spec, since, load_ts, None, 0)
