"""Typed seed files of a real deployment (O-05): one CSV per seed, schema declared here.

Column types follow the seed configuration of the source project; timestamps that are
used as dates are read as DATE (T-17).  ``read_seeds`` returns the same mapping the
models take from ``standins.seeds`` on the test tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.sources.readers import path_exists, read_seed


def _s(*fields) -> T.StructType:
    kinds = {"str": T.StringType(), "bool": T.BooleanType(), "date": T.DateType(), "int": T.IntegerType(),
             "ts": T.TimestampNTZType(), "dec52": T.DecimalType(5, 2)}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in fields])


# --- fixed values: seed names and column types -------------------------------------
SEED_SCHEMAS = {
    "articulos_comercial": _s(("codigo_articulo", "str"), ("verificacion_vendedor", "bool")),
    "fenix_articulos_corregidos": _s(("creation_date", "ts"), ("update_date", "ts"), ("codigo", "str"),
                                     ("nombre", "str"), ("vigencia", "str"), ("familia", "str"),
                                     ("tipo_plan", "str"), ("concepto", "str")),
    "vendedores_comercial": _s(("codigo_vendedor", "str"), ("fecha_inicio", "date"), ("fecha_fin", "date")),
    "vendedores_agentes": _s(("agente", "str"), ("codigo_vendedor", "str")),
    "reasignacion_comercial": _s(("codigo_documento", "str"), ("motivo", "str")),
    "reasignacion_grupo_vendedor": _s(("codigo_documento", "str"), ("grupo_asignado", "str"), ("motivo", "str")),
    "reasignacion_distribuidores": _s(("codigo_cliente", "str"), ("nombre_cliente", "str"),
                                      ("grupo_vendedor_reasignado", "str"), ("fecha_cambio", "date"),
                                      ("motivo", "str")),
    "reasignacion_subtotal": _s(("numero_factura", "str"), ("motivo", "str")),
    "reasignacion_articulos_comercial": _s(("codigo_articulo", "str"), ("fecha_cambio", "date"), ("motivo", "str")),
    "reasignacion_periodo_fiscal": _s(("numero_factura", "str"), ("motivo", "str")),
    "reasignacion_islas_temporales": _s(("numero_factura", "str"), ("id_sucursal", "int")),
    "canal_indirecto": _s(("ruc", "str"), ("razon_social", "str"), ("grupo", "str"), ("estado", "str"),
                          ("fecha_inicio", "ts"), ("fecha_fin", "ts"), ("modelo", "str"), ("dias_plazo", "int"),
                          ("porcentaje_comision", "dec52")),
}
# -----------------------------------------------------------------------------------


def read_seeds(spark: SparkSession, seed_dir: str, names=None) -> dict[str, DataFrame]:
    """``{seed: DataFrame}`` for every ``<seed>.csv`` present in ``seed_dir``."""
    out = {}
    for name in (names or SEED_SCHEMAS):
        path = os.path.join(seed_dir, f"{name}.csv")
        if path_exists(spark, path):
            out[name] = read_seed(spark, path, SEED_SCHEMAS[name])
    return out
