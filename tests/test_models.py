"""Warehouse models on hand-made bronze rows (the edge cases of FIXTURES §7)."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import gold, silver

REQ_SCHEMA = ("id_tramite int, origen string, serial_firma string, cedula string, fecha_aprobacion timestamp_ntz, "
              "factura string, ruc string, tipo_firma string, fecha_inicio_tramite timestamp_ntz, ruc_aux string, "
              "medio string, sf_control int, producto string, grupo_vendedor string, estado string, "
              "fecha_factura timestamp_ntz")


def ts(d):
    return dt.datetime(2024, 1, d)


def req(i, serial, cedula, fa, producto, estado, fi=None, ff=None, ruc_aux="R1"):
    return (i, "CAMUNDA", serial, cedula, fa, f"F{i}", "RUC", "PN", fi or ts(1), ruc_aux, "token ", 1, producto,
            None, estado, ff)


def test_requests_first_approval_sale_type_and_serial_dedup(spark):
    rows = [
        req(1, "s1", " 01 ", ts(5), "emision", "APROBADO"),          # first approval of person 01 -> NUEVO
        req(2, "s2", "01", ts(9), "RENOVACION", "APROBADO"),          # later approval -> RENOVACION
        req(3, "s3", "01", None, "emision", "NO APROBADO", fi=ts(2), ff=ts(3)),   # invoice before first approval
        req(4, "s4", "02", ts(4), "sf con firma", "APROBADO", ruc_aux="R9"),     # SF: grouped by ruc_aux
        req(5, "s5", "03", ts(4), "otro", "APROBADO"),                 # outside FIRMA/SF: no first approval
        req(6, None, "04", ts(6), "emision", "APROBADO"),              # NULL serials collapse to one row
        req(7, None, "05", ts(7), "emision", "APROBADO"),
        req(8, "s1", "01", ts(5), "emision", "NO APROBADO"),           # same serial, not approved -> loses
    ]
    ops = spark.createDataFrame(rows, REQ_SCHEMA)
    out = {r["id_tramite"]: r for r in silver.requests(ops).collect()}
    assert out[1]["tipo_venta"] == "NUEVO" and out[1]["medio"] == "TOKEN" and out[1]["cedula"] == "01"
    assert out[2]["tipo_venta"] == "RENOVACION" and out[2]["producto"] == "FIRMA"
    assert out[3]["fecha_aprobacion"] == ts(2)            # coalesce(approval, start)
    assert out[3]["tipo_venta"] == "NUEVO"                # invoice date before the first approval
    assert out[4]["producto"] == "SF" and out[4]["fecha_primer_aprobado"] == ts(4)
    assert out[5]["producto"] == "OTRO" and out[5]["fecha_primer_aprobado"] is None
    assert out[5]["tipo_venta"] == "NUEVO"
    assert 8 not in out                                   # approved beats not approved for serial s1
    assert len([k for k in out if k in (6, 7)]) == 1 and 7 in out   # NULL serial: newest approval wins


def test_articles_parse_classify_and_override(spark):
    art = spark.createDataFrame([
        ("A1", " firma elec 3 meses ", "x"), ("A2", "fact 25 transacc", ""), ("A3", "FACT PLAN  ILIMITADO", None),
        ("A4", "upgrade anio", "licencias"), ("A5", "otro 2 anios", "sistema facturacion")],
        "codart string, nomart string, nomart2 string")
    corr = spark.createDataFrame([("A5", "CORREGIDO", None, "FAM", None, "C"), ("Z9", "SOLO AQUI", "1 ANO", "F", "P", None)],
                                 "codigo string, nombre string, vigencia string, familia string, tipo_plan string, "
                                 "concepto string")
    out = {r["codigo"]: r for r in silver.articles(art, corr).collect()}
    assert out["A1"]["vigencia"] == "3 MESES" and out["A1"]["familia"] == "FIRMAS ELECTRONICAS"
    assert out["A2"]["tipo_plan"] == "PLAN MINI" and out["A2"]["familia"] == "SISTEMA DE FACTURACION"
    assert out["A3"]["tipo_plan"] == "PLAN  ILIMITADO"     # two blanks: no premium mapping (kept as parsed)
    assert out["A4"]["familia"] == "UPGRADE" and out["A4"]["nombre"] == "UPGRADE ANO"
    assert out["A5"]["nombre"] == "CORREGIDO" and out["A5"]["vigencia"] == "2 ANOS" and out["A5"]["concepto"] == "C"
    assert out["Z9"]["nombre"] == "SOLO AQUI"              # override-only row survives


FAC_SCHEMA = ("numfac string, numdoc string, cliente string, numser string, pedido string, comen1 string, "
              "comen2 string, comen3 string, subtotal decimal(18,2), desc0 decimal(18,2), "
              "total_iva decimal(18,2), total decimal(18,2), codven string, emision timestamp_ntz, "
              "fecha_hora timestamp_ntz")


def test_invoices_blank_and_null_document(spark):
    # T-06: blank documents form one group for the per-document request group (taken
    # before the blank -> invoice-code fallback); a NULL document matches nothing
    d = Decimal("1.00")

    def fac(numfac, numdoc, pedido):
        return (numfac, numdoc, "C1", "0017", pedido, "", "", "", d, d, d, d, "17", ts(1), ts(1))
    f = spark.createDataFrame([fac("FA1", "", "1"), fac("FA2", " ", "2"), fac("FA3", None, "3"),
                               fac("FA4", "D9", "4")], FAC_SCHEMA)
    first_req = spark.createDataFrame([("00171", "G1"), ("00172", "G2"), ("00173", "G3"), ("00174", "G4")],
                                      "numero_factura string, grupo_vendedor string")
    cod = spark.createDataFrame([], "codigo string")
    points = spark.createDataFrame([], "id_sucursal int, fecha_apertura date, fecha_cierre date, "
                                       "serial_punto_emision string")
    islands = spark.createDataFrame([], "numero_factura string, id_sucursal int")
    out = {r["codigo_factura"]: r for r in silver.invoices(f, None, cod, points, islands, first_req=first_req).collect()}
    assert out["FA1"]["codigo_documento"] == "FA1" and out["FA2"]["codigo_documento"] == "FA2"
    assert out["FA1"]["grupo_vendedor_temp"] == "G2" and out["FA2"]["grupo_vendedor_temp"] == "G2"
    assert out["FA3"]["codigo_documento"] is None and out["FA3"]["grupo_vendedor_temp"] is None
    assert out["FA4"]["codigo_documento"] == "D9" and out["FA4"]["grupo_vendedor_temp"] == "G4"


def _stg(spark, rows):
    return spark.createDataFrame(rows, "id_factura long, codigo_documento string, is_nc boolean, id_articulo long, "
                                       "grupo_vendedor string, subtotal_articulo decimal(18,4), "
                                       "total_sin_iva decimal(18,2), excluir_ajuste_centavos boolean")


def test_allocate_cents_rules(spark):
    d = Decimal
    rows = [(1, "D1", False, 10, "G", d("33.3333"), d("100.01"), False),   # adjusted + rounded
            (1, "D1", False, 11, "G", d("66.6667"), d("100.01"), False),
            (2, "D2", False, 10, "G", d("0.0000"), d("5.00"), False),      # sum 0, diff != 0 -> NULL (T-09)
            (3, "D3", False, 10, "G", d("10.1234"), d("20.00"), True),     # excluded -> unrounded (T-10)
            (4, "D4", False, 10, "G", d("10.1234"), d("10.12"), False),    # diff != 0 -> rounded to cents
            (5, "D5", False, 10, "G", d("12.5000"), d("12.50"), False)]    # diff = 0 -> unchanged
    out = {(r["id_factura"], r["id_articulo"]): r["subtotal_articulo"]
           for r in gold.allocate_cents(_stg(spark, rows)).collect()}
    # ROUND(s * H / sum, 2): 33.3333 * 100.01 / 100 = 33.3366 -> 33.34; 66.6733 -> 66.67
    assert out[(1, 10)] == d("33.3400") and out[(1, 11)] == d("66.6700")
    assert out[(2, 10)] is None
    assert out[(3, 10)] == d("10.1234")
    assert out[(4, 10)] == d("10.1200")
    assert out[(5, 10)] == d("12.5000")


def test_credit_note_inherits_invoice_group(spark):
    d = Decimal("1.0000")
    rows = [(1, "D1", False, 10, "GRUPO A", d, d, False), (1, "D1", False, 10, "GRUPO B", d, d, False),
            (2, "D1", True, 10, "OTRO", d, d, False),      # takes MAX of the invoice's groups
            (2, "D1", True, 99, "PROPIO", d, d, False)]    # article absent from the invoice: keeps its own
    out = {(r["id_factura"], r["id_articulo"]): r["grupo_vendedor"]
           for r in gold.inherit_credit_note_group(_stg(spark, rows)).where(F.col("is_nc")).collect()}
    assert out == {(2, 10): "GRUPO B", (2, 99): "PROPIO"}


def test_materialize_job_equals_lazy_fact(spark, tmp_dir):
    from tests.conftest import SMALL_SF
    from tools.check_queries import digest
    from ledgerlake.plans.warehouse import Warehouse, materialize
    paths = materialize(spark, SMALL_SF, tmp_dir, buckets=4)
    written = spark.read.parquet(paths["gold_fact_facturacion"])
    lazy = Warehouse(spark, SMALL_SF).fact()
    assert digest(written.columns, [tuple(r) for r in written.collect()])[0] == \
        digest(lazy.columns, [tuple(r) for r in lazy.collect()])[0]
    assert spark.table("mart_fact_facturacion_ventas").count() > 0
    assert spark.read.parquet(paths["gold_dim_fecha"]).count() == 5843
    # headers, lines and the invoice dimension are bucketed alike: with broadcasts off, the
    # three-way join on the invoice key reads all sides in place
    from pyspark.sql import functions as F
    inv, lns = spark.table("ledgerlake.silver_fenix_facturas"), spark.table("ledgerlake.silver_fenix_tranfac")
    dinv = spark.table("ledgerlake.gold_dim_facturas").select(F.col("codigo_factura").alias("df_cf"), "id_factura")
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in saved:
            spark.conf.set(k, "-1")
        j = inv.join(lns, "codigo_factura").join(dinv, F.col("codigo_factura") == F.col("df_cf"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
        # the fact is one file a bucket and meets the dimension where it lies: only ids of that move
        assert len([f for f in os.listdir(paths["gold_fact_facturacion"]) if f.endswith(".parquet")]) <= 4
        for mart in ("mart_fact_facturacion_convenios", "mart_dim_facturas_convenios"):
            plan = spark.table(mart)._jdf.queryExecution().executedPlan().toString()
            moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
            assert "SortMergeJoin" in plan and moved and not any("__f_id" in line for line in moved), plan
            if mart == "mart_fact_facturacion_convenios":
                assert len(moved) == 1 and "__df_id" in moved[0]
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_a_failing_refresh_leaves_the_last_version(spark, tmp_dir, monkeypatch):
    from tests.conftest import SMALL_SF
    from ledgerlake.operators.versions import VersionLog
    from ledgerlake.plans import gold as gold_models
    from ledgerlake.plans import standins
    from ledgerlake.plans.tables import Tables
    from ledgerlake.plans.warehouse import materialize, read_layer
    from ledgerlake.sources import fs
    t = Tables(spark, SMALL_SF)
    bronze, seeds = standins.bronze(t), dict(standins.seeds(t))
    run = lambda b: materialize(spark, None, tmp_dir, 4, "ledger_v", b, seeds, config=standins.CONFIG)
    few = bronze | {"fenix_vendedores": bronze["fenix_vendedores"].where("codven <> '3'")}
    run(few)
    log = VersionLog(spark, tmp_dir)
    first = {r.codigo_vendedor: r.id_vendedor for r in read_layer(spark, tmp_dir, "gold_dim_vendedores").collect()}
    lines = spark.table("ledger_v.silver_fenix_tranfac").count()
    assert log.version() == 1 and lines > 0
    with monkeypatch.context() as m:
        m.setattr(gold_models, "fact_billing", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(few)
    assert log.version() == 1 and spark.table("ledger_v.silver_fenix_tranfac").count() == lines
    assert {r.codigo_vendedor: r.id_vendedor for r in read_layer(spark, tmp_dir, "gold_dim_vendedores").collect()} == first
    # the next good run goes on from there: ids stay, the new seller's id follows
    run(bronze)
    now = {r.codigo_vendedor: r.id_vendedor for r in read_layer(spark, tmp_dir, "gold_dim_vendedores").collect()}
    assert log.version() == 2 and first.items() <= now.items() and now["3"] == max(now.values())
    assert read_layer(spark, tmp_dir, "gold_dim_vendedores", 1).count() == len(first)
    gone = log.vacuum(1, older_than=0)
    assert gone and spark.table("ledger_v.silver_fenix_tranfac").count() == lines
    assert all(not fs.exists(spark, f"{tmp_dir}/data/{n}") for n in gone)


def test_run_folder_goes_after_a_success_only(spark):
    from ledgerlake.session import cut_lineage, run_folder
    from ledgerlake.sources import fs
    with run_folder(spark) as path:
        assert cut_lineage(spark.range(3)).count() == 3 and len(fs.names(spark, path)) == 1
    assert not fs.exists(spark, path)
    with pytest.raises(KeyError), run_folder(spark) as path:
        cut_lineage(spark.range(3))
        raise KeyError
    assert fs.exists(spark, path)
    assert "run-" not in cut_lineage(spark.range(1)).inputFiles()[0].rsplit("/", 2)[0]


def test_production_plans_read_the_line_table_once(spark, tmp_dir):
    # staging scans the written lines once, the fact does not read them at all
    from tests.conftest import SMALL_SF
    from ledgerlake.plans import warehouse as wh
    from ledgerlake.session import cut_lineage
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    seen = {}
    w = wh.Warehouse(spark, SMALL_SF, cut=True)
    w._memo["s_lines"] = cut_lineage(w.s_lines(), "onlylines")
    w.build()
    for name, df in (("staging", wh.gold.fact_staging(
            w.s_invoices(), w.s_lines(), w.d_invoices(), w.d_customers(), w.d_sellers(), w.d_articles(), w.d_codes(),
            w.seeds, w.config, commercial=w.commercial_docs(), agents=w.agent_docs())),
            ("fact", wh.gold.fact_billing(w.staging()))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        seen[name] = sum("FileScan" in x and "/onlylines-" in x for x in plan.split("\n"))
    assert seen == {"staging": 1, "fact": 0}


def test_strict_warehouse_fails_on_reproduced_fan_out(spark):
    # parity mode reproduces the source models' fan-outs (T-07); strict mode stops the job
    from tests.conftest import SMALL_SF
    from ledgerlake.plans.warehouse import Warehouse
    assert Warehouse(spark, SMALL_SF, cut=False).fact().count() > 0
    with pytest.raises(Exception, match="expect_unique"):
        Warehouse(spark, SMALL_SF, cut=False, strict=True).fact().count()


def test_incremental_bronze_invoice_load_equals_full_load(spark):
    from tests.conftest import SMALL_SF
    from ledgerlake.operators import merge
    from ledgerlake.plans import bronze, standins
    from ledgerlake.plans.tables import Tables
    t0, t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
    extract = standins.bronze_invoices(Tables(spark, SMALL_SF))
    spec = bronze.LOAD_SPECS["fenix_facturas"]
    empty = merge.with_audit_columns(extract.where(F.lit(False)), t0)
    run1 = bronze.incremental_load(empty, extract.where(F.col("fecha_hora") < F.lit("1998-01-01").cast("timestamp_ntz")),
                                   spec, load_ts=t1)          # empty target: NULL mark loads everything given
    run2 = bronze.incremental_load(run1, extract, spec, load_ts=t2)   # only rows after the stored mark
    cols = [c for c in extract.columns]
    assert run2.count() == extract.count()
    assert run2.select(*cols).exceptAll(extract).count() == 0
    assert run2.where(F.col("creation_date") == t2).count() == \
        extract.where(F.col("fecha_hora") > run1.agg(F.max("fecha_hora")).first()[0]).count()
