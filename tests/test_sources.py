"""Readers, run-mode registry and calendar."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources import calendar, readers
from ledgerlake.sources.registry import RunMode, SourceSpec, read_sources, sources_for


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_csv_strict_errors(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        readers.csv_strict(spark, os.path.join(tmp_dir, "nope.csv"), ["a"])
    p = write(os.path.join(tmp_dir, "empty.csv"), "codigo_factura,motivo\n")
    with pytest.raises(ValueError):
        readers.csv_strict(spark, p, ["codigo_factura", "motivo"])
    p = write(os.path.join(tmp_dir, "ok.csv"), "codigo_factura,motivo\nFA1,x\n")
    assert readers.csv_strict(spark, p, ["codigo_factura", "motivo"]).count() == 1


def test_csv_lenient_na_tokens(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "l.csv"), "a;b\nNA;1\nx;NULL\n")
    got = [tuple(r) for r in readers.csv_lenient(spark, p, ["a", "b"], sep=";").collect()]
    assert got == [(None, "1"), ("x", None)]


def test_seed_with_bom_and_spaced_header(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "s.csv"), "﻿ codigo_documento, activo,fecha\nD1, true,2024-01-02\n")
    schema = T.StructType([T.StructField("codigo_documento", T.StringType()),
                           T.StructField("activo", T.BooleanType()), T.StructField("fecha", T.DateType())])
    r = readers.read_seed(spark, p, schema).first()
    assert tuple(r) == ("D1", True, dt.date(2024, 1, 2))


def test_csv_binds_by_name(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "r.csv"), '\ufeff b ,a\n1,"say ""x"" now"\n"two\nlines, and more",\n')
    got = [tuple(r) for r in readers.csv_strict(spark, p, ["a", "b"]).collect()]
    assert got == [('say "x" now', "1"), (None, "two\nlines, and more")]
    assert readers.csv_strict(spark, p).columns == ["b", "a"]
    assert readers.csv_strict(spark, p, ["a", "b"]).count() == 2
    assert [r.a for r in readers.csv_strict(spark, p, ["a", "b"]).select("a").collect()] == ['say "x" now', None]


def test_csv_header_is_checked(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "h.csv"), "a,b,c\n1,2,3\n")
    with pytest.raises(readers.CsvHeaderError, match=r"missing \['d'\], unknown \['c'\]"):
        readers.csv_strict(spark, p, ["a", "b", "d"])
    with pytest.raises(readers.CsvHeaderError, match="unknown"):
        readers.csv_strict(spark, p, ["a", "b"])
    assert readers.csv_lenient(spark, p, ["c", "a"]).first() == ("3", "1")
    with pytest.raises(readers.CsvHeaderError, match="missing"):
        readers.csv_lenient(spark, p, ["x"])
    p = write(os.path.join(tmp_dir, "twice.csv"), "a, a\n1,2\n")
    with pytest.raises(readers.CsvHeaderError, match=r"repeated \['a'\]"):
        readers.csv_strict(spark, p, ["a"])
    seed = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("z", T.StringType())])
    with pytest.raises(readers.CsvHeaderError):
        readers.read_seed(spark, write(os.path.join(tmp_dir, "s2.csv"), "a,y\n1,x\n"), seed)


def test_csv_folder_with_another_header_fails(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "many")
    os.mkdir(folder)
    write(os.path.join(folder, "p1.csv"), "a,b\n1,2\n")
    write(os.path.join(folder, "p2.csv"), "a,b\n3,4\n")
    assert sorted(tuple(r) for r in readers.csv_strict(spark, folder, ["b", "a"]).collect()) == [("2", "1"), ("4", "3")]
    write(os.path.join(folder, "p3.csv"), "b,a\n5,6\n")
    with pytest.raises(Exception, match="header"):
        readers.csv_strict(spark, folder, ["b", "a"]).collect()


def test_csv_without_lines(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "nothing.csv"), "")
    with pytest.raises(readers.CsvHeaderError):
        readers.csv_strict(spark, p, ["a"])
    p = write(os.path.join(tmp_dir, "head.csv"), "a\n")
    assert readers.csv_lenient(spark, p, ["a"]).collect() == []


def test_sql_extract_binds_named_params(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    df.createOrReplaceTempView("t_params")
    assert readers.sql_extract(spark, "SELECT * FROM t_params WHERE x > :hwm", {"hwm": 6}).count() == 3


def test_in_list_filter_literal_and_join_paths(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert readers.in_list_filter(df, "v", [1]).count() == 1
    assert readers.in_list_filter(df, "v", [1], negate=True).count() == 1   # NULL operand dropped
    big = list(range(5000))
    assert readers.in_list_filter(df, "v", big).count() == 2
    assert readers.in_list_filter(df, "v", big, negate=True).count() == 0


def test_run_mode_registry_unions_by_name(spark):
    a = SourceSpec("a", "PORTAL", lambda s, p: s.createDataFrame([(1, 2.0)], "id int, v double"))
    b = SourceSpec("b", "CAMUNDA", lambda s, p: s.createDataFrame([(2,)], "id int"))
    reg = {RunMode.FULL: [a, b], RunMode.INCREMENTAL: [b]}
    got = read_sources(spark, sources_for(reg, "INICIAL"), priority_col="prio")
    assert sorted(tuple(r) for r in got.select("id", "v", "origen", "prio").collect()) == \
        [(1, 2.0, "PORTAL", 0), (2, None, "CAMUNDA", 1)]
    assert read_sources(spark, sources_for(reg, RunMode.INCREMENTAL)).count() == 1


def test_calendar_reference_span(spark):
    cal = calendar.dim_date(calendar.date_spine(spark))
    assert cal.count() == 5843
    last = cal.agg(F.max("date")).first()[0]
    assert last == dt.date(2030, 12, 30)


def test_read_seed_directory_and_warehouse_override(spark, tmp_dir):
    from ledgerlake.plans.seeds import read_seeds
    from ledgerlake.plans.warehouse import Warehouse
    from tests.conftest import SMALL_SF
    write(os.path.join(tmp_dir, "reasignacion_subtotal.csv"), "﻿numero_factura,motivo\n0010000000002,ajuste\n")
    write(os.path.join(tmp_dir, "vendedores_comercial.csv"),
          " codigo_vendedor,fecha_inicio,fecha_fin\n7,2020-01-01,2020-12-31\n")
    seeds = read_seeds(spark, tmp_dir)
    assert set(seeds) == {"reasignacion_subtotal", "vendedores_comercial"}
    assert seeds["vendedores_comercial"].first()["fecha_fin"] == dt.date(2020, 12, 31)
    from ledgerlake.plans import standins
    from ledgerlake.plans.tables import Tables
    t = Tables(spark, SMALL_SF)
    with pytest.raises(ValueError, match=r"bronze.fenix_facturas.*seeds.articulos_comercial.*config"):
        Warehouse(spark, SMALL_SF, cut=False, seeds=seeds)          # nothing is filled in silently
    w = Warehouse(spark, cut=False, bronze=standins.bronze(t), seeds={**standins.seeds(t), **seeds},
                  config=standins.CONFIG)
    assert w.seeds["reasignacion_subtotal"].count() == 1            # the file, not the stand-in


def test_second_configuration_changes_the_rules(spark):
    import dataclasses
    from ledgerlake.plans import standins
    from ledgerlake.plans.tables import Tables
    from ledgerlake.plans.warehouse import Warehouse
    from tests.conftest import SMALL_SF
    t = Tables(spark, SMALL_SF)
    everyone = tuple(str(r["c_custkey"]) for r in t.customer.select("c_custkey").collect())
    seen = []
    for special in ((), everyone):
        config = dataclasses.replace(standins.CONFIG, special_customers=special, special_group="OTRO GRUPO",
                                     default_group="SIN GRUPO", commercial_customers=(), corporate_cifs=("CORP9",))
        w = Warehouse(spark, cut=True, bronze=standins.bronze(t), seeds=standins.seeds(t), config=config)
        seen.append({r["grupo_vendedor"] for r in w.staging().select("grupo_vendedor").distinct().collect()})
    assert "SIN GRUPO" in seen[0] and "OTRO GRUPO" not in seen[0]
    assert "OTRO GRUPO" in seen[1] and "SIN GRUPO" not in seen[1]
    assert not {"GRUPO ESPECIAL", "GRUPO SECURITY DATA"} & (seen[0] | seen[1])
