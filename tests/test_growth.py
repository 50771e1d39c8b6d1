"""What larger tables bring: part keys of seven digits, layers a query does not need, buckets of many rows."""

import datetime as dt
import os

import duckdb
from pyspark.sql import functions as F

from ledgerlake.plans import load_all, registry
from tools.check_queries import digest

load_all()
PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def test_articles_whose_codes_share_six_digits_all_load(spark, tmp_dir):
    parts = [(k, "hot part", "B#1", "SMALL", 10, 1.0) for k in (7, 100000, 1000000, 1000001, 1199999)]
    path = os.path.join(tmp_dir, "part.parquet")
    spark.createDataFrame(parts, PART).write.parquet(path)
    found = registry.QUERIES["bronze_articulos_load"](spark, tmp_dir)
    rows = [tuple(r) for r in found.collect()]
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "events", "nation", "region", "supplier"):
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    con.execute(f"CREATE VIEW part AS FROM read_parquet('{path}/*.parquet')")
    rel = con.sql(registry.ORACLE_SQL["bronze_articulos_load"])
    assert len(rows) == len(parts)
    assert digest(found.columns, rows)[0] == digest(rel.columns, rel.fetchall())[0]
    assert {r.creation_date for r in found.collect()} == {dt.datetime(2024, 1, 1)}       # found again, not inserted anew


def test_a_query_builds_the_layers_it_reads(spark, tmp_dir):
    from ledgerlake.plans import q_models
    for t in os.listdir("/root/testdata/sf0.001"):
        os.symlink(f"/root/testdata/sf0.001/{t}", os.path.join(tmp_dir, t))
    built = lambda: set(q_models.warehouse(spark, tmp_dir, "s_codes")._memo)          # noqa: E731
    assert q_models.silver_codes(spark, tmp_dir).count() > 0 and q_models.silver_lines(spark, tmp_dir).count() > 0
    assert built() == {"s_codes", "s_lines"}
    assert q_models.request_classification(spark, tmp_dir).count() > 0
    assert built() == {"s_codes", "s_lines", "s_requests"}
    assert q_models.article_classification(spark, tmp_dir).count() > 0 and q_models.dim_article(spark, tmp_dir).count() > 0
    assert q_models.invoice_silver(spark, tmp_dir).count() > 0
    assert not built() & {"d_invoices", "commercial_docs", "agent_docs", "staging", "fact"}


def test_needs_name_all_that_a_layer_reads(spark):
    # with its needs built, a layer writes nothing but itself
    from ledgerlake.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    scanned = {"s_articles", "s_codes", "s_lines", "s_customers", "s_sellers"}      # never written
    there = lambda: ({f"seed:{n}" for n in dict.keys(w.seeds)} | set(w._memo)) - scanned      # noqa: E731
    for layer in (name for wave in w.WAVES for name in wave if name in w.NEEDS and name not in scanned):
        w.build(*w.NEEDS[layer])
        before = there()
        getattr(w, layer)()
        assert there() == before | {layer}


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F
    from ledgerlake.operators import versions
    from ledgerlake.sources import fs
    monkeypatch.setattr(versions, "TASK_BYTES", 4000)
    log = versions.VersionLog(spark, tmp_dir)
    rows = spark.range(6000).select("id", F.md5(F.col("id").cast("string")).alias("a"))
    table = versions.BucketedTable(log, "t", rows.schema, ["id"], 2, [versions.Mark("id")])
    assert table.merge(rows) == [0, 1]
    for bucket, folder in log.read()["tables"]["t"]["buckets"].items():
        assert sum(n.endswith(".parquet") for n in fs.names(spark, f"{log.path(folder)}/{versions.BUCKET}={bucket}")) > 2
    assert table.merge(rows.where("id % 2 = 0").withColumn("a", F.lit("new"))) == [0, 1]
    assert table.read().count() == 6000 and table.read().where("a = 'new'").count() == 3000
    assert table.read().select(table.mark(table.marks[0])).first()[0] == 5999


MODELS = ("seller_group", "credit_note_inheritance", "cents_allocation", "fact_billing", "mart_indirect", "mart_agreements_fact",
          "mart_sales", "dq_warehouse")


def test_a_code_of_many_articles_does_not_multiply_what_is_written(spark, tmp_dir):
    from pyspark.sql import functions as F
    from ledgerlake.plans import q_models
    small = "/root/testdata/sf0.001"
    for t in os.listdir(small):
        if t not in ("part.parquet", "lineitem.parquet"):
            os.symlink(f"{small}/{t}", os.path.join(tmp_dir, t))
    for t, key in (("part", "p_partkey"), ("lineitem", "l_partkey")):      # ten keys share their first six digits
        spark.read.parquet(f"{small}/{t}.parquet").withColumn(key, F.col(key) + 1000000).write.parquet(f"{tmp_dir}/{t}.parquet")
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "events", "nation", "region", "supplier", "part"):
        path = os.path.join(tmp_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    for name in MODELS:
        found = registry.QUERIES[name](spark, tmp_dir)
        rel = con.sql(registry.ORACLE_SQL[name])
        assert digest(found.columns, [tuple(r) for r in found.collect()])[0] == digest(rel.columns, rel.fetchall())[0], name
    w = q_models.warehouse(spark, tmp_dir, "s_lines")
    lines = w.s_lines().count()
    assert w.fact().count() > 3 * lines
    assert max(df.count() for df in w._memo.values()) < 2 * lines


def test_seller_groups_of_a_line_keep_their_number_of_rows(spark):
    from pyspark.sql import functions as F
    from ledgerlake.plans import gold
    rows = [("A", "B", "A", 2, 3, 4), ("A", "A", "A", 1, 1, 1), (None, "B", None, 5, 0, 1), ("A", "B", "C", 0, 1, 0)]
    df = spark.createDataFrame(rows, "a string, b string, c string, x long, y long, z long")
    out = df.select(F.inline(gold._grouped_copies([F.col(c) for c in "abc"], [F.col(c) for c in "xyz"]))).where(F.col(gold.COPIES) > 0)
    assert sorted(((r[0] or "-", r[1]) for r in out.collect())) == [("-", 6), ("A", 3), ("A", 6), ("B", 1), ("B", 3)]
    assert gold.expand(out).groupBy("grupo_vendedor").count().orderBy("grupo_vendedor").collect()[0][1] == 6
    assert gold.expand(df) is df


def test_checks_count_a_row_as_often_as_it_stands(spark):
    from ledgerlake.operators import quality
    child = spark.createDataFrame([("a", 2), ("b", 1), (None, 5), ("z", 3), ("z", 4)], "p string, n long")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "p string")
    checks = [quality.Check("unique", "child", "p"), quality.Check("not_null", "child", "p"),
              quality.Check("relationships", "child", "p", quality.WARN, "parent", "p")]
    models = {"child": child, "parent": parent}
    found = lambda **k: {r["check"]: r["failures"] for r in quality.run_checks(checks, models, **k).collect()}      # noqa: E731
    assert found() == {"unique": 1, "not_null": 1, "relationships": 2}
    assert found(copies={"child": "n"}) == {"unique": 2, "not_null": 5, "relationships": 7}


def test_a_staged_sum_is_the_sum_of_the_rows(spark):
    # the sum of a line's copies and header rows, as a grouping of the full rows gives it
    from pyspark.sql import functions as F
    from ledgerlake.plans import gold
    from ledgerlake.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    full = w.staging()
    assert gold.SUM not in full.columns and gold.COPIES not in full.columns
    key = ["id_factura", "id_articulo", gold.SUM, "subtotal_articulo"]
    want = gold.allocate_cents(full).select(*key)
    got = gold.expand(gold.allocate_cents(w.staged())).select(*key)
    assert want.count() == got.count() > 0 and want.exceptAll(got).count() == 0 == got.exceptAll(want).count()


def test_a_report_in_steps_is_that_of_one_plan_and_leaves_no_plan_of_checks(spark, tmp_dir):
    from ledgerlake.operators import quality
    child = spark.createDataFrame([("a", 2), ("b", 1), (None, 5), ("z", 3), ("z", 4)], "p string, n long")
    for name, df in (("child", child), ("parent", spark.createDataFrame([("a",), ("b",), ("b",)], "p string"))):
        df.write.parquet(f"{tmp_dir}/{name}")
    models = {name: spark.read.parquet(f"{tmp_dir}/{name}") for name in ("child", "parent")}
    checks = [quality.Check("unique", "child", "p"), quality.Check("unique", "child", "p", quality.WARN),
              quality.Check("not_null", "child", "p"), quality.Check("not_null", "child", "n"), quality.Check("not_null", "parent", "p"),
              quality.Check("relationships", "child", "p", quality.WARN, "parent", "p"), quality.Check("unique", "parent", "p")]
    for known, copies in ((None, None), ({("child", "p"): 1, ("parent", "p"): 0}, None), ({}, {"child": "n"})):
        want = quality.run_checks(checks, models, known, copies)
        got = quality.report_in_steps(checks, models, known, copies)
        assert got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == len(checks)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan and "Relation [" not in plan


def test_dq_warehouse_holds_no_plan_of_all_checks(spark):
    plan = registry.QUERIES["dq_warehouse"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Relation [" not in plan


def test_checks_broadcast_a_side_by_its_measured_size(spark, tmp_dir):
    # keys in files take a small part of what their hash table takes in the driver
    from ledgerlake.operators import quality
    from ledgerlake.session import measured_broadcasts
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    spark.range(300000, numPartitions=1).write.parquet(f"{tmp_dir}/parent")
    spark.range(0, 400000, 2, numPartitions=1).write.parquet(f"{tmp_dir}/child")
    models = {name: spark.read.parquet(f"{tmp_dir}/{name}") for name in ("parent", "child")}

    def plan():
        report = quality.run_checks([quality.Check("relationships", "child", "id", "warn", "parent", "id")], models)
        assert report.collect()[0]["failures"] == 50000
        return report._jdf.queryExecution().executedPlan().toString()

    before = {k: spark.conf.get(k, None) for k in (planned, measured)}
    spark.conf.set(planned, str(3 << 20))
    try:
        assert "BroadcastHashJoin" in plan()
        with measured_broadcasts(spark):
            assert spark.conf.get(planned) == "-1" and spark.conf.get(measured) == str(3 << 20)
            assert "BroadcastHashJoin" not in plan()
        assert spark.conf.get(planned) == str(3 << 20) and spark.conf.get(measured, None) == before[measured]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_null_check_reads_only_rows_with_a_null_below_a_join(spark, tmp_dir):
    from ledgerlake.operators import quality
    spark.range(50).selectExpr("id", "IF(id % 10 = 0, NULL, id) AS v").write.parquet(f"{tmp_dir}/l")
    spark.range(40).selectExpr("id AS k").write.parquet(f"{tmp_dir}/r")
    both = spark.read.parquet(f"{tmp_dir}/l").join(spark.read.parquet(f"{tmp_dir}/r"), F.col("id") == F.col("k"))
    report = quality.run_checks([quality.Check("not_null", "m", "v"), quality.Check("not_null", "m", "k")], {"m": both})
    assert {r["column"]: r["failures"] for r in report.collect()} == {"v": 4, "k": 0}
    single = quality.run_checks([quality.Check("not_null", "m", "v")], {"m": both})
    assert "PushedFilters: [IsNull(v)" in single._jdf.queryExecution().executedPlan().toString()
