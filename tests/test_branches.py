"""One scan for several branches or roles of a relation."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import branches
from ledgerlake.operators.branches import Branch
from ledgerlake.plans import q_sources
from ledgerlake.session import cut_lineage
from tests.conftest import SMALL_SF

OUT = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def test_branches_are_a_union(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(1,), (5,)], "n long")
    made = [Branch("a", F.col("k") > 0, {"k": F.col("k"), "v": F.col("v")}), Branch("a", F.col("v").isNotNull(), {"v": F.col("v")}),
            Branch("b", F.lit(True), {"k": F.col("n")}), Branch("a", F.lit(None).cast("boolean"), {"k": F.lit(9)})]
    got = branches.union_of_branches({"a": a, "b": b}, made, OUT)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "x"), (2, None), (None, "x"), (None, "y"), (1, None), (5, None)], key=str)
    every = branches.union_of_branches({"a": a, "b": b}, made, OUT, distinct=False)
    assert every.count() == 3 + 2 + 2
    with pytest.raises(ValueError, match="unknown columns"):
        branches.union_of_branches({"a": a}, [Branch("a", F.lit(True), {"z": F.lit(1)})], OUT)


def test_roles_are_joins(spark):
    df = spark.createDataFrame([(1, 10, 20), (1, 10, 20), (2, 10, None), (3, 99, 10), (4, None, 10), (5, 20, 77)], "id int, a int, b long")
    dim = spark.createDataFrame([(10, "ten", None), (20, "twenty", "z"), (30, "thirty", "q")], "code int, name string, note string")
    got = branches.role_lookup(df, dim, "code", {"first": "a", "second": "b"}, ["name", "note"], required=["first"])
    d1, d2 = (dim.select(F.col("code").alias(f"c{i}"), F.col("name").alias(f"{r}_name"), F.col("note").alias(f"{r}_note"))
              for i, r in ((1, "first"), (2, "second")))
    want = df.join(d1, F.col("a") == F.col("c1")).join(d2, F.col("b") == F.col("c2"), "left").select(*got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert branches.role_lookup(df.limit(0), dim, "code", {"first": "a"}, ["name"]).collect() == []
    with pytest.raises(Exception, match="not unique"):
        branches.role_lookup(df, dim.union(dim), "code", {"first": "a"}, ["name"]).collect()
    with pytest.raises(ValueError, match="unknown roles"):
        branches.role_lookup(df, dim, "code", {"first": "a"}, ["name"], required=["x"])


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_dimension_is_read_once_for_all_roles(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")      # whole paths in plans
    dim = cut_lineage(spark.range(50).selectExpr("id AS code", "id * 2 AS name"), "onlydim")
    df = spark.range(20).selectExpr("id", "id AS a", "id + 1 AS b", "id + 2 AS c")
    plan = _scans(branches.role_lookup(df, dim, "code", {"x": "a", "y": "b", "z": "c"}, ["name"]))
    assert sum("FileScan" in line and "/onlydim-" in line for line in plan.split("\n")) == 1


def test_ten_branches_scan_six_tables(spark):
    plan = _scans(q_sources.portal_ten_branches(spark, SMALL_SF))
    assert sum("FileScan" in line for line in plan.split("\n")) == 6
