"""Property tests: the parallel algorithms equal their single-task definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import dedup, keys

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["hot", "a", "b"])),
                          st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=60)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=ROWS, buckets=st.integers(2, 9))
def test_keep_first_equals_window(spark, rows, buckets):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k string, v int, id int")
    order = [F.col("v").desc_nulls_first(), F.col("id").asc()]
    ref = (df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
           .where("rn = 1").select("id"))
    got = dedup.keep_first(df, ["k"], order, salt_buckets=buckets).select("id")
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in ref.collect())


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.text("abcxyz", max_size=3)), min_size=1, max_size=50),
       parts=st.integers(1, 7))
def test_dense_keys_equal_dense_rank(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "k string")
    got = {r["k"]: r["id"] for r in keys.dense_keys(df, ["k"], "id", num_partitions=parts).collect()}
    distinct = sorted({v for v in values if v is not None})
    expect = {v: i + 1 for i, v in enumerate(distinct)}
    if None in values:
        expect[None] = len(distinct) + 1          # NULL key numbered last
    assert got == expect
