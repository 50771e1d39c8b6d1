"""Operators: skew-safe dedup, keys, joins, merges, quality checks."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import aggregates, dedup, joins, keys, merge, quality
from ledgerlake.operators import transforms as tf


def _key(t):
    return tuple((v is not None, v) for v in t)


def rows(df, *cols):
    """Sorted row tuples; NULLs sort first."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


def test_keep_first_two_phase_equals_one_phase_with_hot_key(spark):
    # one key holds most rows, NULL key is its own group (T-01, T-02)
    data = [(("hot" if i % 10 else None) if i % 7 else "k%d" % (i % 5), i % 13, i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, score int, id int")
    order = [F.col("score").desc_nulls_first(), F.col("id").asc()]
    ref = (df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
           .where("rn = 1").drop("rn"))
    got = dedup.keep_first(df, ["k"], order, salt_buckets=16)
    assert rows(got, "k", "score", "id") == rows(ref, "k", "score", "id")


def test_keep_first_default_reduces_map_side(spark):
    # default plan: Spark's partial WindowGroupLimit keeps one row per key per map task
    # before the shuffle, so a hot key never reaches one reducer whole
    data = [("hot" if i % 3 else "k%d" % (i % 4), i % 11, i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, score int, id int").repartition(6)
    order = [F.col("score").desc(), F.col("id").asc()]
    got = dedup.keep_first(df, ["k"], order)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    ref = (df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
           .where("rn = 1").drop("rn"))
    assert rows(got, "k", "score", "id") == rows(ref, "k", "score", "id")


def test_drop_duplicates_pandas_rules(spark):
    df = spark.createDataFrame([(None, None, 1), ("a", None, 2), ("a", None, 3), ("b", "x", 4)],
                               "a string, b string, seq int")
    first = dedup.drop_duplicates(df, ["a", "b"], "first", row_order=["seq"])
    assert rows(first, "seq") == [(2,), (4,)]
    last = dedup.drop_duplicates(df, ["a", "b"], "last", row_order=["seq"])
    assert rows(last, "seq") == [(3,), (4,)]
    none = dedup.drop_duplicates(df, ["a", "b"], False)
    assert rows(none, "seq") == [(4,)]
    with pytest.raises(ValueError):
        dedup.drop_duplicates(df, ["a"], "first")


def test_dense_keys_match_row_number(spark):
    df = spark.createDataFrame([(f"k{i % 37:03d}",) for i in range(500)], "k string")
    got = keys.dense_keys(df, ["k"], "id", num_partitions=7)
    expect = [(i + 1, f"k{i:03d}") for i in range(37)]
    assert rows(got, "id", "k") == expect


def test_global_row_number_is_total_and_dense(spark):
    df = spark.range(0, 1000).withColumn("v", (F.col("id") * 7919) % 1000)
    got = keys.global_row_number(df, [F.col("v").desc(), F.col("id").asc()], "rn", num_partitions=5)
    r = rows(got, "rn", "v")
    assert [x[0] for x in r] == list(range(1, 1001))
    assert [x[1] for x in r] == sorted([x[1] for x in r], reverse=True)


@pytest.mark.parametrize("parts", [1, 2, 8, 13])
def test_global_row_number_with_payload_columns_written(spark, tmp_dir, parts):
    # columns beside the order keys, and the result written: the numbers must still be 1..n
    df = (spark.range(20000).withColumn("v", F.hash("id") % 500)
          .withColumn("payload", F.repeat(F.col("id").cast("string"), 20)).repartition(7))
    path = f"{tmp_dir}/numbered"
    keys.global_row_number(df, [F.col("v").asc(), F.col("id").desc()], "rn", num_partitions=parts).write.parquet(path)
    got = spark.read.parquet(path)
    row = got.agg(F.countDistinct("rn"), F.min("rn"), F.max("rn"), F.count("payload")).first()
    assert tuple(row) == (20000, 1, 20000, 20000)
    w = got.withColumn("want", F.row_number().over(Window.orderBy("v", F.col("id").desc())))
    assert w.where("rn <> want").count() == 0


def test_range_partitions_follow_the_input_size(spark):
    assert [keys._bytes(v) for v in ("67108864", "64m", "256MB", "1g")] == [1 << 26, 1 << 26, 1 << 28, 1 << 30]
    small = spark.range(100)
    assert keys._range_partitions(small) == 1
    cap = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        assert keys._range_partitions(spark.range(100000)) == cap      # large -> capped
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_stable_keys_keep_existing_ids(spark):
    old = spark.createDataFrame([(1, "b"), (2, "d")], "id long, k string")
    new = spark.createDataFrame([("a",), ("b",), ("e",)], "k string")
    got = keys.stable_keys(new, old, ["k"], "id")
    assert rows(got, "id", "k") == [(1, "b"), (2, "d"), (3, "a"), (4, "e")]


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    assert rows(keys.category_codes(df, "c", "code"), "c", "code") == [(None, -1), ("a", 0), ("b", 1), ("b", 1)]


def test_interval_join_half_open_and_fan_out(spark):
    pts = spark.createDataFrame([(1, dt.date(2024, 1, 31)), (1, dt.date(2024, 2, 1))], "k int, d date")
    iv = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 2, 1), "jan"),
                                (1, dt.date(2024, 1, 15), dt.date(2024, 3, 1), "wide")],
                               "k int, s date, e date, name string")
    got = joins.interval_join(pts, iv, ["k"], "d", "s", "e", "left")
    assert rows(got, "d", "name") == [(dt.date(2024, 1, 31), "jan"), (dt.date(2024, 1, 31), "wide"),
                                       (dt.date(2024, 2, 1), "wide")]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "bigint"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_binned_interval_join_equals_the_plain_one(spark, kind, how):
    def at(days):
        if kind == "bigint":
            return F.col(days).cast("bigint")
        return F.date_add(F.lit("2020-02-20").cast("date"), F.col(days)).cast(kind)
    pts = (spark.range(600).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), (F.col("id") * 7 % 1000).cast("int").alias("n"))
           .withColumn("n", F.when(F.col("n") % 50 != 0, F.col("n"))).select("k", at("n").alias("d")))
    iv = spark.range(80).select(
        F.when(F.col("id") % 9 != 0, F.col("id") % 3).alias("k2"), (F.col("id") * 37 % 1300 - 200).cast("int").alias("a"),
        (F.col("id") % 11 * 31 - 15).cast("int").alias("w"), F.col("id").alias("name"))
    iv = (iv.withColumn("b", (F.col("a") + F.col("w"))).select("k2", at("a").alias("s"), at("b").alias("e"), "name")
          .union(iv.limit(1).select(F.lit(0), at("a"), F.lit(None).cast(kind), F.lit(-1)))
          .union(iv.limit(1).select(F.lit(0), at("a") if kind == "bigint" else F.lit("0001-01-01").cast(kind),
                                    F.lit(1 << 62) if kind == "bigint" else F.lit("9999-12-31").cast(kind), F.lit(-2))))
    want = rows(joins.interval_join(pts, iv, [("k", "k2")], "d", "s", "e", how), *([] if "semi" in how or "anti" in how else ["name"]), "k", "d")
    for bins in (1, 2, 7, 256):
        got = joins.binned_interval_join(pts, iv, [("k", "k2")], "d", "s", "e", how, bins)
        assert got.columns == joins.interval_join(pts, iv, [("k", "k2")], "d", "s", "e", how).columns
        assert rows(got, *([] if "semi" in how or "anti" in how else ["name"]), "k", "d") == want
    empty = joins.binned_interval_join(pts.where("false"), iv, [("k", "k2")], "d", "s", "e", how)
    assert empty.count() == 0


def test_binned_interval_join_refuses_what_it_cannot_keep(spark):
    pts, iv = spark.createDataFrame([(1, 1.5)], "k int, d double"), spark.createDataFrame([(1, 1, 2)], "k int, s int, e int")
    with pytest.raises(ValueError, match="left side"):
        joins.binned_interval_join(pts, iv, ["k"], "d", "s", "e", "full")
    with pytest.raises(TypeError, match="not double"):
        joins.binned_interval_join(pts, iv, ["k"], "d", "s", "e")


def test_binned_interval_join_cuts_a_hot_key(spark):
    """All points on one key: no bin of it meets more than a few of its intervals."""
    pts = spark.range(20000).select(F.lit(1).alias("k"), (F.col("id") % 4096).alias("d"))
    iv = spark.range(512).select(F.lit(1).alias("k"), (F.col("id") * 8).alias("s"), (F.col("id") * 8 + 8).alias("e"))
    got = joins.binned_interval_join(pts, iv, ["k"], "d", "s", "e")
    assert got.count() == 20000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__ll_bin_l" in plan and "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()


def test_full_override_keeps_override_only_rows(spark):
    base = spark.createDataFrame([("a", "x", "1"), ("b", "y", "2")], "k string, f string, g string")
    over = spark.createDataFrame([("b", "Y", None), ("c", "Z", "3")], "k string, f string, g string")
    got = joins.full_override(base, over, "k", ["f", "g"])
    assert rows(got, "k", "f", "g") == [("a", "x", "1"), ("b", "Y", "2"), ("c", "Z", "3")]


def test_attach_default_row_is_null_when_absent(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    lk = spark.createDataFrame([("A", 10)], "code string, v int")
    assert rows(joins.attach_default_row(df, lk, "code", "A", {"d": "v"}), "id", "d") == [(1, 10), (2, 10)]
    assert rows(joins.attach_default_row(df, lk, "code", "Z", {"d": "v"}), "id", "d") == [(1, None), (2, None)]


def test_expect_unique_fails_inside_the_job(spark):
    ok = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (None, "n")], "k int, v string")
    assert rows(joins.expect_unique(ok, ["k"]), "k", "v") == [(None, "n"), (None, "n"), (1, "a"), (2, "b")]
    dup = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    left = spark.createDataFrame([(1, 10), (2, 20)], "k int, x int")
    guarded = left.join(joins.expect_unique(dup, ["k"], "unit"), "k")   # lazy: no action yet
    with pytest.raises(Exception, match="expect_unique"):
        guarded.collect()


def test_semi_or_exists(spark):
    p = spark.createDataFrame([(1, "red x"), (2, "blue"), (3, "green")], "k int, n string")
    s = spark.createDataFrame([(3,)], "k2 int")
    assert rows(joins.semi_or(p, s, [("k", "k2")], F.col("n").like("red%")), "k") == [(1,), (3,)]


def test_join_back_aggregate_null_keys_group_together(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "k string, v int")
    got = joins.join_back_aggregate(df, ["k"], [F.sum("v").alias("s")])
    assert rows(got, "k", "v", "s") == [(None, 1, 3), (None, 2, 3), ("a", 5, 5)]


def test_conditional_min_over(spark):
    df = spark.createDataFrame([("a", "OK", 3), ("a", "NO", 1), ("a", "OK", 2), ("b", "NO", 9)],
                               "k string, st string, v int")
    got = aggregates.conditional_min_over(df, ["k"], F.col("v"), F.col("st") == "OK", "m")
    assert rows(got, "k", "v", "m") == [("a", 1, 2), ("a", 2, 2), ("a", 3, 2), ("b", 9, None)]


def test_upsert_semantics_and_idempotence(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, amt int")
    src = spark.createDataFrame([(2, "B", None), (3, "C", 30)], "k int, name string, amt int")
    once = merge.upsert(tgt, src, ["k"], update_cols=["name", "amt"])
    assert rows(once, "k", "name", "amt") == [(1, "a", 10), (2, "B", None), (3, "C", 30)]
    twice = merge.upsert(once, src, ["k"], update_cols=["name", "amt"])
    assert rows(twice, "k", "name", "amt") == rows(once, "k", "name", "amt")
    keep_amt = merge.upsert(tgt, src, ["k"], update_cols=["name"])
    assert rows(keep_amt, "k", "name", "amt") == [(1, "a", 10), (2, "B", 20), (3, "C", 30)]


def test_upsert_null_key_is_inserted_again(spark):
    tgt = spark.createDataFrame([(None, "a")], "k int, v string")
    src = spark.createDataFrame([(None, "b")], "k int, v string")
    assert merge.upsert(tgt, src, ["k"]).count() == 2   # T-12


def test_insert_ignore_and_update_only_and_append(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src = spark.createDataFrame([(2, "X"), (3, "Y")], "k int, v string")
    assert rows(merge.insert_ignore(tgt, src, ["k"]), "k", "v") == [(1, "a"), (2, "b"), (3, "Y")]
    assert rows(merge.update_only(tgt, src, "k", {"v": "v"}, update_date_col=None), "k", "v") == [(1, "a"), (2, "X")]
    assert merge.persist(tgt, src, "insert").count() == 4
    with pytest.raises(ValueError):
        merge.persist(tgt, src, "update")
    with pytest.raises(ValueError):
        merge.persist(tgt, src, "bogus", keys=["k"])


def test_audit_columns_on_upsert(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    tgt = merge.with_audit_columns(spark.createDataFrame([(1, "a")], "k int, v string"), t0)
    src = spark.createDataFrame([(1, "A"), (2, "B")], "k int, v string")
    got = merge.upsert(tgt, src, ["k"], ["v", "update_date"], load_ts=t1, audit=True)
    assert rows(got, "k", "v", "creation_date", "update_date") == [(1, "A", t0, t1), (2, "B", t1, t1)]


def test_load_once_guard(spark):
    src = spark.createDataFrame([(1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    full = spark.createDataFrame([(9,)], "k int")
    assert rows(merge.load_once(empty, src), "k") == [(1,)]
    assert rows(merge.load_once(full, src), "k") == [(9,)]


def test_transform_chain_and_guards(spark):
    df = spark.createDataFrame([(" x ", 1.0, "2024-01-01 00:00:00")], "a string, b double, c string")
    out = tf.chain(df, [lambda d: tf.trim_text_columns(d), lambda d: tf.rename_columns(d, {"a": "aa", "zz": "q"}),
                        lambda d: tf.cast_datetime_columns(d, ["c"]), lambda d: tf.add_constant(d, "o", "S")])
    r = out.first()
    assert r["aa"] == "x" and r["c"] == dt.datetime(2024, 1, 1) and r["o"] == "S"
    with pytest.raises(ValueError):
        tf.drop_columns(df, ["missing"])
    with pytest.raises(ValueError):
        tf.union_by_name(df)


def test_flags_three_valued(spark):
    df = spark.createDataFrame([("F",), (None,), ("O",)], "s string")
    out = tf.inequality_flag(tf.equality_flag(df, "s", "F", "eq"), "s", "F", "ne")
    assert rows(out, "s", "eq", "ne") == [(None, False, True), ("F", True, False), ("O", False, True)]


def test_bool_truthiness(spark):
    df = spark.createDataFrame([("", 0.0), ("false", float("nan")), (None, None), ("x", 2.0)], "s string, d double")
    out = tf.cast_bool_columns(df, ["s", "d"])
    assert [tuple(r) for r in out.collect()] == [(False, False), (True, True), (False, False), (True, True)]


def test_quality_report_and_enforce(spark):
    child = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "z")], "id int, p string")
    parent = spark.createDataFrame([("a",)], "p string")
    checks = [quality.Check("unique", "child", "p", quality.WARN),
              quality.Check("not_null", "child", "p", quality.WARN),
              quality.Check("relationships", "child", "p", quality.ERROR, "parent", "p")]
    rep = quality.run_checks(checks, {"child": child, "parent": parent})
    assert rows(rep, "check", "failures") == [("not_null", 1), ("relationships", 1), ("unique", 1)]
    with pytest.raises(AssertionError):
        quality.enforce(rep)


def test_nulls_counted_while_writing_replace_the_scan(spark):
    df = spark.range(1000, numPartitions=7).select(
        F.col("id"), F.when(F.col("id") % 4 != 1, F.col("id")).alias("p"), F.lit(None).cast("string").alias("q"))
    out, nulls = quality.write_counting_nulls(df.repartition(5, "p"), ["p", "id", "q", "p"], "nulls")
    assert nulls == {"p": 250, "id": 0, "q": 1000} and out.count() == 1000
    none, nulls = quality.write_counting_nulls(df.where("id < 0"), ["p"], "nulls")
    assert nulls == {"p": 0} and none.count() == 0 and none.columns == df.columns
    assert quality.write_counting_nulls(df, [], "nulls")[1] == {}
    literal = spark.createDataFrame([], "p string")             # a plan that is empty before it runs
    assert quality.write_counting_nulls(literal, ["p"], "nulls")[1] == {"p": 0}
    checks = [quality.Check("not_null", "m", "p", quality.WARN), quality.Check("not_null", "m", "q"), quality.Check("unique", "m", "id")]
    want = rows(quality.run_checks(checks, {"m": out}), "check", "column", "severity", "failures")
    for known in ({("m", "p"): 250}, {("m", "p"): 250, ("m", "q"): 1000}):
        got = quality.run_checks(checks, {"m": out}, known)
        assert rows(got, "check", "column", "severity", "failures") == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 3 - len(known)
    assert quality.run_checks(checks[:1], {"m": out}, {("m", "p"): 250}).first()["failures"] == 250


def test_materialisations_and_snapshot_write(spark, tmp_dir):
    import os
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = os.path.join(tmp_dir, "snap")
    merge.write_snapshot(df, path, partition_by=["v"], max_records_per_file=1)
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "a"), (2, "b")]
    merge.materialize_view(df, "ll_test_view")
    assert spark.table("ll_test_view").count() == 2
    assert merge.duplicate_keys(df.unionAll(df), ["k"]).count() == 2
    nulls = spark.createDataFrame([(None, "a"), (None, "b")], "k int, v string")
    assert merge.duplicate_keys(nulls, ["k"]).count() == 0
    with pytest.raises(ValueError):
        merge.assert_unique_keys(df.unionAll(df), ["k"])


def test_cut_lineage_reads_back_from_checkpoint_dir(spark):
    from ledgerlake.session import cut_lineage
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    out = cut_lineage(df, "unit")
    assert out.count() == 100
    assert "FileScan" in out._jdf.queryExecution().executedPlan().toString() or \
        "Scan parquet" in out._jdf.queryExecution().executedPlan().toString()


def test_after_watermark_null_mark_loads_all(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    assert df.where(aggregates.after_watermark("v", None)).count() == 3
    assert rows(df.where(aggregates.after_watermark("v", 1)), "v") == [(5,)]
    assert rows(df.where(aggregates.after_watermark("v", 1, inclusive=True)), "v") == [(1,), (5,)]


def test_bucketed_target_merges_without_shuffling_the_target(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tgt = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        merge.write_bucketed_snapshot(tgt, "ll_bucketed_target", ["k"], 4)
        snap = spark.table("ll_bucketed_target")
        src = spark.range(1990, 2010).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"))
        out = merge.upsert(snap, src, ["k"], ["v"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        # one exchange: the increment; the bucketed snapshot is read in place
        assert plan.count("Exchange hashpartitioning") == 1
        assert out.count() == 2010
        # the next snapshot is written in place: one file per bucket, no reshuffle
        merge.write_bucketed_snapshot(out, "ll_bucketed_target_2", ["k"], 4, in_bucket_layout=True)
        nxt = spark.table("ll_bucketed_target_2")
        assert len(nxt.inputFiles()) == 4
        assert rows(nxt.where("k >= 1998"), "k", "v") == [(k, -1) for k in range(1998, 2010)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_can_reject_a_repeated_source_key(spark):
    tgt = spark.createDataFrame([(1, "t")], "k int, v string")
    src = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n"), (None, "m")], "k int, v string")
    with pytest.raises(Exception, match="expect_unique"):
        merge.upsert(tgt, src, ["k"], reject_repeated_keys=True).collect()
    ok = src.where("v <> 'b'")
    assert rows(merge.upsert(tgt, ok, ["k"], reject_repeated_keys=True), "k", "v") == [
        (None, "m"), (None, "n"), (1, "a")]


def test_update_only_last_row_of_repeated_key_wins(spark):
    tgt = spark.createDataFrame([(1, "t", None), (2, "u", None)], "k int, v string, update_date timestamp_ntz")
    src = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (3, "x", 3)], "k int, v string, seq int")
    out = merge.update_only(tgt, src, "k", {"v": "v"}, last_by=["seq"])
    assert rows(out, "k", "v") == [(1, "b"), (2, "u")]


def test_insert_ignore_keeps_first_of_repeated_source_key(spark):
    tgt = spark.createDataFrame([(1, "t")], "k int, v string")
    src = spark.createDataFrame([(2, "b", 2), (2, "a", 1), (1, "x", 3), (None, "n", 4)], "k int, v string, seq int")
    out = merge.insert_ignore(tgt, src, ["k"], order=[F.col("seq").asc()])
    assert rows(out, "k", "v") == [(None, "n"), (1, "t"), (2, "a")]


def test_null_keys_bypass_the_merge_join(spark):
    tgt = spark.createDataFrame([(None, "t1"), (1, "a"), (None, "t2")], "k int, v string")
    src = spark.createDataFrame([(None, "s1"), (1, "A"), (2, "B")], "k int, v string")
    assert rows(merge.upsert(tgt, src, ["k"]), "k", "v") == [
        (None, "s1"), (None, "t1"), (None, "t2"), (1, "A"), (2, "B")]
    assert rows(merge.insert_ignore(tgt, src, ["k"]), "k", "v") == [
        (None, "s1"), (None, "t1"), (None, "t2"), (1, "a"), (2, "B")]
    assert rows(merge.update_only(tgt, src, "k", {"v": "v"}, update_date_col=None), "k", "v") == [
        (None, "t1"), (None, "t2"), (1, "A")]
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    audited = merge.upsert(merge.with_audit_columns(tgt, t0), src, ["k"], ["v"], load_ts=t1, audit=True)
    assert rows(audited.where("k is null"), "v", "creation_date") == [("s1", t1), ("t1", t0), ("t2", t0)]


def test_resolve_batches_last_batch_wins_and_in_batch_duplicates_fail(spark):
    src = spark.createDataFrame([(1, "k1", "a"), (2, "k2", "b"), (3, "k1", "c"), (4, "k3", "d")],
                                "seq int, k string, v string")
    out = merge.resolve_batches(src, ["k"], [F.col("seq").asc()], batch_size=2)
    assert rows(out, "k", "v") == [("k1", "c"), ("k2", "b"), ("k3", "d")]
    bad = merge.resolve_batches(src, ["k"], [F.col("seq").asc()], batch_size=4)
    with pytest.raises(Exception, match="duplicate conflict key"):
        bad.collect()
    # NULL keys never conflict (UNIQUE treats NULLs as distinct): all kept, no failure,
    # and they still count towards the batch boundaries
    nul = spark.createDataFrame([(1, None, "n1"), (2, None, "n2"), (3, "k1", "a"), (4, "k1", "b")],
                                "seq int, k string, v string")
    assert rows(merge.resolve_batches(nul, ["k"], [F.col("seq").asc()], batch_size=3), "k", "v") == [
        (None, "n1"), (None, "n2"), ("k1", "b")]
    with pytest.raises(Exception, match="duplicate conflict key"):
        merge.resolve_batches(nul, ["k"], [F.col("seq").asc()], batch_size=4).collect()
