"""Versions published at once, bucket-pruned merges, batches with a commit each, the key registry."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import merge, versions
from ledgerlake.sources import fs

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_version_is_seen_whole_or_not_at_all(spark, tmp_dir):
    log = versions.VersionLog(spark, tmp_dir)
    assert log.version() == 0 and log.read() == {"tables": {}, "notes": {}}
    assert log.commit(0, {"t": log.write("t", spark.range(3)), "u": log.write("u", spark.range(1))}) == 1
    entry = log.write("t", spark.range(5))              # written, not published
    assert log.table("t").count() == 3
    assert log.commit(1, {"t": entry}) == 2
    assert log.table("t").count() == 5 and log.table("u").count() == 1 and log.table("t", 1).count() == 3
    with pytest.raises(versions.VersionConflict):
        log.commit(1, {"t": entry})
    # a version file cut short was never published
    with open(os.path.join(tmp_dir, "_log", f"{3:012d}.json"), "w") as f:
        f.write('{"tables": {')
    assert log.version() == 2 and log.table("t").count() == 5
    assert log.commit(2, {}) == 4
    with pytest.raises(ValueError, match="never published"):
        log.read(3)


def test_two_writers_of_one_version(spark, tmp_dir, monkeypatch):
    log = versions.VersionLog(spark, tmp_dir)
    log.commit(0, {})
    other = versions.VersionLog(spark, tmp_dir)
    write = fs.write_new
    monkeypatch.setattr(fs, "write_new", lambda s, p, t: write(s, p, "{}") and False)     # another writer is first
    with pytest.raises(versions.VersionConflict):
        log.commit(1, {})
    assert other._entries() == [1, 2]


def test_vacuum_keeps_what_is_named(spark, tmp_dir):
    log = versions.VersionLog(spark, tmp_dir)
    for i in range(4):
        log.commit(log.version(), {"t": log.write("t", spark.range(i + 1))})
    log.write("t", spark.range(9))                      # a job that died
    assert len(fs.names(spark, tmp_dir + "/data")) == 5
    assert log.vacuum(keep=2) == []                     # all are young
    assert len(log.vacuum(keep=2, older_than=0)) == 1 + 2
    assert log.table("t").count() == 4 and log.table("t", 3).count() == 3


def test_merge_touches_only_the_increments_buckets(spark, tmp_dir):
    log = versions.VersionLog(spark, tmp_dir)
    table = versions.BucketedTable(log, "t", SCHEMA, ["k"], 64)
    data = [(i, f"a{i}", i) for i in range(2000)]
    assert len(table.merge(rows(spark, data))) == 64
    before = log.read()["tables"]["t"]["buckets"]
    # keys of two buckets
    at = {r.k: r.b for r in rows(spark, data).select("k", table.bucket_of().alias("b")).collect()}
    pair = sorted({at[5], next(b for b in at.values() if b != at[5])})
    increment = [(k, "new", -1) for k, b in at.items() if b in pair]
    assert table.merge(rows(spark, increment)) == pair
    after = log.read()["tables"]["t"]["buckets"]
    assert sorted(int(b) for b in after if after[b] != before[b]) == pair
    folder = after[str(pair[0])]
    assert fs.names(spark, log.path(folder)) == ["_SUCCESS"] + sorted(f"{versions.BUCKET}={b}" for b in pair)
    # the merge reads the same two buckets
    files = {r[0].split("/")[-2] for r in table.read(pair).select(F.input_file_name()).distinct().collect()}
    assert files == {f"{versions.BUCKET}={b}" for b in pair}
    changed = {k for k, _, _ in increment}
    assert content(table.read()) == sorted(((k, "new", -1) if k in changed else (k, a, b) for k, a, b in data), key=str)
    assert content(table.read(version=1)) == sorted(data, key=str)
    with pytest.raises(ValueError, match="64 buckets"):
        versions.BucketedTable(log, "t", SCHEMA, ["k"], 8).read()


def test_merge_into_buckets_equals_the_whole_merge(spark, tmp_dir):
    table = versions.BucketedTable(versions.VersionLog(spark, tmp_dir), "t", SCHEMA, ["k", "a"], 7)
    first = [(i % 50, f"x{i // 50}", i) for i in range(150)] + [(None, "x", 1), (1, None, 2)]
    second = [(i % 60, "x1", 1000 + i) for i in range(60)] + [(None, "x", 3)]
    table.merge(rows(spark, first))
    table.merge(rows(spark, second), ["b"])
    want = merge.upsert(rows(spark, first), rows(spark, second), ["k", "a"], ["b"])
    assert content(table.read()) == content(want)
    assert table.merge(rows(spark, [])) == [] and table.log.version() == 2


KINDS = "k long, i int, s string, d date, n timestamp_ntz, t timestamp, c decimal(20,4)"


def test_marks_of_every_type_follow_the_table(spark, tmp_dir):
    """Raised, lowered and removed highest values, after merges of all and of some buckets."""
    kinds = T.StructType.fromDDL(KINDS)
    marks = [versions.Mark(c) for c in kinds.names] + [versions.Mark("n", "s", "x1")]
    table = versions.BucketedTable(versions.VersionLog(spark, tmp_dir), "t", kinds, ["k"], 16, marks)
    assert table.mark(marks[0]) is None

    def rows_of(ids, shift):
        v = F.when(F.col("id") % 7 != 3, F.col("id") * 3 - shift).cast("int")
        at = F.expr("timestamp_ntz'2023-03-26 01:59:59.5'") + F.make_dt_interval(hours=v)
        return spark.createDataFrame([(i,) for i in ids], "id long").select(
            F.col("id").alias("k"), v.alias("i"), F.when(v.isNotNull(), F.concat(F.lit("x"), (F.col("id") % 3).cast("string"))).alias("s"),
            F.date_add(F.lit("2023-12-30").cast("date"), v).alias("d"), at.alias("n"), at.cast("timestamp").alias("t"),
            (v.cast("decimal(20,4)") / 7).cast("decimal(20,4)").alias("c"))

    for ids, shift in ((range(100), 0), ([99], 500), (range(90, 99), 1000), ([200], 0), ([200], 900)):
        table.merge(rows_of(ids, shift))
        for m in marks:
            want = table.read().agg(m.expression().alias("m"))
            got = spark.range(1).select(table.mark(m).alias("m"))
            assert got.schema["m"].dataType == want.schema["m"].dataType and got.collect() == want.collect(), m
    zone = spark.conf.get("spark.sql.session.timeZone")
    want = table.read().agg(F.unix_micros(F.max("t"))).first()[0]
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
        assert spark.range(1).select(F.unix_micros(table.mark(versions.Mark("t")))).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_marks_of_nothing_and_refused_ones(spark, tmp_dir):
    log = versions.VersionLog(spark, tmp_dir)
    table = versions.BucketedTable(log, "t", SCHEMA, ["k"], 4, [versions.Mark("b")])
    table.merge(rows(spark, [(1, "a", None)]))
    assert table.mark(versions.Mark("b")) is None           # only NULLs
    table.merge(rows(spark, []), notes={"x": 1})            # no rows: the marks stay
    assert table.mark(versions.Mark("b")) is None
    with pytest.raises(KeyError, match="keeps no mark"):
        table.mark(versions.Mark("a"))
    with pytest.raises(ValueError, match="without the marks"):
        versions.BucketedTable(log, "t", SCHEMA, ["k"], 4, [versions.Mark("a")]).merge(rows(spark, [(2, "b", 1)]))
    with pytest.raises(TypeError, match="no marks"):
        versions.BucketedTable(log, "u", T.StructType([T.StructField("x", T.DoubleType())]), ["x"], 4, [versions.Mark("x")])


def test_stored_load_reads_nothing_of_the_target_before_the_extract(spark, tmp_dir, monkeypatch):
    from ledgerlake.plans import bronze, standins
    from ledgerlake.plans.tables import Tables
    from tests.conftest import SMALL_SF
    spec = bronze.LOAD_SPECS["fenix_facturas"]
    ext = standins.bronze_invoices(Tables(spark, SMALL_SF))
    schema = merge.with_audit_columns(ext).schema
    table = bronze.stored_table(versions.VersionLog(spark, tmp_dir), spec, schema, 8)
    early = ext.where(F.col("fecha_hora") < F.lit("1998-01-01").cast("timestamp_ntz"))
    bronze.incremental_table_load(table, early, spec)
    steps = []
    merge_rows, read = versions.BucketedTable.merge, versions.BucketedTable.read

    def note_merge(self, source, *a, **k):
        steps.append(("merge", source.count()))
        return merge_rows(self, source, *a, **k)
    monkeypatch.setattr(versions.BucketedTable, "merge", note_merge)
    monkeypatch.setattr(versions.BucketedTable, "read", lambda self, *a, **k: steps.append(("read", a[0] if a else None)) or read(self, *a, **k))
    touched = bronze.incremental_table_load(table, ext, spec)
    later = ext.count() - early.count()
    assert steps == [("merge", later), ("read", touched)]
    plan = bronze.after_mark(ext, "fecha_hora", table.mark(table.marks[0]))._jdf.queryExecution().optimizedPlan().toString()
    assert "ScalarSubquery" not in plan and "subquery" not in plan
    # the same rows as the load that aggregates the target
    want = bronze.incremental_load(bronze.incremental_load(merge.with_audit_columns(ext.where("false")), early, spec), ext, spec)
    assert content(table.read().select(*ext.columns)) == content(want.select(*ext.columns))


def test_stored_requests_load_equals_the_lazy_one(spark, tmp_dir):
    """Each status past its own mark; a request that changes its status takes the old mark with it."""
    from ledgerlake.plans import bronze
    cols = ("id_tramite int, origen string, factura string, serial_firma string, cedula string, fecha_aprobacion string, ruc string, "
            "tipo_firma string, fecha_inicio_tramite string, ruc_aux string, medio string, sf_control string, producto string, "
            "estado string, fecha_factura string")

    def extract(*data):
        made = [(i, f"f{i}", f"s{i}", status, f"{day} 08:30:00") for i, status, day in data]
        df = spark.createDataFrame(made, "id_tramite int, factura string, serial_firma string, estado string, fecha_factura string")
        return df.select(*[df[f.name] if f.name in df.columns else F.lit(None).cast("string").alias(f.name)
                           for f in T.StructType.fromDDL(cols).fields if f.name != "origen"])

    runs = [{"APROBADO": extract((1, "APROBADO", "2024-01-05"), (2, "APROBADO", "2024-01-09")),
             "NO APROBADO": extract((3, "NO APROBADO", "2024-01-20"))},
            {"APROBADO": extract((4, "APROBADO", "2024-01-07"), (5, "APROBADO", "2024-01-10")),
             "NO APROBADO": extract((2, "NO APROBADO", "2024-01-21"), (6, "NO APROBADO", "2024-01-12"))},
            {"APROBADO": extract((4, "APROBADO", "2024-01-10"), (7, "APROBADO", "2024-01-11")),
             "NO APROBADO": extract()}]
    spec = bronze.LOAD_SPECS["camunda_operatividad"]
    first = bronze.integrate_requests([bronze.clean_request_source(d, "CAMUNDA", i) for i, d in enumerate(runs[0].values())])
    empty = merge.with_audit_columns(first.where("false"))
    table = bronze.stored_table(versions.VersionLog(spark, tmp_dir), spec, empty.schema, 8)
    lazy, names = empty, [c for c in empty.columns if c not in (merge.CREATION_COL, merge.UPDATE_COL)]
    for run in runs:
        bronze.incremental_requests_into(table, run)
        lazy = bronze.incremental_requests(lazy, run)
        assert content(table.read().select(*names)) == content(lazy.select(*names))
        marks = bronze.requests_watermarks(lazy)
        for m in table.marks:
            assert spark.range(1).select(table.mark(m)).first()[0] == marks[m.value]


@pytest.mark.parametrize("size, kept, failed", [(1, None, None), (7, 14, 3), (1000, 0, 1)])
def test_batches_before_a_refused_one_stay(spark, tmp_dir, size, kept, failed):
    data = [(i, "first", i) for i in range(40)]
    data[18] = (17, "again", 18)                        # batch 3 of seven rows holds 17 twice
    table = versions.BucketedTable(versions.VersionLog(spark, tmp_dir), "t", SCHEMA, ["k"], 4)
    table.merge(rows(spark, [(3, "old", 0), (30, "old", 0)]))
    load = lambda d: versions.load_in_batches(table, rows(spark, d).repartition(3), [F.col("b").asc()], "run", batch_size=size)
    if failed is None:
        assert load(data) == 40
        assert dict((k, a) for k, a, _ in content(table.read()))[17] == "again"
        return
    with pytest.raises(versions.BatchFailed, match=f"batch {failed}"):
        load(data)
    got = {k: a for k, a, _ in content(table.read())}
    assert got == {3: "old", 30: "old"} | {i: "first" for i in range(kept)}
    note = versions.ledger(table.log).first()
    assert (note.committed, note.rows, note.failed_batch, note.batches) == (failed - 1, kept, failed, -(-40 // size))
    # mended and run again: only the rest is loaded
    data[18] = (18, "first", 18)
    assert load(data) == 40 - kept
    assert {k: a for k, a, _ in content(table.read())} == {i: "first" for i in range(40)}
    note = versions.ledger(table.log).first()
    assert (note.committed, note.rows, note.failed_batch) == (-(-40 // size), 40, None)
    assert load(data) == 0
    with pytest.raises(ValueError, match="batches of"):
        versions.load_in_batches(table, rows(spark, data), [F.col("b").asc()], "run", batch_size=size + 1)


def test_batches_edges(spark, tmp_dir):
    table = versions.BucketedTable(versions.VersionLog(spark, tmp_dir), "t", SCHEMA, ["k"], 4)
    assert versions.load_in_batches(table, rows(spark, []), [F.col("b").asc()], "none") == 0 and table.log.version() == 0
    # NULL keys never conflict, later batches win, one key may hold a third of the rows
    data = [(None, "n", i) for i in range(5)] + [(0 if i % 3 == 0 else i, "x", i) for i in range(5, 300)]
    versions.load_in_batches(table, rows(spark, data), [F.col("b").asc()], "hot", batch_size=3)
    got = content(table.read())
    assert sum(k is None for k, _, _ in got) == 5 and [b for k, _, b in got if k == 0] == [297]
    assert len(got) == 5 + len({k for k, _, _ in data if k is not None})


def test_resolve_batches_of_several_rows(spark):
    data = [(i % 10, "x", i) for i in range(100)]
    for size in (1, 7, 10):
        got = merge.resolve_batches(rows(spark, data), ["k"], [F.col("b").asc()], size)
        assert content(got) == sorted(((k, "x", 90 + k) for k in range(10)), key=str)
    with pytest.raises(Exception, match="duplicate conflict key"):
        merge.resolve_batches(rows(spark, data), ["k"], [F.col("b").asc()], 11).collect()


def test_registry_never_reuses_an_id(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(versions.KeyRegistry, "MOST_FOLDERS", 3)
    reg = versions.KeyRegistry(versions.VersionLog(spark, tmp_dir), "d", ["k"], "id")
    assert reg.read() is None
    given = {}
    for names in ("ABC", "ABD", "ABCD", "E", "", "AZ"):
        df = spark.createDataFrame([(n,) for n in names], "k string")
        for r in reg.register(df).collect():
            assert given.setdefault(r.k, r.id) == r.id
    assert given == {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "Z": 6}
    assert len(reg._folders(reg.log.version())) <= 4


def test_one_row_batches_need_no_numbers(spark):
    """Order names with batches of one row: the greatest row of a key, as by numbered batches."""
    data = [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), (None, 1, "n"), (None, 1, "n"), ("b", None, None), ("b", 2, "w")]
    src = spark.createDataFrame(data, "k string, seq int, v string")
    by_name = merge.resolve_batches(src, ["k"], ["seq", "v"], 1)
    numbered = merge.resolve_batches(src, ["k"], [F.col("seq").asc(), F.col("v").asc()], 1)
    key = lambda r: str(tuple(r))
    assert sorted(by_name.collect(), key=key) == sorted(numbered.collect(), key=key)
    assert sorted(map(tuple, by_name.where("k is not null").collect())) == [("a", 3, "y"), ("b", 2, "w")]
    assert "Window" not in by_name._jdf.queryExecution().executedPlan().toString()
    assert merge.resolve_batches(src.limit(0), ["k"], ["seq"], 1).count() == 0
