"""Shards, the archive audit, the pipeline, and the registered oracles."""

import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import byte_bpe, decontaminate, pii_crf, quality_knn, queries, sharding, simhash, warc_merkle

from .conftest import EDGE, SF


@pytest.mark.parametrize("parts", [1, 5])
def test_shards_follow_the_mixture(spark, parts):
    rows = [(i, ("hot" if i % 3 == 0 else None if i % 7 == 0 else f"s{i % 11}"), i % 5) for i in range(2003)]
    df = spark.createDataFrame(rows, "doc_id long, source string, slot int")
    got = sharding.interleave(df, shards=8, num_partitions=parts).collect()
    assert len(got) == 2003 and len({r.doc_id for r in got}) == 2003
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    for source, n in Counter(r.source for r in got).items():
        for s in range(8):
            own = sum(r.shard == s and r.source == source for r in got)
            assert abs(own - n * sizes[s] / 2003) <= 2
    # the order is seeded, not the id order
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))] != sorted(r.doc_id for r in got)


def test_shards_do_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source")
    one, many = (sharding.interleave(df, num_partitions=n).select("doc_id", "shard", "slot") for n in (1, 6))
    assert one.exceptAll(many).count() == 0


def test_shards_edge_rows(spark, edge_docs, no_docs):
    got = sharding.interleave(edge_docs).collect()
    assert len(got) == len(EDGE) and sum(r.doc_id == 5 for r in got) == 2
    assert sharding.interleave(no_docs).count() == 0
    assert sharding.interleave(edge_docs.limit(3)).count() == 3


def test_shard_query(spark, small_texts):
    want = {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in small_texts}
    got = queries.op6(spark, SF).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def manifest(spark, rows):
    return spark.createDataFrame(rows, "volume long, offset long, length long, sha string")


def test_audit_finds_every_difference(spark):
    rng = np.random.default_rng(1)
    mine, volumes = [], 40
    for v in range(volumes):
        at = 0
        for k in range(60):
            n = int(rng.integers(100, 60000))
            mine.append((v, at, n, f"{v}-{k}"))
            at += n
    other, want = [], {}
    for r in mine:
        dice = rng.integers(0, 200)
        if dice == 0:
            want[r[:2]] = "missing"
        elif dice == 1:
            want[r[:2]] = "altered"
            other.append((*r[:3], "rot"))
        elif dice == 2:
            want[r[:2]] = "resized"
            other.append((r[0], r[1], r[2] - 1, r[3]))
        else:
            other.append(r)
    other.append((3, 10 ** 9, 5, "new"))
    want[(3, 10 ** 9)] = "extra"
    got = warc_merkle.audit(manifest(spark, mine), manifest(spark, other), volumes).collect()
    assert {(r.volume, r.offset): r.fault for r in got} == want
    assert all(r.x_root != r.y_root for r in got)
    assert warc_merkle.audit(manifest(spark, mine), manifest(spark, mine), volumes).count() == 0


def test_tree_goes_down_only_where_roots_differ(spark):
    mine = [(v, k * 40000, 40000, f"{v}.{k}") for v in range(20) for k in range(30)]
    other = [(v, o, n, "x" if (v, o) == (7, 400000) else s) for v, o, n, s in mine]
    a, b = (warc_merkle.tree(manifest(spark, rows), 20) for rows in (mine, other))
    assert a[-1].count() == 1
    assert [tuple(r) for r in warc_merkle.differing(a, b).collect()] == [(7, 400000 // (1 << 16))]


def test_audit_edge_pages(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (2, None, None), (None, None, None), (3, "u", "x" * 200000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("volume", F.lit("clash"))
    assert warc_merkle.records(pages).where("record is null").count() == 0
    assert warc_merkle.audit_pages(pages).count() <= 4
    assert warc_merkle.audit_pages(pages.limit(0)).count() == 0


def brute_pipeline(spark):
    """The stages one by one over plain rows, with each operator's own per-text functions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = quality_knn.training_rows(spark.read.parquet(f"{SF}/labels.parquet"))
    model = quality_knn.train(docs, labels)
    terms = quality_knn.Terms(quality_knn.BUCKETS)
    rows = [r for r in docs.collect() if model.scores(terms.counts([r.text or ""]))[0] >= quality_knn.KEEP_SCORE]
    prints = {r.doc_id: simhash.fingerprint((r.text or "").encode(), 3) for r in rows}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if root[j] < root[i] and (prints[i] ^ prints[j]).bit_count() <= 2:
                    root[i], changed = root[j], True
    rows = [r for r in rows if root[r.doc_id] == r.doc_id]
    bench = {tuple(w[i:i + 10]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()
             for w in [decontaminate.words_of(r.text.encode())] for i in range(max(1, len(w) - 9))}
    sizes = {len(b) for b in bench}

    def clean(text):
        w = decontaminate.words_of(text.encode())
        return not any(tuple(w[i:i + n]) in bench for n in sizes for i in range(len(w) - n + 1))

    rows = [r for r in rows if clean(r.text or "")]
    kept = docs.where(F.col("doc_id").isin([r.doc_id for r in rows]))
    field = pii_crf.train(kept)
    codec = byte_bpe.codec(P.path("byte_bpe_50k.tiktoken"))
    out = {}
    for r in rows:
        base, added = pii_crf.find_spans([r.text or ""], field)
        text = pii_crf.masked(r.text or "", sorted(base[0] + added[0]))
        out[r.doc_id] = (len(text), np.frombuffer(codec.encode([text])[0][0], "<u4").tolist())
    return out


def test_pipeline_equals_brute_force(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: (r.n_chars, list(r.ids)) for r in got} == brute_pipeline(spark)
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_stages_keep_the_columns(spark, no_docs):
    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_stages_on_edge_rows(spark, edge_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, edge_docs, SF).count() <= len(EDGE), name


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"create view {t.split('.')[0]} as select * from '{sf}/{t}'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(c) for c in columns]
    rows = Counter(tuple(r[i] for i in order) for r in want.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, sf).collect()) == rows


def test_contract_columns(spark):
    want = {"op2": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op3": "vec_id n_links component_id kept",
            "op4": "doc_id n_bytes n_tokens over_limit", "op5": "doc_id n_bytes n_removed n_spans kept_sha256",
            "op6": "doc_id size text_crc32 law shard slot grown_shard", "op7": "doc_id fingerprint component_id",
            "op8": "doc_id n_words n_hit n_items items_sha256 contaminated",
            "op9": "doc_id n_tokens ids_sha256 decoded_sha256", "op10": "doc_id held_out score predicted"}
    kinds = {"n_email": "bigint", "base_sha256": "string", "spans": "string", "n_links": "bigint", "kept": "boolean",
             "component_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean",
             "n_removed": "bigint", "n_spans": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string",
             "shard": "int", "slot": "bigint", "grown_shard": "int", "fingerprint": "string", "n_words": "bigint",
             "n_hit": "bigint", "n_items": "bigint", "contaminated": "boolean", "held_out": "boolean", "score": "double",
             "predicted": "int"}
    for name, fn in queries.QUERIES.items():
        key = name.split("_")[0]
        if key in want:
            df = fn(spark, SF)
            assert df.columns == want[key].split(), name
            assert all(kinds.get(c, t) == t for c, t in df.dtypes), (name, df.dtypes)


def test_placement_by_brute_force(spark):
    """The query's shards and slots from ranks, fractions and cuts worked out one by one."""
    text = F.coalesce("text", F.lit(""))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "source", F.crc32(text).alias("crc"), (F.octet_length(text) + 1).cast("long").alias("size"))
    rows = docs.withColumn("mix", F.xxhash64(F.lit(sharding.SEED), "doc_id", "crc", "size")).collect()
    low = -2**63
    rows.sort(key=lambda r: (r.source is not None, r.source or "", r.mix, r.doc_id if r.doc_id is not None else low, r.crc, r.size))
    first, count = {}, Counter(r.source for r in rows)
    for i, r in enumerate(rows):
        first.setdefault(r.source, i)
    tie = {r.f: r.h for r in spark.createDataFrame([(f,) for f in first.values()], "f long")
           .select("f", F.xxhash64(F.lit(sharding.SEED), "f").alias("h")).collect()}
    order = sorted(range(len(rows)), key=lambda i: ((2 * (i - first[rows[i].source]) + 1) / (2 * count[rows[i].source]),
                                                    tie[first[rows[i].source]], first[rows[i].source]))
    n, want, seen = len(rows), {}, Counter()
    for place, i in enumerate(order):
        shard = place * sharding.SHARDS // n
        want[rows[i].doc_id] = (shard, seen[shard])
        seen[shard] += 1
    assert {r.doc_id: (r.shard, r.slot) for r in queries.op6(spark, SF).collect()} == want


def test_ids_of_the_query_are_the_library_s(spark):
    import hashlib

    import tiktoken
    from tiktoken.load import load_tiktoken_bpe
    library = tiktoken.Encoding("given", pat_str=P.PATTERN, mergeable_ranks=load_tiktoken_bpe(P.path("byte_bpe_50k.tiktoken")),
                                special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op9(spark, SF).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
