"""SimHash groups, benchmark windows and repeated substrings against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from ledgerlake.llm import decontaminate, queries, simhash, substring_dedup

from .conftest import EDGE, SF


# ------------------------------------------------------------------ SimHash

def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, bits=2):
    """fingerprint -> smallest fingerprint reachable."""
    root = {p: p for p in prints}
    order = sorted(root)
    changed = True
    while changed:
        changed = False
        for a in order:
            for b in order:
                if root[b] < root[a] and (a ^ b).bit_count() <= bits:
                    root[a] = root[b]
                    changed = True
    return root


def test_fingerprints(small_texts):
    for text in [t for _, t in small_texts[:60]] + [t for _, t in EDGE if t is None or len(t) < 1000]:
        assert simhash.fingerprint((text or "").encode(), 3) == plain_fingerprint(text)


@pytest.mark.parametrize(("cap", "bits"), [(64, 2), (2, 2), (64, 1), (2, 1)])
def test_links_connect_what_brute_force_connects(spark, cap, bits):
    # clusters around a few values, so segment values are shared by many fingerprints
    rng = np.random.default_rng(5)
    prints = set()
    for centre in rng.integers(0, 1 << 63, 12).tolist():
        for _ in range(25):
            p = centre
            for b in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                p ^= 1 << b
            prints.add(p)
    prints |= {0, 1, 3, 7, (1 << 64) - 1, (1 << 63)}
    signed = {int(np.uint64(p).astype(np.int64)): p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed] * 2, "fp long")
    got = {(signed[r.a], signed[r.b]) for r in simhash.links(df, bits, cap).collect()}
    assert all((a ^ b).bit_count() <= bits for a, b in got)
    want, root = groups(prints, bits), {p: p for p in prints}
    while True:
        low = dict(root)
        for a, b in got:
            low[a] = low[b] = min(low[a], low[b], root[a], root[b])
        if low == root:
            break
        root = low
    assert root == want


def test_near_duplicates_and_keep_one(spark, edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == len(EDGE)
    part = {}
    for r in rows:
        part.setdefault(r.doc_id, r.component_id)
    assert part[5] == part[1] == 1 and part[2] == part[3] == part[4] == 2
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert [i for gone, i in ids if not gone] == [1, 2, 6, 7, 8, 9] and ids[-1][0]
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0
    twice = spark.createDataFrame([(5, "one two three four"), (5, "one two three four")], "doc_id long, text string")
    assert simhash.keep_one(twice).count() == 1


def test_simhash_query(spark, small_texts):
    prints = {i: plain_fingerprint(t) for i, t in small_texts}
    root = groups(set(prints.values()))
    first = {}
    for i, p in prints.items():
        first[root[p]] = min(i, first.get(root[p], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7(spark, SF).collect()}
    assert got == {i: (f"{p:016x}", first[root[p]]) for i, p in prints.items()}


# ------------------------------------------------------------------ benchmark windows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_hits(text, items, window):
    w, hit, seen = words(text), set(), set()
    for item, raw in items:
        x = words(raw)
        for i in range(max(1, len(x) - window + 1) if x else 0):
            part = x[i:i + window]
            for p in range(len(w) - len(part) + 1):
                if w[p:p + len(part)] == part:
                    hit |= set(range(p, p + len(part)))
                    seen.add(item)
    return len(w), len(hit), sorted(seen)


@pytest.mark.parametrize("index_bytes", [1 << 20, 60])
def test_windows(spark, index_bytes):
    items = [("7", "Alpha beta gamma delta alpha beta gamma"), ("12", "one"), ("a", "two three"), ("b", "..."), ("c", None),
             ("7", "beta gamma delta"), ("d", "x x x x x x x x"), ("e", "Ünï-code über"), (None, "lost item words here")]
    docs = ["", None, "alpha BETA gamma delta alpha", "one, two three! one", "x " * 30, "x x x", "beta gamma delta epsilon",
            "ünï code über ÜNÏ", "zzz", "two\x00three", "lost item words here", "gamma delta alpha beta gamma delta alpha"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.mark_contaminated(
        df, bench, window=4, index_bytes=index_bytes).collect()}
    named = [("" if i is None else i, t) for i, t in items]
    assert got == {i: plain_hits(t, named, 4) for i, t in enumerate(docs)}


def test_window_edges(spark, edge_docs, no_docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    marked = decontaminate.mark_contaminated(edge_docs, bench)
    assert marked.count() == len(EDGE) and marked.columns.count("contaminated") == 1
    assert decontaminate.drop_contaminated(edge_docs, bench).columns == edge_docs.columns
    assert decontaminate.mark_contaminated(edge_docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.mark_contaminated(no_docs, bench).count() == 0


# ------------------------------------------------------------------ repeated substrings

def plain_cut(texts, n=substring_dedup.LENGTH):
    seen = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        mark = np.zeros(len(t) + 1, int)
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                mark[i] += 1
                mark[i + n] -= 1
        gone = np.cumsum(mark)[:len(t)] > 0
        rest = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def corpus():
    rng = np.random.default_rng(8)
    noise = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    p, q = noise(400), noise(199)
    near = bytearray(noise(900))
    docs = [noise(300) + p + noise(50), p + noise(10) + p, noise(100) + p[50:260] + noise(100), q + b"A", q + b"B", q,
            b"ab" * 300, b"z" * 205, b"z" * 199, b"", noise(250), noise(900), "é".encode() * 150]
    for _ in range(30):                              # near copies: edits at different places
        near[int(rng.integers(0, 900))] = 65
        docs.append(bytes(near))
    docs += [docs[10]] * 3                           # exact copies
    docs += [noise(int(rng.integers(0, 120))) + p[:220] + noise(20) for _ in range(20)]
    return [d.decode() for d in docs]


@pytest.mark.parametrize("cap, memo", [(4096, 1 << 18), (3, 1 << 18), (4096, 2), (3, 2)])
def test_removed_bytes(spark, cap, memo):
    texts = corpus()
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_removed int").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256)
           for r in substring_dedup.repeated_substrings(df, group_cap=cap, memo_rows=memo).collect()}
    assert got == dict(enumerate(plain_cut([t.encode() for t in texts])))


@pytest.mark.parametrize("chunk", [1, 5, 40])
def test_tables_of_whole_groups(monkeypatch, chunk):
    monkeypatch.setattr(substring_dedup, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(chunk)
    g = np.sort(np.concatenate([rng.integers(0, 20, 60), np.full(50, 7)]))
    kind = (g > 9).astype(np.int8)
    rows = pa.record_batch({"kind": kind, "g": g, "n": np.arange(g.size)})
    batches = [rows.slice(a, 4) for a in range(0, g.size, 4)] + [rows.slice(0, 0)]
    tables = list(substring_dedup._whole_groups(batches, ["kind", "g"]))
    assert np.concatenate([t["n"].to_numpy() for t in tables]).tolist() == list(range(g.size))
    for one, two in zip(tables, tables[1:], strict=False):
        assert one.num_rows >= chunk and one["g"][-1].as_py() < two["g"][0].as_py()
    assert list(substring_dedup._whole_groups([], ["g"])) == []


def test_long_texts_are_cut_into_segments():
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 100, 3 * substring_dedup.SEGMENT + 77).astype(np.uint8))
    (_, at, h), = substring_dedup.anchors([text])
    # every string of full length holds an anchor, also across segment borders
    assert np.diff(at).max() <= substring_dedup.LENGTH - substring_dedup.KGRAM + 1
    cut = substring_dedup.SEGMENT - substring_dedup.LENGTH
    again = list(substring_dedup.anchors([text[cut - 500:cut + 500]]))[0]
    inside = (again[1] > 200) & (again[1] < 768)
    assert set((again[1][inside] + cut - 500).tolist()) <= set(at.tolist())


def test_trie_and_deep_shallow_order():
    rng = np.random.default_rng(6)
    base = bytes(rng.integers(97, 99, 120).astype(np.uint8))
    strings = [base[:int(rng.integers(0, 120))] + bytes(rng.integers(97, 99, int(rng.integers(0, 30))).astype(np.uint8))
               for _ in range(300)]
    order, common = substring_dedup.trie_order(strings)
    want = sorted(strings)
    assert [strings[i] for i in order] == want
    assert common[1:] == [substring_dedup._lcp(a, b) for a, b in zip(want, want[1:], strict=False)]
    group = np.sort(rng.integers(0, 9, 300))
    order, common = substring_dedup.deep_shallow(strings, group, 200)
    assert (group[order] == group).all()
    for g in range(9):
        rows = [strings[i] for i in order[group == g]]
        assert rows == sorted(rows)


def test_removed_bytes_edge_rows(spark, edge_docs, no_docs):
    rows = substring_dedup.repeated_substrings(edge_docs).collect()
    assert len(rows) == len(EDGE)
    want = Counter(zip([i for i, _ in EDGE], plain_cut([(t or "").encode() for _, t in EDGE]), strict=True))
    assert Counter((r.doc_id, (r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256)) for r in rows) == want
    assert substring_dedup.repeated_substrings(no_docs).count() == 0


def test_copies_of_a_text_leave_a_task_once(spark):
    none = spark.sparkContext.broadcast(np.zeros(1 << substring_dedup.FILTER_BITS - 3, np.uint8))
    copies = spark.range(400, numPartitions=4).selectExpr("repeat('one text of many copies. ', 20) AS t")
    sent = copies.mapInArrow(substring_dedup._send(none, none), substring_dedup.SENT).collect()
    assert len(sent) == 4 and {(r.kind, r.pos, r.l) for r in sent} == {(substring_dedup.SETTLED, 0, 500)}
    assert len({r.g for r in sent}) == 4


def test_removed_bytes_query(spark, small_texts):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op5(spark, SF).collect()}
    want = plain_cut([t.encode() for _, t in small_texts])
    assert got == {i: w for (i, _), w in zip(small_texts, want, strict=True)}
