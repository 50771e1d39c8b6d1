"""Near-duplicate vectors against brute force; quality votes on held-out labels."""

import zlib

import numpy as np
import pytest

from ledgerlake.llm import pq_neardup, quality_knn, queries
from ledgerlake.llm.common import connected_components

from .conftest import EDGE, SF


def brute(ids, vectors, least):
    v = np.array(vectors, float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links = v @ v.T >= least
    np.fill_diagonal(links, False)
    root = list(range(len(ids)))
    changed = True
    while changed:
        low = [min([root[i], *[root[j] for j in np.flatnonzero(links[i])]]) for i in range(len(ids))]
        changed, root = low != root, low
    first = {r: min(ids[i] for i in range(len(ids)) if root[i] == r) for r in set(root)}
    return {i: (int(links[k].sum()), first[root[k]]) for k, i in enumerate(ids)}


@pytest.mark.parametrize("blocks", [(1024, 2048), (16, 32)])
def test_links_and_components(spark, monkeypatch, blocks):
    # clusters of near copies, one of a third of the rows, chains, exact copies; small blocks split lists
    monkeypatch.setattr(pq_neardup, "ENTRY_BLOCK", blocks[0])
    monkeypatch.setattr(pq_neardup, "QUERY_BLOCK", blocks[1])
    monkeypatch.setattr(pq_neardup, "LIST_ROWS", 40)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((150, 32))
    of = np.concatenate([np.zeros(200, int), rng.integers(0, 150, 400)])
    x = centres[of] + rng.standard_normal((600, 32)) * rng.choice([0.0, 0.05, 0.2, 0.35], 600)[:, None]
    x = x.astype(np.float32)
    ids = rng.permutation(600).tolist()
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, x, strict=True)],
                               "vec_id long, embedding array<float>, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq_neardup.near_duplicates(df).collect()}
    want = brute(ids, x, 0.95)
    assert got == want


@pytest.mark.parametrize("entry_block", [64, 4096])
def test_no_link_is_lost_where_few_dimensions_vary(spark, monkeypatch, entry_block):
    monkeypatch.setattr(pq_neardup, "LIST_ROWS", 20)
    monkeypatch.setattr(pq_neardup, "ENTRY_BLOCK", entry_block)
    rng = np.random.default_rng(7)
    x = np.zeros((800, 64))
    x[:, :3] = rng.standard_normal((800, 3))
    x = (x @ np.linalg.qr(rng.standard_normal((64, 64)))[0]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq_neardup.near_duplicates(df).collect()}
    assert got == brute(list(range(800)), x, 0.95)


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op3(spark, "/root/testdata/sf0.01").collect()}
    assert got == brute([r.vec_id for r in rows], [r.embedding for r in rows], 0.95)


def test_vectors_without_direction(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (10, [-0.0, 3.0]), (11, [0.0, 3.0]), (None, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pq_neardup.near_duplicates(df).collect()}
    assert got[1] == (1, 1, True) and got[2] == (1, 1, False)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9))
    assert got[10] == (2, 10, True) and got[11] == (2, 10, False) and got[None] == (2, 10, False)
    assert pq_neardup.near_duplicates(df.limit(0)).count() == 0


def test_components_of_chains_stars_and_nothing(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7), (5000, 4999), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(n + 1)) and all(got[1000 + i] == 1000 for i in range(200))
    assert got[5000] == got[4999] == 4999
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op10(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good = [p for y, p in held if y == 1]
    bad = [p for y, p in held if y == 0]
    assert sum(good) >= 0.97 * len(good) and (not bad or sum(bad) <= 0.3 * len(bad))


def test_scores_are_exact_votes():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 4, (40, 64)).astype(np.float32)
    model = quality_knn.fit(counts, rng.integers(0, 2, 40).astype(float), dims=8, k=5)
    z = model.project(counts)
    cos = z @ model.vectors.T
    for i, s in enumerate(model.scores(counts)):
        near = np.argsort(-cos[i])[:5]
        w = np.maximum(cos[i][near], 0).astype(float)
        assert abs(s - (w * model.labels[near]).sum() / w.sum()) < 1e-6


def test_shapes_are_of_whole_words():
    terms = quality_knn.Terms(quality_knn.BUCKETS)
    for word, shape in (("a" * 60 + "7", b"a0"), ("xY" * 30, b"aA" * 30), ("9" * 5000 + "-b", b"0-a")):
        assert terms.counts([word])[0, zlib.crc32(b"shape " + shape) % terms.words] >= 1


def test_quality_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, 0), (6, 0), (None, 1), (9, None)], "doc_id long, quality int")
    model = quality_knn.train(edge_docs, labels)
    assert len(model.labels) == 3
    rows = quality_knn.score(edge_docs, model).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (2, 3, 4)} == {model.prior}
    none = quality_knn.train(no_docs, labels.limit(0))
    assert quality_knn.score(no_docs, none).count() == 0
    assert {r.score for r in quality_knn.score(edge_docs, none).collect()} == {0.5}


def test_query_reads_labels_of_the_training_part_only(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    used = [r.doc_id for r in quality_knn.training_rows(labels).collect()]
    assert used and all(zlib.crc32(str(i).encode()) % 5 for i in used)


def brute_votes(model, counts):
    """Votes one document at a time, neighbours fully sorted."""
    out = []
    for row in counts:
        unit = lambda v: v / max(np.linalg.norm(v), 1e-9)
        mine = unit(model.project(row[None])[0])
        cos = np.rint([mine @ unit(v) * 10**6 for v in model.vectors]).astype(int)
        near = sorted(range(len(cos)), key=lambda i: (-cos[i], i))[:model.k]
        weight = [max(int(cos[i]), 0) for i in near]
        out.append(sum(w * model.labels[i] for w, i in zip(weight, near, strict=True)) / sum(weight) if sum(weight) else model.prior)
    return np.array(out)


def votes_data(n=300):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 60))) for _ in range(n)]
    texts += [texts[0]] * 60 + ["the same few words"] * 60 + ["", "word"]
    return quality_knn.Terms(quality_knn.BUCKETS).counts(texts), rng


def test_ties_fall_to_the_earlier_label():
    counts, rng = votes_data()
    labels = rng.random(len(counts)).round()
    model = quality_knn.fit(counts, labels)
    got = model.scores(counts)
    assert np.allclose(got, brute_votes(model, counts), atol=1e-4)
    # 60 equal vectors: the first of them vote
    same = range(360, 420)
    first = [labels[i] for i in same][:model.k]
    assert np.allclose(got[360:420], np.mean(first), atol=1e-6)


def test_scores_do_not_depend_on_the_batch():
    counts, rng = votes_data()
    model = quality_knn.fit(counts, rng.random(len(counts)).round())
    whole = model.scores(counts)
    for cut in (1, 7, 512):
        parts = np.concatenate([model.scores(counts[i:i + cut]) for i in range(0, len(counts), cut)])
        assert (parts == whole).all()
    order = rng.permutation(len(counts))
    assert (model.scores(counts[order]) == whole[order]).all()


def test_query_equals_brute_force_votes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_knn.train(docs, quality_knn.training_rows(spark.read.parquet(f"{SF}/labels.parquet")))
    rows = docs.orderBy("doc_id").collect()
    want = brute_votes(model, quality_knn.Terms(quality_knn.BUCKETS).counts([r.text or "" for r in rows]))
    got = {r.doc_id: r for r in queries.op10(spark, SF).collect()}
    assert all(abs(got[r.doc_id].score - w) < 1e-4 and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3)
               and got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r, w in zip(rows, want, strict=True))


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(quality_knn, "MEMO_CHARS", 100)
    t = quality_knn.Terms(64)
    texts = [f"{'x' * i} y{i}" for i in range(50)]
    assert (np.concatenate([t.counts([x]) for x in texts]) == quality_knn.Terms(64).counts(texts)).all()
    assert len(t.memo) < 50


def test_vectors_of_any_magnitude(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((20, 16))
    scale = [1.0, 1e200, 1e-170, 1e-300, 1e307]
    rows = [(100 * i + j, (x * s / 4).tolist()) for i, x in enumerate(base) for j, s in enumerate(scale)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq_neardup.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {100 * i + j: (4, 100 * i) for i in range(20) for j in range(5)}
