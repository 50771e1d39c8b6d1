"""Patterns against plain regular expressions; the field's marginals against enumeration."""

import itertools
import random
import re

import numpy as np
import pytest

from ledgerlake.llm import pii_crf, queries

from .conftest import EDGE, SF

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(s):
    return sum((lambda n: n // 10 + n % 10)(int(c) * (1 + i % 2)) for i, c in enumerate(reversed(s))) % 10 == 0


def brute(t):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def test_base_spans_are_the_patterns(small_texts):
    rng = random.Random(3)
    parts = ["a", "B", "@", ".", "-", "+", "1", "23", "255", "256", " ", "(", ")", "_", "%", "@x.y", "1.2.3.4", "0",
             "4111111111111111", "é", "+1 (474) 555-5602", "0001"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(20000)]
    for t in made + [t for _, t in small_texts]:
        assert pii_crf.base_spans(t) == brute(t)


@pytest.fixture(scope="module")
def model(spark):
    return pii_crf.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_long_runs_stay_linear(model):
    hard = ["9" * 300000, "a" * 300000 + "@", "1." * 150000, "@" * 100000, "+1" + " " * 200000, "- " * 100000 + "7"]
    base, added = pii_crf.find_spans(hard, model)
    assert len(base) == len(added) == len(hard)


def test_marginals_on_a_tree_are_exact(model):
    # without a cycle loopy message passing is exact: compare with full enumeration
    g = pii_crf.build("a1 b2 c3 d4", [(3, 0, 5)])
    assert len(g.chain) == 3 and not len(g.skip) and g.observed.tolist() == [-1, 0, -1, -1, 0]
    p = np.zeros((4, pii_crf.LABELS))
    for labels in itertools.product(range(pii_crf.LABELS), repeat=4):
        if labels[1] != 0:
            continue
        w = np.exp(sum(model.unary[g.shape[i], labels[i]] for i in (0, 2, 3)) +
                   sum(model.chain[labels[a], labels[b]] for a, b in g.chain.tolist()))
        for i, k in enumerate(labels):
            p[i, k] += w
    assert np.allclose(model.marginals(g)[:4], p / p.sum(axis=1, keepdims=True), atol=2e-3)


def test_blocks_of_edges_change_nothing(model, monkeypatch):
    text = "+1 (474) 555-5602 " + "x12 at 555-5602, no 7 " * 50
    g = pii_crf.build(text, pii_crf.base_spans(text))
    want = model.marginals(g)
    monkeypatch.setattr(pii_crf, "EDGE_BLOCK", 3)
    assert np.allclose(model.marginals(g), want, atol=1e-6)


@pytest.mark.parametrize("n", [1, 3, 5, 10, 30, 300])
@pytest.mark.parametrize("other", ["4745555602", "474-555-5602", "555-5602", "001474-555-5602"])
def test_distant_repeats_are_found_however_often(model, n, other):
    text = ("call +1 (474) 555-5602 now. " + "".join(f"Words {i} between, {other}, and 20{i % 90 + 10}. " for i in range(n))
            + "Not 5551234567 or 1234 or 474 or 5602.")
    base, added = pii_crf.find_spans([text], model)
    assert [text[s:e] for s, _, e in base[0]] == ["+1 (474) 555-5602"]
    assert [(text[s:e], pii_crf.KINDS[k]) for s, k, e in added[0]] == [(other, "phone")] * n


def test_nothing_is_added_without_evidence(model):
    texts = ["call 474-555-5602 or 474-555-5602 or 4745555602", "year 2020 and 2021 in 3 parts 2020", "a1234567 a1234567 ab@ ab@",
             "+1 (474) 555-5602 then 4745555999 and 474 (474) +1 1", "card 4111 1111 1111 1111 and 4111 or 1111"]
    base, added = pii_crf.find_spans(texts, model)
    assert [len(b) for b in base] == [0, 0, 0, 1, 1] and not any(added)


def test_mail_starts_share_a_label(model):
    text = "write to john.smith9@mail.example.org today, john.smith9@ works too, jane@ does not"
    _, added = pii_crf.find_spans([text], model)
    assert [text[s:e] for s, _, e in added[0]] == ["john.smith9@"]


def test_shapes_and_keys_take_whole_tokens():
    a = "x1-" * 40
    assert pii_crf.shape(a + "b") != pii_crf.shape(a + "7") and pii_crf.shape("1" * 30) != pii_crf.shape("1" * 31)
    assert not set(pii_crf.similarity_keys("a" * 90 + "1")) & set(pii_crf.similarity_keys("a" * 90 + "2"))


def test_skip_edges_are_linear_in_repeats():
    g = pii_crf.build("555-5602 " * 1000, [])
    assert len(g.skip) == len(g.chain) == 999
    text = "+1 (474) 555-5602 " + "x 555-5602 " * 1000
    assert len(pii_crf.build(text, pii_crf.base_spans(text)).skip) < 3000


def test_a_long_text_of_numbers_fits_in_little_memory(model):
    import tracemalloc
    text = "+1 (474) 555-5602 x " + " x ".join(str(i * 7919 % 1000003) for i in range(450000)) + " x 474-555-5602 x"
    assert len(text) > 4_000_000
    tracemalloc.start()
    _, added = pii_crf.find_spans([text], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [text[s:e] for s, _, e in added[0]] == ["474-555-5602"] and peak < 300e6


def brute_counts(texts):
    """Shapes and labels of candidate tokens, counted one by one."""
    out = np.zeros((pii_crf.SHAPES, pii_crf.LABELS))
    for t in texts:
        spans = brute(t)
        for m in re.finditer(r"\S+", t):
            if re.search("[0-9@]", m.group()):
                core = m.group().strip(".,;:!?\"'()[]{}<>")
                s = m.start() + (m.group().index(core) if core else 0)
                e = s + len(core) if core else m.end()
                label = next((k for a, k, b in sorted(spans) if a < e and b > s), pii_crf.NONE)
                tied = {k for a, _, b in spans for k in pii_crf.similarity_keys(t[a:b])}
                if label != pii_crf.NONE or not tied & set(pii_crf.similarity_keys(m.group())):
                    out[pii_crf.shape(m.group()), label] += 1
    return out


def test_label_counts(small_texts):
    texts = [t for _, t in small_texts]
    got = pii_crf.label_counts(texts)[:pii_crf.SHAPES * pii_crf.LABELS].reshape(pii_crf.SHAPES, pii_crf.LABELS)
    assert (got == brute_counts(texts)).all()


def test_edge_rows_and_mask(edge_docs, no_docs, model):
    rows = pii_crf.spans(edge_docs, model, keep=["doc_id"]).collect()
    assert len(rows) == len(EDGE) and all(not r.spans for r in rows if r.doc_id in (2, 3, 4))
    nine = next(r for r in rows if r.doc_id == 9)
    assert [s.kind for s in nine.base] == ["email", "ip", "card", "phone"]
    out = pii_crf.mask(edge_docs, model)
    assert out.columns == edge_docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[9] == "mail [EMAIL] and [IP] or [CARD], [PHONE]" and texts[2] is None and texts[3] == ""
    assert pii_crf.spans(no_docs, pii_crf.train(no_docs)).count() == 0


def test_added_spans_of_a_table(spark):
    """Planted repeats come back from the table, in any cut into slices and partitions."""
    docs = [(i, f"office +1 (474) 555-{1000 + i} " + "text 12 " * (i % 5) + (f"again 474-555-{1000 + i}" if i % 3 else "again 474-555-9999"))
            for i in range(60)] + [(60, "474-555-1001 alone"), (61, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    model = pii_crf.train(df)
    got = {r.doc_id: r for r in pii_crf.spans(df, model).collect()}
    one = {r.doc_id: r for r in pii_crf.spans(df.coalesce(1), model).collect()}
    for i, t in docs:
        extra = [s for s in got[i].spans if s not in got[i].base]
        want = [f"474-555-{1000 + i}"] if i < 60 and i % 3 else []
        assert [t[s.start:s.end] for s in extra] == want and got[i].spans == one[i].spans


def test_query(spark, small_texts):
    import hashlib
    got = {r.doc_id: r for r in queries.op2(spark, SF).collect()}
    assert len(got) == len(small_texts)
    for i, t in small_texts:
        spans = brute(t)
        listed = ",".join(f"{pii_crf.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(
            sum(k == j for _, k, _ in spans) for j in range(4))
        assert set(listed.split(",")) <= set(got[i].spans.split(","))
