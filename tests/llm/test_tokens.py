"""Token counts and byte-level BPE against the libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from ledgerlake.llm import byte_bpe, queries, token_counts

from .conftest import EDGE, SF

RANKS = P.path("byte_bpe_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
HARD = ["it's we'll I'd '' 's 'sam \n's x''s \"'s  a  b   \n\n c\t\td é's 'S 'Ll don't", "   ", " ", "\n", "a   ",
        "1a2b ３ Ⅷ ½x", " a   b c 　", "\x1c\x1da b\x85c", "'r 're're're ''l", "🙂🙂 a🙂", "ab" * 3000 + " " + "=" * 4000,
        "a<|endoftext|> b <|endoftext|>c", "<|endoftext|>", "x <|endoftext|>  y", "| | a", "\x00 b", "\x00  b"]


@pytest.fixture(scope="module")
def texts(small_texts):
    rng = random.Random(4)
    alphabet = "ab's'tre vl \n\t1２é ñ-—  🙂李|"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    return HARD + made + [t or "" for _, t in EDGE] + [t for _, t in small_texts]


def test_counts_equal_the_library(texts):
    tok = Tokenizer.from_file(JSON)
    want = [len(e) for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.counter(JSON).counts(texts) == want
    assert token_counts.PieceCounter(JSON).counts(texts[::-1]) == want[::-1]     # whatever is remembered


def test_counts_with_a_full_memo(texts, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_PIECES", 5)
    own = token_counts.PieceCounter(JSON)
    some = texts[:400]
    want = [len(e) for e in own.tokenizer.encode_batch(some, add_special_tokens=False)]
    assert [own.counts([t])[0] for t in some] == want


def test_ids_equal_the_library_and_decode(texts):
    codec = byte_bpe.codec(RANKS)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    coded = codec.encode(texts)
    for text, (ids, offsets) in zip(texts, coded, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
        cuts = [*offsets.tolist(), len(text.encode())]
        assert b"".join(text.encode()[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)) == text.encode()


def test_heap_and_array_merges_agree(texts):
    codec = byte_bpe.codec(RANKS)
    pieces = sorted({p for t in texts for p in byte_bpe.text_slices([t])[0] if 0 < len(p) <= byte_bpe.MEMO_BYTES})[:4000]
    many = byte_bpe.merge_many(pieces, codec.ranks, codec.single, codec.pairs)
    assert [np.frombuffer(x, "<u4").tolist() for x in many] == [byte_bpe.merge_pairs(p, codec.ranks) for p in pieces]


def test_composition_is_associative_and_scan_is_sequential():
    _, comp, _, _ = byte_bpe._monoid()
    n = len(comp)
    for a in range(n):
        for b in range(n):
            assert (comp[comp[a, b]] == comp[a][comp[b]]).all()
    rng = np.random.default_rng(1)
    for size in (1, 63, 64, 65, 1000, 5003):
        f = rng.integers(0, n, size).astype(np.uint8)
        acc, want = 0, []
        for x in f.tolist():
            acc = comp[acc, x]
            want.append(acc)
        assert byte_bpe._scan(f, comp).tolist() == want


def test_queries_on_edge_rows(spark, edge_docs, no_docs):
    counted = token_counts.count_tokens(edge_docs, JSON)
    assert [f.name for f in counted.schema].count("n_tokens") == 1
    rows = counted.collect()
    assert len(rows) == len(EDGE) and {(r.n_bytes, r.n_tokens) for r in rows if r.doc_id in (2, 3)} == {(0, 0)}
    trip = {(r.doc_id, r.decoded_sha256) for r in byte_bpe.round_trip(edge_docs, RANKS, keep=["doc_id"]).collect()}
    assert trip == {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in EDGE}
    back = byte_bpe.decode(byte_bpe.encode(edge_docs, RANKS), RANKS).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)
    assert token_counts.count_tokens(no_docs, JSON).count() == 0
    assert byte_bpe.encode(no_docs, RANKS).count() == 0


def test_query_results(spark, small_texts):
    tok = Tokenizer.from_file(JSON)
    want = {i: (len(t.encode()), len(tok.encode(t, add_special_tokens=False))) for i, t in small_texts}
    got = queries.op4(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert {r.doc_id: r.n_tokens for r in queries.op9(spark, SF).collect()} == {i: n for i, (_, n) in want.items()}
