"""The index of benchmark windows: many different words, large slices, copies, chance hash hits."""

import time
import tracemalloc

import numpy as np

from ledgerlake.llm import decontaminate
from ledgerlake.llm.decontaminate import Index


def everywhere(index):
    return {s: np.ones(k.size, np.int64) for s, k in index.shingles.items()}


def test_windows_of_a_wide_vocabulary_are_found():
    words = [f"w{i}" for i in range(3_000_000)]
    index = Index.build([("other", " ".join(words[:1_500_000]).encode()), ("item", " ".join(words[1_500_000:1_500_010]).encode())], 10, 3)
    index.choose_prefixes(everywhere(index), 3)
    ids = index.ids([b"w5", *[w.encode() for w in words[1_500_000:1_500_010]], b"w7"])
    covered, pairs = decontaminate._hits(index, np.append(ids, -1), np.array([0, 13]))
    assert covered.tolist() == [False] + [True] * 10 + [False] * 2
    assert [index.items(w) for _, w in pairs.tolist()] == [["item"]]


def brute(rows, window):
    out = {}
    for name, raw in rows:
        w = decontaminate.words_of(raw)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            out.setdefault(tuple(w[i:i + window]), set()).add(name)
    return out


def listed(index):
    word = {i: w for w, i in index.vocab.items()}
    return [(tuple(word[i] for i in index.flat[s:s + n].tolist()), set(index.items(k)))
            for k, (s, n) in enumerate(zip(index.start.tolist(), index.length.tolist(), strict=True))]


def test_each_different_window_once(monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(f"i{i % 40}", " ".join(rng.choice(list("abcd"), rng.integers(0, 25))).encode()) for i in range(120)] + [("", b"a b"), ("z", b"")]
    got = listed(Index.build(rows, 4, 3))
    assert dict(got) == brute(rows, 4) and len(got) == len(dict(got))
    # windows that share a hash by chance stay apart
    monkeypatch.setattr(decontaminate, "_content", lambda flat, start, length: np.zeros(start.size, np.uint64))
    merged = {}
    for w, items in listed(Index.build(rows, 4, 3)):
        merged.setdefault(w, set()).update(items)
    assert merged == brute(rows, 4)


def test_rarest_shingle_is_chosen():
    rows = [("a", b"x y z u v"), ("b", b"x y"), ("c", b"q")]
    index = Index.build(rows, 4, 3)
    counts = everywhere(index)
    rare = decontaminate._keys(index.ids([b"z", b"u", b"v"]), 3)[0]
    counts[3][:] = 5
    counts[3][np.searchsorted(index.shingles[3], rare)] = 1
    counts[1][:] = 0                        # in no document: the window cannot occur
    index.choose_prefixes(counts, 3)
    keys, first, window, offset, _ = index.prefix[3]
    at = [i for i, w in enumerate(window) if index.start[w] == 1]
    assert offset[at].tolist() == [1] and 1 not in index.prefix and 2 in index.prefix


def test_a_full_slice_is_indexed_in_bounded_memory():
    rng = np.random.default_rng(6)
    words = [f"word{i}" for i in range(200_000)]
    rows = [(str(i), " ".join(np.take(words, rng.integers(0, len(words), 2000))).encode()) for i in range(1, 800)]
    assert sum(len(r) for _, r in rows) > decontaminate.INDEX_BYTES * 0.9
    tracemalloc.start()
    began = time.time()
    index = Index.build(rows, 10, 3)
    index.choose_prefixes(everywhere(index), 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert index.start.size > 1_500_000 and peak < 500e6 and time.time() - began < 120
