"""Source divergence and centroid clustering: the queries against SQL, parts against brute force."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import orchard, queries, source_audit

from .conftest import SF

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@pytest.mark.parametrize("name", ["op11_source_divergence", "op13_orchard"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'").fetchall()
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF)
    assert got.columns == want.columns
    assert Counter(tuple(r) for r in got.collect()) == Counter(want.fetchall())


@pytest.mark.parametrize("short", [1, 40, 1 << 14])
def test_pointer_sort(monkeypatch, short):
    monkeypatch.setattr(source_audit, "SHORT_SLICE", short)
    rng = np.random.default_rng(3)
    made = ["".join(rng.choice(list("aAbé"), rng.integers(1, 30))) for _ in range(80)] + ["prefixprefixprefix" + "x" * i for i in range(20)]
    texts = [" ".join(rng.choice(made, 40)) for _ in range(30)] + ["", "a1b2 c", "same", "same", "", "y" * 5000, "y" * 5000]
    group = [("en", "s"), ("de", "t")]
    langs = [group[i % 2][0] for i in range(len(texts))]
    sources = [group[i // 2 % 2][1] for i in range(len(texts))]
    for cut in (0, 3):                      # also a slice of a longer buffer
        got = source_audit.count_slice(*[pa.array(v, pa.string()).slice(cut) for v in (texts, langs, sources)])
        rows = Counter(zip(*[x.to_pylist() if isinstance(x, pa.Array) else x.tolist() for x in got], strict=True))
        docs, n = Counter(), Counter()
        for t, lang, s in list(zip(texts, langs, sources, strict=True))[cut:]:
            found = TERM.findall(lower(t))
            n.update((lang, s, w) for w in found)
            docs.update((lang, s, w) for w in set(found))
        assert rows == Counter((*k, docs[k], n[k]) for k in n)


def brute(rows):
    docs = [(lang or "", s or "", TERM.findall(lower(t or ""))) for lang, s, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(w for d in mine for w in set(d[2]))
        kept = {w for w, k in df.items() if k >= 3}
        per = defaultdict(Counter)
        for _, s, w in mine:
            per[s].update(x for x in w if x in kept)
        whole = sum(per.values(), Counter())
        share = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        p, q = {s: share(c) for s, c in per.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in per:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in per if o != s]
            terms = [(-f(p[s][w], q[w]), w.encode(), w) for w in kept if per[s][w] and p[s][w] > q[w]]
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", w, -v, i) for i, (v, _, w) in enumerate(sorted(terms)[:200], 1)]
    return Counter(out)


@pytest.mark.parametrize("block, size", [(1, 50), (1 << 14, 1 << 20)])
def test_divergence_by_brute_force(spark, monkeypatch, block, size):
    monkeypatch.setattr(source_audit, "BLOCK_TERMS", block)
    monkeypatch.setattr(source_audit, "SORT_BYTES", size)       # most texts are sorted in pieces
    rng = np.random.default_rng(5)
    words = [f"w{chr(97 + i % 26)}{'abcdefgh'[i % 8] * (i % 5)}é" for i in range(300)]
    zipf = 1 / np.arange(1, 301)
    rows = [(["en", "de", None][rng.integers(3)], [None, "a", "b", "c", "d"][rng.choice(5, p=[.1, .5, .2, .1, .1])],
             " ".join(rng.choice(words, rng.integers(0, 80), p=zipf / zipf.sum()))) for _ in range(120)]
    rows += [("en", "no words", None), ("en", "no words", "1 2 3"), ("xx", "rare", "one two"), ("xx", "other", "three"), ("yy", "", "")]
    rows += [rows[0]] * 40
    df = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 as n", "'t' as term", "2 as V")
    assert Counter(tuple(r) for r in source_audit.divergence(df).collect()) == brute(rows)
    assert source_audit.divergence(df.limit(0)).collect() == []


def test_keys_are_read_once_a_depth(monkeypatch):
    read, key = Counter(), source_audit.Pointers.key

    def counting(self, p, depth):
        read[depth] += p.size
        return key(self, p, depth)

    monkeypatch.setattr(source_audit.Pointers, "key", counting)
    monkeypatch.setattr(source_audit, "SHORT_SLICE", 64)        # a slice is split many times
    rng = np.random.default_rng(8)
    made = ["".join(rng.choice(list("abcd"), rng.integers(2, 9))) for _ in range(900)] + ["ninebytes", "ninebytez"]
    words = rng.choice(made, 20_000)
    text = pa.array([" ".join(words)], pa.string())
    got = source_audit.count_slice(text, pa.array(["en"]), pa.array(["s"]))
    assert dict(zip(got[2].to_pylist(), np.array(got[4]).tolist(), strict=True)) == Counter(words.tolist())
    assert read[0] == words.size and read[8] <= np.char.startswith(words, "ninebyte").sum()


@pytest.mark.parametrize("rows", [1, 5, 1 << 16])
def test_words_that_run_over_blocks_are_kept_whole(monkeypatch, rows):
    monkeypatch.setattr(source_audit, "OUT_ROWS", rows)
    rng = np.random.default_rng(9)
    cells = [(lang, g, term, int(rng.integers(1, 3)), int(rng.integers(3, 9)))
             for term in ["a", "b", "bb", "é"] for lang in (-7, 2) for g in range(int(rng.integers(1, 30)))]
    table = pa.table(list(zip(*cells, strict=True)), names=["lang", "source", "term", "docs", "n"])
    for size in (1, 4, 100):
        got = pa.Table.from_batches(source_audit._kept_words(iter(table.to_batches(max_chunksize=size)), 4)).to_pylist()
        want = {}
        for lang, g, term, docs, n in cells:
            held = want.setdefault((lang, term), [0, 0, []])
            want[lang, term] = [held[0] + docs, held[1] + n, held[2] + [(g, n)]]
        assert {(r["l"], r["term"]): (r["lang_n"], [(x["g"], x["n"]) for x in r["at"]]) for r in got} == {
            k: (n, at) for k, (docs, n, at) in want.items() if docs >= 4}
    assert list(source_audit._kept_words(iter([]), 4)) == []


def test_a_hash_that_confuses_names_is_not_used(spark, monkeypatch):
    numbers = source_audit._numbers
    for same in (0, 1):             # languages, then groups of one number
        monkeypatch.setattr(source_audit, "_numbers", lambda lang, source, seed, same=same: [
            F.lit(5).cast("long").alias("lg"[i]) if seed == 0 and i == same else c for i, c in enumerate(numbers(lang, source, seed))])
        rows = [("en", s, f"one two {w}") for s in "abc" for w in ("three", "four") for _ in range(2)] + [("de", "a", "one one")] * 3
        df = spark.createDataFrame(rows, "lang string, source string, text string")
        assert Counter(tuple(r) for r in source_audit.divergence(df).collect()) == brute(rows)


def test_counts_beyond_a_long_stay_exact(spark):
    df = spark.range(1).selectExpr("cast(12345678901234567 as bigint) as n", "cast(98765432109876543 as bigint) as t", "1000L as v")
    got = df.selectExpr(source_audit._share("n", "t", "v") + " as p").first().p
    assert got == 1 + 10**9 * 12345678901234568 // (98765432109876543 + 1000)


def test_orchard_finds_the_nearest(monkeypatch):
    rng = np.random.default_rng(1)
    for dims, k, spread in [(2, 40, 30), (8, 13, 5), (64, 40, 200), (3, 1, 5), (2, 25, 2)]:
        c = rng.integers(-spread, spread + 1, (k, dims))
        c[rng.integers(k)] = c[0]                       # equal centroids
        x = rng.integers(-spread, spread + 1, (500, dims))
        d = ((x[:, None] - c) ** 2).sum(axis=2)
        at, best, compared = orchard.Neighbours.of(c).nearest(x)
        assert (at == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all() and compared <= 500 * k
    # close groups: most centroids are never compared
    centres = rng.integers(-10**6, 10**6, (40, 4))
    x = centres[rng.integers(0, 40, 2000)] + rng.integers(-9, 10, (2000, 4))
    assert orchard.Neighbours.of(centres).nearest(x)[2] < 0.6 * 2000 * 40
    largest = np.full((2, 64), orchard.LARGEST - 1)
    largest[1] *= -1
    assert orchard.Neighbours.of(largest).nearest(largest)[1].tolist() == [0, 0]


def test_clusters_edges(spark):
    bad = [None, [], [1.0] * 63, [1.0] * 65, [float("nan")] * 64, [None] + [1.0] * 63, [float("inf")] * 64, [float("-inf")] * 64]
    same = [0.5, -0.25] * 32
    rows = [(i, v, "x") for i, v in enumerate(bad)] + [(100, same, "x")] * 5 + [(101, [-0.001] * 64, None), (None, [2.0] * 64, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster string")
    got = orchard.cluster(df).collect()
    assert Counter(r.vec_id for r in got) == {100: 5, 101: 1, None: 1} and {r.inertia for r in got} == {0}
    assert {tuple(r.centroid) for r in got if r.vec_id == 101} == {(-1,) * 64}
    empty = orchard.cluster(df.limit(0))
    assert empty.collect() == [] and empty.columns == [f.name for f in orchard.cluster(df).schema]
    with pytest.raises(Exception, match="magnitude"):
        orchard.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>"))


def test_means_round_down(spark):
    rows = [(i, [float(i % 3) / -256] * 64) for i in range(7)]
    x = orchard.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    lists = orchard.Neighbours.of(np.zeros((1, 64), np.int64))
    assert orchard.moved(x, lists)[0].tolist() == [-1] * 64     # -6 / 7
