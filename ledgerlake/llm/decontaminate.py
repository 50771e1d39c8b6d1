"""Benchmark decontamination as a prefix-filtered containment join.

Every window of ``window`` consecutive item words (or a shorter item as a whole) is a set of
word shingles that must be contained completely, so its necessary prefix is its rarest
shingle.  Rarity is counted over all documents in a first pass.  In the second pass each
document joins its shingles with the prefix shingles; a match at a position fixes where the
window would start, which must lie inside the document with all its length, and the words
there are compared exactly.

The benchmark side is indexed in slices of bounded text, as arrays of word numbers and window
places (some 60 bytes a word of the slice, and its different words); each slice is broadcast and
joined with all documents in turn, so any benchmark size works and the usual one takes one turn.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import SLICE_BYTES, as_bytes, byte_slices, field, ident, set_arrow_rows
from ledgerlake.session import cut_lineage

WINDOW = 10
SHINGLE = 3
#: Benchmark text of one broadcast slice.
INDEX_BYTES = 16 << 20
#: Candidate positions verified at once.
_CHUNK = 1 << 18
_FILTER_BITS = 20

# lower-cases A-Z, keeps 0-9, a-z and every byte of a multi-byte character, blanks the rest
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                    for b in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORD_BYTES).split()


def _keys(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of the shingle of ``size`` words from each position on; -1 where a word is unknown.
    Shingles that share a hash only make candidates, which are compared exactly."""
    n = ids.size - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    key = np.zeros(n, np.uint64)
    known = np.ones(n, bool)
    for j in range(size):
        part = ids[j:j + n]
        key = (key + part.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(31)
        known &= part >= 0
    out = (key >> np.uint64(1)).astype(np.int64)
    out[~known] = -1
    return out


def _content(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of the words of each window."""
    key = length.astype(np.uint64)
    for j in range(int(length.max(initial=0))):
        inside = j < length
        part = flat[np.minimum(start + j, flat.size - 1)].astype(np.uint64) + np.uint64(1)
        mixed = (key + part) * np.uint64(0xBF58476D1CE4E5B9)
        key = np.where(inside, mixed ^ (mixed >> np.uint64(31)), key)
    return key


def _same_words(flat: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    same = np.ones(a.size, bool)
    for j in range(int(length.max(initial=0))):
        same &= (j >= length) | (flat[np.minimum(a + j, flat.size - 1)] == flat[np.minimum(b + j, flat.size - 1)])
    return same


@dataclass
class Index:
    """One slice of benchmark windows, as arrays: windows are places in the slice's words."""

    vocab: dict[bytes, int]
    flat: np.ndarray                        # word ids of all items, one after the other
    start: np.ndarray                       # first word of each different window
    length: np.ndarray                      # and its words
    names: list[str]                        # item ids
    held_first: np.ndarray                  # window -> its first entry in held
    held: np.ndarray                        # item numbers
    shingles: dict[int, np.ndarray]         # shingle size -> its sorted keys
    prefix: dict[int, tuple] | None = None  # shingle size -> (keys, first, window, offset, filter)

    @classmethod
    def build(cls, rows: Iterable[tuple[str, bytes]], window: int, shingle: int) -> Index:
        vocab: dict[bytes, int] = {}
        numbers: dict[str, int] = {}
        flat, begin, size, item = array("i"), array("q"), array("q"), array("q")
        for name, raw in rows:
            begin.append(len(flat))
            flat.extend([vocab.setdefault(w, len(vocab)) for w in words_of(raw)])
            size.append(len(flat) - begin[-1])
            item.append(numbers.setdefault(name, len(numbers)))
        flat = np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32)
        begin, size, item = (np.frombuffer(x, np.int64) if x else np.zeros(0, np.int64) for x in (begin, size, item))
        # every window of every item
        many = np.where(size > 0, np.maximum(1, size - window + 1), 0)
        start = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        length, item = np.repeat(np.minimum(size, window), many), np.repeat(item, many)
        # equal ones once; those that share a hash by chance stay apart
        content = _content(flat, start, length)
        order = np.argsort(content, kind="stable")
        content, start, length, item = content[order], start[order], length[order], item[order]
        new = np.ones(content.size, bool)
        new[1:] = content[1:] != content[:-1]
        lead = np.flatnonzero(new)[np.cumsum(new) - 1] if content.size else np.zeros(0, np.int64)
        new |= (length != length[lead]) | ~_same_words(flat, start, start[lead], length)
        group = np.where(new, np.cumsum(new) - 1, (np.cumsum(new) - 1)[lead])
        pairs = np.unique(group * max(len(numbers), 1) + item)
        held = pairs % max(len(numbers), 1)
        first = np.searchsorted(pairs // max(len(numbers), 1), np.arange(int(new.sum()) + 1))
        index = cls(vocab, flat, start[new], length[new], list(numbers), first, held.astype(np.int32), {})
        index.shingles = {s: np.unique(np.concatenate([keys for _, _, keys in index._prefix_places(s, shingle)]))
                          for s in np.unique(np.minimum(index.length, shingle)).tolist()}
        return index

    def _prefix_places(self, size: int, shingle: int):
        """(windows, offset, key of the shingle there) of all shingles of windows with this shingle size."""
        keys = _keys(self.flat, size)
        mine = np.flatnonzero(np.minimum(self.length, shingle) == size)
        for offset in range(int(self.length[mine].max(initial=0)) - size + 1):
            use = mine[self.length[mine] >= offset + size]
            yield use, offset, keys[self.start[use] + offset]

    def items(self, window: int) -> list[str]:
        return [self.names[i] for i in self.held[self.held_first[window]:self.held_first[window + 1]]]

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.vocab.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def choose_prefixes(self, counts: dict[int, np.ndarray], shingle: int) -> None:
        """Each window joins on its rarest shingle only (ties: the smallest key)."""
        n = self.start.size
        seen = np.full(n, np.iinfo(np.int64).max)
        key, place = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        for size, table in self.shingles.items():
            for use, offset, keys in self._prefix_places(size, shingle):
                times = counts[size][np.searchsorted(table, keys)]
                better = (times < seen[use]) | ((times == seen[use]) & (keys < key[use]))
                use = use[better]
                seen[use], key[use], place[use] = times[better], keys[better], offset
        self.prefix = {}
        for size in self.shingles:
            # a shingle that no document has rules the window out
            use = np.flatnonzero((np.minimum(self.length, shingle) == size) & (seen > 0))
            if use.size:
                use = use[np.argsort(key[use], kind="stable")]
                keys, first = np.unique(key[use], return_index=True)
                self.prefix[size] = (keys, np.append(first, use.size), use, place[use], _filter(keys))


def _spread(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def _filter(keys: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << _FILTER_BITS, bool)
    bits[_spread(keys)] = True
    return bits


def _member(key: np.ndarray, table: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, index in ``table``) of the keys that ``table`` holds."""
    at = np.flatnonzero(key >= 0)
    at = at[bits[_spread(key[at])]]
    where = np.searchsorted(table, key[at])
    ok = where < table.size
    at, where = at[ok], where[ok]
    ok = table[where] == key[at]
    return at[ok], where[ok]


def _joined(index: Index, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of all texts with a gap of -1 after each text, and where each text starts."""
    split = [words_of(t) for t in texts]
    size = np.array([len(w) for w in split], np.int64)
    start = np.concatenate([[0], np.cumsum(size + 1)])
    ids = np.full(int(start[-1]), -1, np.int64)
    gap = np.zeros(ids.size, bool)
    gap[start[1:] - 1] = True
    ids[~gap] = index.ids([w for words in split for w in words])
    return ids, start


def _count_shingles(index_value, batches, max_bytes: int):
    """Occurrences of every benchmark shingle in this task's documents (one row a shingle)."""
    index: Index = index_value.value
    bits = {s: _filter(k) for s, k in index.shingles.items()}
    total = {s: np.zeros(k.size, np.int64) for s, k in index.shingles.items()}
    for batch in batches:
        for part in byte_slices(batch, 0, max_bytes):
            ids, _ = _joined(index, as_bytes(part.column(0)))
            for s, table in index.shingles.items():
                _, where = _member(_keys(ids, s), table, bits[s])
                total[s] += np.bincount(where, minlength=table.size)
    for s, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(at.size, s), pa.int32()), pa.array(at, pa.int64()),
                                          pa.array(n[at], pa.int64())], names=["size", "at", "n"])


def _hits(index: Index, ids: np.ndarray, start: np.ndarray):
    """(covered words, pairs of text and window) by exact verification of the candidates."""
    edge = np.zeros(ids.size + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    flat, flat_at, length = index.flat, index.start, index.length
    text_of = np.repeat(np.arange(start.size - 1), np.diff(start))
    for size, (keys, first, window, offset, bits) in (index.prefix or {}).items():
        at, where = _member(_keys(ids, size), keys, bits)
        many = first[where + 1] - first[where]
        ends = np.cumsum(many)
        done = 0
        while done < at.size:                # bounded chunks of (position, window) candidates
            stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + _CHUNK, side="right")))
            n = many[done:stop]
            pos = np.repeat(at[done:stop], n)
            row = np.repeat(first[where[done:stop]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            win, begin = window[row], pos - offset[row]
            # positional and length bounds: the whole window lies in the text of the match
            text = text_of[pos]
            ok = (begin >= start[text]) & (begin + length[win] <= start[text + 1] - 1)
            win, begin, text = win[ok], begin[ok], text[ok]
            same = np.ones(win.size, bool)
            for j in range(int(length[win].max()) if win.size else 0):
                inside = j < length[win]
                want = flat[np.minimum(flat_at[win] + j, flat.size - 1)]
                have = ids[np.minimum(begin + j, ids.size - 1)]
                same &= ~inside | (want == have)
            win, begin, text = win[same], begin[same], text[same]
            np.add.at(edge, begin, 1)
            np.add.at(edge, begin + length[win], -1)
            pairs.append(np.unique(np.stack([text, win], axis=1), axis=0))
            done = stop
    return np.cumsum(edge[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0)


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _mark(index_value, batches, at_text: int, n_carried: int, names: list[str], max_bytes: int):
    """Adds this slice's hits to those of earlier slices (run starts, run ends and items, the
    three columns after the carried ones)."""
    index: Index = index_value.value
    for batch in batches:
        for part in byte_slices(batch, at_text, max_bytes):
            ids, start = _joined(index, as_bytes(part.column(at_text)))
            hit, pairs = _hits(index, ids, start)
            old = [part.column(n_carried + k).to_pylist() for k in range(3)]
            items: list[set] = [set(x or ()) for x in old[2]]
            for text, win in pairs.tolist():
                items[text].update(index.items(win))
            n_words, n_hit, starts, stops = [], [], [], []
            for i in range(part.num_rows):
                own = hit[start[i]:start[i + 1] - 1].copy()
                for s, e in zip(old[0][i] or (), old[1][i] or (), strict=True):
                    own[s:e] = True
                s, e = _runs(own)
                n_words.append(own.size)
                n_hit.append(int(own.sum()))
                starts.append(s.astype(np.int32))
                stops.append(e.astype(np.int32))
            made = [pa.array(starts, pa.list_(pa.int32())), pa.array(stops, pa.list_(pa.int32())),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())]
            yield pa.RecordBatch.from_arrays([*part.columns[:n_carried], *made], names=names)


def _counting(shared):
    return lambda batches: _count_shingles(shared, batches, SLICE_BYTES)


def _marking(shared, at_text: int, n_carried: int, names: list[str]):
    return lambda batches: _mark(shared, batches, at_text, n_carried, names, SLICE_BYTES)


def _slices(benchmark: DataFrame, item_col: str, text_col: str, index_bytes: int):
    """Benchmark rows in slices of about ``index_bytes`` of text, one slice at a time."""
    items = benchmark.select(F.coalesce(ident(item_col).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(ident(text_col).cast("string"), F.lit("")).alias("text"))
    items = cut_lineage(items.distinct(), "bench-items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // index_bytes))
    for i in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield i, n, ((r["item"], r["text"].encode()) for r in part.toLocalIterator())


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                      keep: list[str] | None = None, index_bytes: int = INDEX_BYTES, prefix: str = "") -> DataFrame:
    """``keep`` columns (default: all) with n_words, n_hit, hit_starts / hit_ends (maximal runs of
    hit words, end exclusive), items (ids of items with occurring windows, sorted) and
    contaminated; ``prefix`` goes before these names.

    Null and empty texts have no words; an item of no words has no window; a null item id counts
    as the empty id; rows with the same item id are one item; repeated documents are marked each;
    an empty benchmark marks nothing; an empty table gives an empty result; kept columns named
    like the output are replaced.
    """
    spark = docs.sparkSession
    set_arrow_rows(spark)
    made = [prefix + c for c in ("hit_starts", "hit_ends", "items", "n_words", "n_hit")]
    flag = prefix + "contaminated"
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (*made, flag)]
    text = "__llm_text"
    if text_col in keep and isinstance(docs.schema[text_col].dataType, T.StringType):
        at_text, sent = keep.index(text_col), [ident(c) for c in keep]
    else:
        at_text, sent = len(keep), [*[ident(c) for c in keep], ident(text_col).cast("string").alias(text)]
    at = docs.select(*sent, F.lit(None).cast("array<int>").alias(made[0]),
                     F.lit(None).cast("array<int>").alias(made[1]), F.lit(None).cast("array<string>").alias(made[2]))
    schema = T.StructType([*at.schema.fields[:-3], field(made[0], "array<int>"), field(made[1], "array<int>"),
                           field(made[2], "array<string>"), field(made[3], "long"), field(made[4], "long")])
    carried = [ident(c) for c in schema.names[:-2]]
    sc = spark.sparkContext
    for i, n, rows in _slices(benchmark, item_col, item_text_col, index_bytes):
        index = Index.build(rows, window, shingle)
        shared = sc.broadcast(index)          # bounded by index_bytes of text
        seen = (docs.select(ident(text_col).cast("string").alias(text))
                .mapInArrow(_counting(shared), "size int, at long, n long")
                .groupBy("size", "at").agg(F.sum("n").alias("n")).toArrow())          # one row a shingle of the slice
        counts = {s: np.zeros(k.size, np.int64) for s, k in index.shingles.items()}
        of, place, n_seen = (seen[c].to_numpy() for c in ("size", "at", "n"))
        for s, table in counts.items():
            table[place[of == s]] = n_seen[of == s]
        index.choose_prefixes(counts, shingle)
        at = at.select(*carried).mapInArrow(_marking(sc.broadcast(index), at_text, len(schema) - 5, schema.names), schema)
        if i + 1 < n:
            at = cut_lineage(at, "bench-marked")
    return at.select(*[ident(c) for c in keep], *[ident(c) for c in made], (ident(made[4]) > 0).alias(flag))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit word, columns in order."""
    marked = mark_contaminated(docs, benchmark, prefix="__llm_", **options)
    return marked.where("not __llm_contaminated").select(*[ident(c) for c in docs.columns])
