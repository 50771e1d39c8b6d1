"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary file.

Pre-tokenisation works on arrays, not on a regular expression: every code point gets a class
(letter, number, white space, other), neighbours refine it to a symbol, each symbol is a
transition function on a small state set, and a blocked prefix scan composes the functions.
Composition is associative and only a few different functions can arise, so a function is a
one-byte id and composing two is one table lookup.  The state before a symbol tells whether a
match of the pattern starts there.  The slices between starts go through a cached merge of
pairs by rank; ids and byte offsets of the slices are kept, so decoding is exact.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlake.llm.common import as_text, field, map_texts

#: Slices remembered per worker process, and the longest slice that is remembered.
MEMO_SLICES = 800_000
MEMO_BYTES = 48
#: Slices merged together, and the mark of a pair that does not merge.
MERGE_ROWS = 20_000
NO_PAIR = np.iinfo(np.int32).max
#: Code points scanned at once (several texts, or one longer text).
SCAN_POINTS = 1 << 20
#: Bytes of text per kernel call.
BATCH_BYTES = 2 << 20

# The code points with the Unicode property White_Space.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)

# symbols: letter, number, other; white space that is followed by white space or the end
# (in a run), the last white space before something else (a U+0020 opens the next match, any
# other stands alone); an apostrophe with a one- or two-letter ending; a text boundary
SYM_L, SYM_N, SYM_O, SYM_RUN, SYM_JOIN, SYM_ALONE, SYM_APO1, SYM_APO2, SYM_END = range(9)

# states: inside a letter, number, other or white-space match; after an opening space; one or
# two ending letters due; closed (the next symbol always starts a match)
ST_L, ST_N, ST_O, ST_RUN, ST_JOIN, ST_DUE1, ST_DUE2, ST_CLOSED = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a match starts at this symbol)."""
    if symbol == SYM_L and state == ST_DUE2:
        return ST_DUE1, False
    if symbol == SYM_L and state == ST_DUE1:
        return ST_CLOSED, False
    if symbol in (SYM_L, SYM_N, SYM_O):
        same = (ST_L, ST_N, ST_O)[symbol]
        return same, state not in (same, ST_JOIN)
    if symbol == SYM_RUN:
        return ST_RUN, state != ST_RUN
    if symbol == SYM_JOIN:
        return ST_JOIN, True
    if symbol == SYM_ALONE:
        return ST_CLOSED, True
    if symbol in (SYM_APO1, SYM_APO2):
        if state in (ST_O, ST_JOIN):
            return ST_O, False
        return (ST_DUE1 if symbol == SYM_APO1 else ST_DUE2), True
    return ST_CLOSED, True


@lru_cache(1)
def _monoid():
    """All functions that symbols can compose to: ids of the symbols, the composition table
    (first, then second), the image of the closed state, and the start table by state."""
    n_sym, n_st = 9, 8
    funcs = [tuple(range(n_st))]
    index = {funcs[0]: 0}
    for s in range(n_sym):
        f = tuple(_step(q, s)[0] for q in range(n_st))
        if f not in index:
            index[f] = len(funcs)
            funcs.append(f)
    of_symbol = np.array([index[tuple(_step(q, s)[0] for q in range(n_st))] for s in range(n_sym)], np.uint8)
    done = 0
    gens = [funcs[i] for i in of_symbol]
    while done < len(funcs):
        f = funcs[done]
        for g in gens:
            h = tuple(g[f[q]] for q in range(n_st))
            if h not in index:
                index[h] = len(funcs)
                funcs.append(h)
        done += 1
    assert len(funcs) < 256
    comp = np.zeros((len(funcs), len(funcs)), np.uint8)
    for i, f in enumerate(funcs):
        for j, g in enumerate(funcs):
            comp[i, j] = index[tuple(g[f[q]] for q in range(n_st))]
    image = np.array([f[ST_CLOSED] for f in funcs], np.uint8)
    starts = np.array([[_step(q, s)[1] for s in range(n_sym)] for q in range(n_st)], bool)
    return of_symbol, comp, image, starts


@lru_cache(1)
def _classes() -> np.ndarray:
    table = np.full(0x110000, _OTHER, np.uint8)
    kinds = {"L": _LETTER, "N": _NUMBER}
    for cp in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(cp))[0])
        if kind is not None:
            table[cp] = kind
    table[list(WHITE_SPACE)] = _SPACE
    return table


def _scan(f: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of function ids, blocked: rows of a matrix advance together
    column by column, the row totals are scanned the same way, and then applied."""
    n = f.size
    if n <= 64:
        out = np.empty_like(f)
        acc = 0
        for i, x in enumerate(f.tolist()):
            acc = comp[acc, x]
            out[i] = acc
        return out
    width = max(8, int(n ** 0.5) // 4)
    rows = -(-n // width)
    m = np.zeros((width, rows), np.uint8)          # column-major blocks; id 0 is the identity
    padded = np.zeros(rows * width, np.uint8)
    padded[:n] = f
    m[:] = padded.reshape(rows, width).T
    flat, k = comp.ravel(), np.int32(comp.shape[0])
    for i in range(1, width):
        m[i] = flat[m[i - 1] * k + m[i]]
    carry = np.zeros(rows, np.uint8)
    carry[1:] = _scan(np.ascontiguousarray(m[-1, :-1]), comp) if rows > 1 else 0
    for i in range(width):
        m[i] = flat[carry * k + m[i]]
    return np.ascontiguousarray(m.T).ravel()[:n]


def match_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the matches of the pre-tokenisation pattern start in the concatenated code points
    of several texts; ``ends`` are the (exclusive) ends of the texts."""
    n = points.size
    if not n:
        return np.zeros(0, bool)
    of_symbol, comp, image, starts = _monoid()
    cls = _classes()[points]
    first = np.zeros(n, bool)
    first[0] = True
    first[ends[ends < n]] = True
    after = np.empty(n, np.uint8)                   # class of the next code point of the text
    after[:-1] = cls[1:]
    after[-1] = _SPACE
    after[:-1][first[1:]] = _SPACE                  # the end counts like white space
    symbol = np.array([0, SYM_L, SYM_N, SYM_O], np.uint8)[cls]
    space = cls == _SPACE
    run = after == _SPACE
    symbol[space & run] = SYM_RUN
    symbol[space & ~run] = SYM_ALONE
    symbol[space & ~run & (points == 0x20)] = SYM_JOIN
    apo = np.flatnonzero(points == 0x27)
    if apo.size:
        # the two code points after the apostrophe, inside the same text
        text_of = np.searchsorted(ends, apo, side="right")
        room = ends[text_of] - apo
        p1 = np.where(room > 1, points[np.minimum(apo + 1, n - 1)], 0)
        p2 = np.where(room > 2, points[np.minimum(apo + 2, n - 1)], 0)
        symbol[apo[np.isin(p1, [ord(c) for c in "stmd"])]] = SYM_APO1
        pair = p1.astype(np.int64) * 0x110000 + p2
        symbol[apo[np.isin(pair, [ord(a) * 0x110000 + ord(b) for a, b in ("re", "ve", "ll")])]] = SYM_APO2
    f = of_symbol[symbol]
    # a text's first function starts from the closed state whatever came before
    reset = comp[of_symbol[SYM_END]]
    f[first] = reset[f[first]]
    prefix = _scan(f, comp)
    state = np.empty(n, np.uint8)
    state[0] = ST_CLOSED
    state[1:] = image[prefix[:-1]]
    state[first] = ST_CLOSED
    return starts[state, symbol]


def text_slices(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(slices of all texts, byte offset of each slice in its text, slices before each text)."""
    data = "".join(texts)
    raw = data.encode("utf-8")
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
    points = np.frombuffer(data.encode("utf-32-le"), np.uint32)
    at = np.flatnonzero(match_starts(points, ends))
    if len(raw) == points.size:
        byte_at, text_byte = at, np.concatenate([[0], ends])
    else:
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        before = np.concatenate([[0], np.cumsum(width)])
        byte_at, text_byte = before[at], before[np.concatenate([[0], ends]).astype(np.int64)]
    firsts = np.searchsorted(at, np.concatenate([[0], ends]).astype(np.int64), side="left")
    cuts = [*byte_at.tolist(), len(raw)]
    pieces = [raw[s:e] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
    owner = np.repeat(np.arange(len(texts)), np.diff(firsts)) if texts else np.zeros(0, np.int64)
    return pieces, byte_at - text_byte[:-1][owner] if texts else byte_at, firsts


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as fh:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, fh)}


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair of lowest rank merges first, leftmost on ties.  A heap
    of candidate pairs over a linked list keeps long slices at n log n."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end = list(range(1, n + 1))                    # a live part is piece[i:end[i]]
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = []
    for i in range(n - 1):
        r = ranks.get(piece[i:i + 2])
        if r is not None:
            heap.append((r, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if not (alive[i] and end[i] == mid and alive[mid] and end[mid] == stop):
            continue
        end[i] = stop
        alive[mid] = False
        if stop < n:
            prev[stop] = i
            r = ranks.get(piece[i:end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, stop, end[stop]))
        p = prev[i]
        if p >= 0:
            r = ranks.get(piece[p:stop])
            if r is not None:
                heapq.heappush(heap, (r, p, i, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class PairTable:
    """(left id, right id) -> id of the merged token, as an open-addressing table in arrays, so
    many pairs are looked up at once.  Ids are ranks, so the smallest id merges first."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, merged = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a = ranks.get(token[:i])
                if a is None:
                    continue
                b = ranks.get(token[i:])
                if b is not None:
                    keys.append(a << 32 | b)
                    merged.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ids = np.full(1 << self.bits, NO_PAIR, np.int32)
        keys, merged = np.array(keys, np.int64), np.array(merged, np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        while todo.size:
            free = self.keys[at[todo]] == -1
            slots, first = np.unique(at[todo[free]], return_index=True)
            placed = todo[free][first]
            self.keys[slots], self.ids[slots] = keys[placed], merged[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        spread = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NO_PAIR where the pair does not merge."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        key[(left < 0) | (right < 0)] = -2
        at = self._slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.ids[at], NO_PAIR)
        todo = np.flatnonzero((found != key) & (found != -1))
        while todo.size:
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.ids[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


def merge_many(pieces: list[bytes], ranks: dict[bytes, int], single: np.ndarray,
               pairs: PairTable) -> list[bytes]:
    """Ids (little-endian unsigned 32-bit) of slices of at most MEMO_BYTES: all slices of about
    one length take their next merge together, one row each."""
    out: list[bytes] = [b""] * len(pieces)
    length = np.array([len(p) for p in pieces], np.int64)
    order = np.argsort(length, kind="stable")
    at = 0
    while at < len(order):
        size = int(length[order[at]])
        wide = max(4, -(-size // 4) * 4)
        end = min(at + MERGE_ROWS, int(np.searchsorted(length[order], wide, side="right")))
        rows = order[at:end]
        at = end
        ids = np.full((len(rows), wide + 1), -1, np.int32)
        raw = np.frombuffer(b"".join(pieces[i].ljust(wide, b"\0") for i in rows), np.uint8)
        ids[:, :wide] = single[raw].reshape(len(rows), wide)
        ids[np.arange(wide + 1)[None, :] >= length[rows][:, None]] = -1
        rank = pairs.lookup(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), wide)
        live = np.arange(len(rows))
        cur_ids, cur_rank = ids, rank
        while True:
            best = cur_rank.argmin(axis=1)
            low = cur_rank[np.arange(len(best)), best]
            go = low != NO_PAIR
            if not go.all():
                stop = np.flatnonzero(~go)
                ids[live[stop]] = cur_ids[stop]
                live, cur_ids, cur_rank = live[go], cur_ids[go], cur_rank[go]
                best, low = best[go], low[go]
            if not live.size:
                break
            r = np.arange(live.size)
            # close the gap after the merged pair, in ids and in the ranks of neighbours
            col = np.arange(wide)[None, :]
            take = np.minimum(col + (col > best[:, None]), wide)
            moved = np.empty_like(cur_ids)
            moved[:, :wide] = np.take_along_axis(cur_ids, take, axis=1)
            moved[:, wide] = -1
            moved[r, best] = low
            shifted = np.take_along_axis(cur_rank, np.minimum(take, wide - 1), axis=1)
            shifted[:, wide - 1] = NO_PAIR
            shifted[r, best] = pairs.lookup(moved[r, best], moved[r, best + 1])
            has = best > 0
            shifted[r[has], best[has] - 1] = pairs.lookup(moved[r[has], best[has] - 1], moved[r[has], best[has]])
            cur_ids, cur_rank = moved, shifted
        kept = ids >= 0
        count = kept.sum(axis=1) * 4
        flat = ids[kept].astype("<u4").tobytes()
        stops = np.cumsum(count).tolist()
        begin = 0
        for i, stop in zip(rows.tolist(), stops, strict=True):
            out[i] = flat[begin:stop]
            begin = stop
    return out


class Codec:
    """Encoder and decoder of one vocabulary, with a bounded memo of merged slices."""

    def __init__(self, ranks_path: str):
        self.ranks = load_ranks(ranks_path)
        size = max(self.ranks.values()) + 1
        vocab = [b""] * size
        for token, rank in self.ranks.items():
            vocab[rank] = token
        self.token_len = np.array([len(t) for t in vocab], np.int64)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_len)[:-1]])
        self.token_bytes = np.frombuffer(b"".join(vocab), np.uint8)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(self.ranks)
        self.memo: dict[bytes, bytes] = {}

    def merged(self, pieces: set[bytes]) -> dict[bytes, bytes]:
        short = [p for p in pieces if len(p) <= MEMO_BYTES]
        made = dict(zip(short, merge_many(short, self.ranks, self.single, self.pairs), strict=True))
        for p in pieces:
            if len(p) > MEMO_BYTES:
                made[p] = np.array(merge_pairs(p, self.ranks), "<u4").tobytes()
        return made

    def encode(self, texts: list[str]) -> list[tuple[bytes, np.ndarray]]:
        """Per text: its ids (little-endian unsigned 32-bit) and the byte offsets of its slices."""
        out = []
        memo = self.memo
        for group in _groups(texts, SCAN_POINTS):
            pieces, offsets, firsts = text_slices(group)
            new = self.merged({p for p in set(pieces) if p not in memo})
            if len(memo) < MEMO_SLICES:
                # until the memo is full; what comes first is mostly what is frequent
                memo.update((p, x) for p, x in new.items() if len(p) <= MEMO_BYTES)
                new = {p: x for p, x in new.items() if len(p) > MEMO_BYTES}
            ids = [memo[p] if p in memo else new[p] for p in pieces] if new else list(map(memo.__getitem__, pieces))
            bounds = firsts.tolist()
            out += [(b"".join(ids[a:b]), offsets[a:b])
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return out

    def decode(self, ids: bytes) -> bytes:
        tokens = np.frombuffer(ids, "<u4").astype(np.int64)
        size = self.token_len[tokens]
        ends = np.cumsum(size)
        if not ends.size:
            return b""
        # output byte k of a token is byte k of its entry in the concatenated vocabulary
        shift = np.repeat(self.token_at[tokens] - (ends - size), size)
        shift += np.arange(shift.size)
        return self.token_bytes[shift].tobytes()


@lru_cache(1)
def codec(ranks_path: str) -> Codec:
    """One codec a worker process: its memo serves all tasks the process runs."""
    return Codec(ranks_path)


def _groups(texts: list[str], points: int):
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > points:
            yield texts[start:i]
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield texts[start:]


class _EncodeKernel:
    def __init__(self, ranks_path: str, digests: bool):
        self.codec, self.digests = codec(ranks_path), digests

    def __call__(self, values: pa.Array):
        coded = self.codec.encode(as_text(values))
        if not self.digests:
            return ([np.frombuffer(ids, "<u4").astype(np.int32) for ids, _ in coded],
                    [offs.astype(np.int32) for _, offs in coded])
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return ([len(ids) // 4 for ids, _ in coded], [sha(ids) for ids, _ in coded],
                [sha(self.codec.decode(ids)) for ids, _ in coded])


def encode(docs: DataFrame, ranks_path: str, text_col: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``ids`` array<int> and ``offsets`` array<int>: the
    byte offset in the text of every pre-tokenisation slice.

    A null text counts as empty (no ids); special strings are ordinary text; repeated rows are
    encoded each; an empty table gives an empty result; kept columns named like the output are
    replaced.  The file at ``ranks_path`` must be on every executor.
    """
    keep = docs.columns if keep is None else keep
    return map_texts(docs, text_col, partial(_EncodeKernel, ranks_path, False),
                     [field("ids", "array<int>"), field("offsets", "array<int>")], keep, BATCH_BYTES)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Bytes of each row's ids (null ids: null); other columns pass through."""
    others = [c for c in encoded.columns if c != out_col]
    schema = T.StructType([encoded.schema[c] for c in others] + [field(out_col, "binary")])
    at = others.index(ids_col)

    def rows(batches):
        own = codec(ranks_path)
        for batch in batches:
            made = [None if ids is None else own.decode(np.array(ids, "<u4").tobytes())
                    for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())],
                                             names=[f.name for f in schema.fields])

    return encoded.select(*others).mapInArrow(rows, schema)


def round_trip(docs: DataFrame, ranks_path: str, text_col: str = "text",
               keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit) and
    decoded_sha256 of encoding and decoding each whole text in one pass, so the ids need not
    leave the task.  Same cases as ``encode``."""
    keep = docs.columns if keep is None else keep
    return map_texts(docs, text_col, partial(_EncodeKernel, ranks_path, True),
                     [field("n_tokens", "long"), field("ids_sha256", "string"),
                      field("decoded_sha256", "string")], keep, BATCH_BYTES)
