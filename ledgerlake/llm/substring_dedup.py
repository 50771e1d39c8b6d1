"""Exact repeated-substring removal by deep-shallow suffix sorting of anchored suffixes.

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else.  Every
such string holds an anchor: the smallest hash among its k-grams.  Equal strings have their
anchors at equal places, so only suffixes at anchors whose k-gram occurs again need sorting.

1. Anchor hashes of all documents are counted; those that occur once are done.
2. The others are sent, with the bytes around them, to the group of their hash.  Each group's
   suffixes are sorted deep-shallow: words of eight bytes order them to a shallow depth (all
   groups of a task together), then blind tries order the groups that still share a prefix.
   The bytes to the left, reversed, are sorted the same way.  From the two orders' common
   prefixes follows, for each distance d, whether the string that starts d bytes before the
   anchor occurs again.  All strings of one anchor overlap in it, so the least and greatest
   such d give the covered run.
3. A hash with more than ``group_cap`` anchors is not sent to one task.  Its suffixes are told
   apart by their whole context first; if at most ``group_cap`` different ones are left they are
   sorted as before.  Otherwise the range of d is halved until they are: a range needs only the
   suffixes that share the bytes common to its strings (its core), is settled when that core
   occurs once (no repeat) or when all the bytes of its strings occur again (all repeat), and
   goes to a task once few enough share its core.

Repeats inside a task are settled there, so copies of a text leave a task once.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import as_bytes, byte_slices, ident, set_arrow_rows
from ledgerlake.session import cut_lineage

LENGTH = 200
KGRAM = 32
#: Anchors of one hash that one task sorts together; more take the counting way.
GROUP_CAP = 16384
#: Bits of the broadcast filter of repeated hashes: a fixed size, whatever the corpus.
FILTER_BITS = 27
CROWDED_BITS = 20
#: Bytes hashed at once, and the bytes ordered by words before tries take over.
SEGMENT = 1 << 18
SHALLOW = 64
#: Suffixes sorted together in a task.
CHUNK_ROWS = 16384
#: Contexts and texts a sending task remembers; then it starts anew and sends a few rows more.
MEMO_ROWS = 1 << 18

_MULT = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


@lru_cache(1)
def _tables():
    """Byte values and the powers of the hash base and of its inverse modulo 2^64."""
    size = SEGMENT + LENGTH + KGRAM + 1
    values = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=np.uint64)
    inverse = pow(_MULT, -1, 1 << 64)
    up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
    up[1:], down[1:] = _U(_MULT), _U(inverse)
    return values, np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def kgram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed polynomial hash of each k-gram of at most a segment's bytes."""
    values, up, down = _tables()
    n = data.size - KGRAM + 1
    total = np.zeros(data.size + 1, np.uint64)
    np.cumsum(values[data] * down[:data.size], dtype=np.uint64, out=total[1:])
    h = (total[KGRAM:] - total[:n]) * up[:n]
    h ^= h >> _U(31)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over each window of ``width`` values, by doubling."""
    have = 1
    while have * 2 <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[:x.size - (width - have)], x[width - have:]) if width > have else x


def _segment_anchors(data: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of anchors; ``whole[i]``: the string that starts at i is in one text."""
    h = kgram_hashes(data)
    order = (h >> _U(33)).astype(np.int64)          # ties make more anchors, equal in equal strings
    width = LENGTH - KGRAM + 1
    low = np.where(whole, _sliding(order, width, np.minimum), -1)
    pad = np.full(width - 1, -1, np.int64)
    high = _sliding(np.concatenate([pad, low, pad]), width, np.maximum)
    at = np.flatnonzero(order == high[:order.size])
    return at, h[at]


def anchors(texts: list[bytes]):
    """Yields (text index, positions, hashes) of the texts that have strings of full length."""
    group: list[int] = []
    held = 0
    for i, t in enumerate(texts):
        if len(t) < LENGTH:
            continue
        if len(t) > SEGMENT:
            yield i, *_long_anchors(t)
            continue
        if held + len(t) > SEGMENT:
            yield from _short_anchors(texts, group)
            group, held = [], 0
        group.append(i)
        held += len(t)
    if group:
        yield from _short_anchors(texts, group)


def _short_anchors(texts: list[bytes], group: list[int]):
    data = np.frombuffer(b"".join([texts[i] for i in group]), np.uint8)
    ends = np.cumsum([len(texts[i]) for i in group])
    starts = ends - [len(texts[i]) for i in group]
    whole = np.ones(data.size - LENGTH + 1, bool)
    for e in ends[:-1].tolist():
        whole[e - LENGTH + 1:e] = False
    at, h = _segment_anchors(data, whole)
    cut = np.searchsorted(at, np.append(starts, data.size))
    for k, i in enumerate(group):
        a, b = cut[k], cut[k + 1]
        yield i, at[a:b] - starts[k], h[a:b]


def _long_anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    found = {}
    step = SEGMENT - LENGTH
    for s in range(0, data.size - LENGTH + 1, step):
        piece = data[s:s + step + LENGTH - 1]
        if piece.size < LENGTH:
            break
        at, h = _segment_anchors(piece, np.ones(piece.size - LENGTH + 1, bool))
        found.update(zip((at + s).tolist(), h.tolist(), strict=True))
    where = np.array(sorted(found), np.int64)
    return where, np.array([found[p] for p in where.tolist()], np.uint64)


# ---------------------------------------------------------------- deep-shallow sorting

def _lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class _Trie:
    """Blind trie: inner nodes keep a depth and their children by the byte there; the bytes that
    are skipped are checked against one leaf after the descent."""

    __slots__ = ("depth", "kids", "leaf")

    def __init__(self, depth: int, leaf: int = -1):
        self.depth, self.kids, self.leaf = depth, None if leaf >= 0 else {}, [leaf] if leaf >= 0 else None


def _byte(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def trie_order(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the strings and the common prefix of each with the one before it (first: 0)."""
    root: _Trie | None = None
    for i, s in enumerate(strings):
        if root is None:
            root = _Trie(len(s), i)
            continue
        node = root
        while node.leaf is None:                       # blind descent
            node = node.kids.get(_byte(s, node.depth)) or next(iter(node.kids.values()))
        other = strings[node.leaf[0]]
        same = _lcp(s, other)
        if same == len(s) == len(other):
            node.leaf.append(i)
            continue
        parent, node, key = None, root, -2
        while node.leaf is None and node.depth < same:
            parent, key = node, _byte(s, node.depth)
            node = node.kids[key]
        if node.leaf is None and node.depth == same:
            node.kids[_byte(s, same)] = _Trie(len(s), i)
            continue
        branch = _Trie(same)
        branch.kids[_byte(other, same)] = node
        branch.kids[_byte(s, same)] = _Trie(len(s), i)
        if parent is None:
            root = branch
        else:
            parent.kids[key] = branch
    order, common = [], []
    stack = [(root, 0)]
    while stack:
        node, shared = stack.pop()
        if node.leaf is not None:
            for j, i in enumerate(node.leaf):
                order.append(i)
                common.append(shared if not j else len(strings[i]))
            continue
        keys = sorted(node.kids)
        stack += [(node.kids[k], shared if j == 0 else node.depth) for j, k in reversed(list(enumerate(keys)))]
    return order, common


def deep_shallow(strings: list[bytes], group: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the strings sorted inside their groups (``group`` ascending), and the
    common prefix length of each with its predecessor in the order (0 at a group's start)."""
    m = len(strings)
    size = np.array([len(s) for s in strings], np.int64)
    padded = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in strings]), np.uint8).reshape(m, width)
    words = np.ascontiguousarray(padded[:, :SHALLOW]).view(">u8").astype(np.uint64)
    # multikey quicksort by words: only rows that are still tied go on to the next word
    order = np.arange(m)
    part = group.astype(np.int64)
    tied = np.arange(m)
    for w in range(words.shape[1]):
        key = words[order[tied], w]
        sub = np.lexsort((key, part[tied]))
        order[tied] = order[tied][sub]
        key, own = key[sub], part[tied]                # equal parts stay contiguous
        new = np.ones(tied.size, bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        head = np.flatnonzero(new)
        label = np.repeat(tied[head], np.diff(np.append(head, tied.size)))
        part = part.copy()
        part[tied] = label + m * (w + 1)
        run = np.diff(np.append(head, tied.size))
        tied = tied[np.repeat(run > 1, run)]
        if not tied.size:
            break
    # blind tries below the shallow depth
    if tied.size:
        head = np.flatnonzero(np.append(True, part[tied][1:] != part[tied][:-1]))
        for a, b in zip(head.tolist(), np.append(head[1:], tied.size).tolist(), strict=True):
            rows = order[tied[a:b]]
            deep, _ = trie_order([strings[i][SHALLOW:] for i in rows.tolist()])
            order[tied[a:b]] = rows[deep]
    common = np.zeros(m, np.int64)
    if m > 1:
        for at in range(1, m, 4096):
            cur, old = order[at:at + 4096], order[at - 1:at - 1 + len(order[at:at + 4096])]
            differ = padded[cur] != padded[old]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
            first = np.minimum(first, np.minimum(size[cur], size[old]))
            common[at:at + 4096] = np.where(group[cur] == group[old], first, 0)
    return order, common


def repeated_range(contexts: list[bytes], left: np.ndarray, weight: np.ndarray, group: np.ndarray):
    """(least, greatest) d per suffix such that the string starting d bytes before its anchor
    occurs again among its group (-1: none).  ``left``: bytes of the context before the anchor;
    ``weight``: how often the whole context occurs; contexts of a group are different."""
    m = len(contexts)
    right_len = np.array([len(c) for c in contexts], np.int64) - left
    most_left = LENGTH - KGRAM
    right = [c[x:] for c, x in zip(contexts, left.tolist(), strict=True)]
    before = [c[:x][::-1] for c, x in zip(contexts, left.tolist(), strict=True)]
    r_order, r_common = deep_shallow(right, group, LENGTH)
    l_order, l_common = deep_shallow(before, group, max(SHALLOW, -(-most_left // 8) * 8))
    start = np.append(True, group[1:] != group[:-1])       # orders keep groups in place
    least, greatest = np.full(m, -1, np.int64), np.full(m, -1, np.int64)
    r_class, l_class = np.empty(m, np.int64), np.empty(m, np.int64)
    for d in range(most_left + 1):
        ok = np.flatnonzero((left >= d) & (right_len >= LENGTH - d))
        if not ok.size:
            continue
        r_class[r_order] = np.cumsum(start | (r_common < LENGTH - d))
        l_class[l_order] = np.cumsum(start | (l_common < d))
        key = r_class[ok] * (m + 1) + l_class[ok]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        again = weight[ok] > 1
        again[by[1:][same]] = True
        again[by[:-1][same]] = True
        rows = ok[again]
        greatest[rows] = d
        least[rows[least[rows] < 0]] = d
    return least, greatest


# ---------------------------------------------------------------- Spark jobs

SENT = "kind int, g long, h long, cid binary, ctx binary, l int, tkey binary, pos int"
_SENT = pa.schema([("kind", pa.int32()), ("g", pa.int64()), ("h", pa.int64()), ("cid", pa.binary()),
                   ("ctx", pa.binary()), ("l", pa.int32()), ("tkey", pa.binary()), ("pos", pa.int32())])
GROUPED, CROWDED, SETTLED = 0, 1, 2


def _slot(h: np.ndarray, bits: int) -> np.ndarray:
    # low bits: anchors are chosen by small high bits
    return (h & _U((1 << bits) - 1)).astype(np.int64)


def _count_anchors(batches):
    for batch in batches:
        for part in byte_slices(batch, 0, 4 << 20):
            found = [h for _, _, h in anchors(as_bytes(part.column(0)))]
            if found:
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])


_PIECE = 14                                             # bits of the index inside a filter piece


def _filter_pieces(bits: int):
    """Bit pieces (piece, packed bits) of the hashes of one task; a piece is in one task only."""
    def run(batches):
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            at = _slot(batch.column(0).to_numpy().view(np.uint64), bits)
            for piece in np.unique(at >> _PIECE).tolist():
                own = pieces.setdefault(piece, np.zeros(1 << _PIECE, bool))
                own[at[(at >> _PIECE) == piece] & ((1 << _PIECE) - 1)] = True
        for piece, own in pieces.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()), pa.array([np.packbits(own).tobytes()])],
                                             names=["piece", "bits"])
    return run


def _filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Packed bit filter of fixed size 2^bits; set bits are a superset of the hashes' slots.  The
    pieces are built in tasks and only the packed bits reach the driver."""
    spread = F.shiftright(F.col("h").bitwiseAND(F.lit((1 << bits) - 1)), _PIECE)
    out = np.zeros(1 << max(bits - 3, 0), np.uint8)
    step = 1 << (_PIECE - 3)
    for r in hashes.repartition(spread).select("h").mapInArrow(
            _filter_pieces(bits), "piece long, bits binary").toLocalIterator():
        at = r["piece"] * step
        out[at:at + step] |= np.frombuffer(r["bits"], np.uint8)
    return out


def _has(packed: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def _send(repeated, crowded, memo_rows: int = MEMO_ROWS):
    """Anchors that may repeat, with their contexts.  While a task remembers it, a context is sent once, and
    once more without its bytes when it occurs again; further occurrences are settled here.  A
    text with copies in the task is settled by one row."""
    def run(batches):
        may, many = repeated.value, crowded.value
        task = TaskContext.get().partitionId()
        seen: dict[bytes, int] = {}
        texts_seen: dict[bytes, bool] = {}             # whether the text is settled
        for batch in batches:
            for part in byte_slices(batch, 0, 4 << 20):
                texts = as_bytes(part.column(0))
                cols = [[] for _ in _SENT.names]
                for i, at, h in anchors(texts):
                    text = texts[i]
                    key = hashlib.md5(text, usedforsecurity=False).digest()
                    if key in texts_seen:              # a copy in this task: its twin says it all
                        if not texts_seen[key]:
                            texts_seen[key] = True
                            _settle(cols, task, key, 0, len(text))
                        continue
                    # forgetting is exact: what occurs again is sent again and counted there
                    if len(texts_seen) >= memo_rows:
                        texts_seen.clear()
                    texts_seen[key] = False
                    some = _has(may, _slot(h, FILTER_BITS))
                    at, h = at[some], h[some]
                    busy = _has(many, _slot(h, CROWDED_BITS)).tolist()
                    for p, x, crowd in zip(at.tolist(), h.view(np.int64).tolist(), busy, strict=True):
                        a, b = max(0, p - LENGTH + KGRAM), min(len(text), p + LENGTH)
                        ctx = text[a:b]
                        cid = hashlib.blake2b(ctx, digest_size=16, key=bytes([p - a])).digest()
                        times = seen.get(cid, 0)
                        if times < 2:
                            if len(seen) >= memo_rows:
                                seen.clear()
                            seen[cid] = times + 1
                            g = int.from_bytes(cid[:8], "little", signed=True) if crowd else x
                            _row(cols, CROWDED if crowd else GROUPED, g, x, cid, ctx if not times else None, p - a, key, p)
                        elif b - a >= LENGTH:
                            _settle(cols, task, key, a, b)
                if cols[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SENT, strict=True)],
                                                     schema=_SENT)
    return run


def _row(cols, *values):
    for c, v in zip(cols, values, strict=True):
        c.append(v)


def _settle(cols, task: int, key: bytes, start: int, end: int):
    """A run that is known to repeat: (text, start, end), end in the column ``l``.  It meets no
    other row, so its ``g`` only spreads the runs of a text over the tasks."""
    g = int.from_bytes(key[:8], "little", signed=True) ^ (task << 32 | start)
    _row(cols, SETTLED, g, 0, None, None, end, key, start)


FOUND = "pending boolean, tkey binary, start int, stop int, h long, cid binary, ctx binary, l int, pos int, alone boolean"
_FOUND = pa.schema([("pending", pa.bool_()), ("tkey", pa.binary()), ("start", pa.int32()), ("stop", pa.int32()),
                    ("h", pa.int64()), ("cid", pa.binary()), ("ctx", pa.binary()), ("l", pa.int32()),
                    ("pos", pa.int32()), ("alone", pa.bool_())])


def _whole_groups(batches, keys: list[str]):
    """Tables of at least CHUNK_ROWS rows (but for the last) that cut no group of equal ``keys``, from
    batches sorted by them.  Each batch is looked at once, however many a group goes through."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)               # a row that starts a group
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        if held:
            last = held[-1]
            new[0] = any(last.column(last.schema.get_field_index(k))[-1].as_py() != c[0] for k, c in zip(keys, cols, strict=True))
        starts = np.flatnonzero(new)
        if starts.size and n + int(starts[-1]) >= CHUNK_ROWS:      # the last group may go on
            cut = int(starts[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, n = [], 0
            batch = batch.slice(cut)
        held.append(batch)
        n += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _sort_groups(batches):
    """Rows sorted by kind, group and context: settles grouped anchors by deep-shallow sorting,
    crowded ones by their whole contexts; a crowded context that is alone stays pending."""
    for rows in _whole_groups(batches, ["kind", "g"]):
        yield from _sort_chunk(rows)


def _sort_chunk(rows: pa.Table):
    col = {n: rows[n].to_pylist() for n in ("cid", "ctx", "tkey")}
    kind, h, pos, l = (rows[n].to_numpy() for n in ("kind", "h", "pos", "l"))
    out = [[] for _ in _FOUND.names]

    def span(i, start, stop):
        _row(out, False, col["tkey"][i], start, stop, None, None, None, None, None, None)

    for i in np.flatnonzero(kind == SETTLED).tolist():
        span(i, int(pos[i]), int(l[i]))
    live = np.flatnonzero(kind != SETTLED).tolist()
    # one suffix a context, with how often it occurs; the sort puts equal contexts together
    first: dict[tuple, int] = {}
    reps, weight, member = [], [], {}
    for i in live:
        key = (int(kind[i]), int(h[i]), col["cid"][i])
        at = first.get(key)
        if at is None:
            at = first[key] = len(reps)
            reps.append(i)
            weight.append(0)
        if col["ctx"][reps[at]] is None and col["ctx"][i] is not None:
            reps[at] = i
        weight[at] += 1
        member.setdefault(at, []).append(i)
    size = [len(col["ctx"][i]) for i in reps]
    sortable = [a for a, i in enumerate(reps) if kind[i] == GROUPED]
    sortable.sort(key=lambda a: int(h[reps[a]]))
    if sortable:
        pick = [reps[a] for a in sortable]
        _, group = np.unique(h[pick], return_inverse=True)
        w = np.array([weight[a] for a in sortable], np.int64)
        n_in = np.bincount(group)
        many = (n_in[group] > 1) | (w > 1)             # a lone context that occurs once is no repeat
        pick = [i for i, x in zip(pick, many.tolist(), strict=True) if x]
        if pick:
            least, greatest = repeated_range([col["ctx"][i] for i in pick], l[pick].astype(np.int64), w[many], group[many])
            owners = [a for a, x in zip(sortable, many.tolist(), strict=True) if x]
            for a, lo, hi in zip(owners, least.tolist(), greatest.tolist(), strict=True):
                if hi >= 0:
                    for i in member[a]:
                        span(i, int(pos[i]) - hi, int(pos[i]) - lo + LENGTH)
    for a, i in enumerate(reps):
        if kind[i] != CROWDED:
            continue
        if weight[a] > 1 and size[a] >= LENGTH:
            for j in member[a]:
                span(j, int(pos[j]) - int(l[j]), int(pos[j]) - int(l[j]) + size[a])
        # settled contexts stay as partners of the others
        _row(out, True, col["tkey"][i], None, None, int(h[i]), col["cid"][i], col["ctx"][i], int(l[i]), int(pos[i]),
             weight[a] == 1)
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _FOUND, strict=True)], schema=_FOUND)


_RANGES = "tkey binary, pos int, h long, ctx binary, l int, alone boolean, x int, y int, g long, hull binary"


def _halves(batches):
    """Each row's range [x, y) of d in two halves, clipped to what its text allows, with a key of
    the bytes all strings of a half share (g) and the digest of all bytes they span (hull)."""
    for batch in batches:
        out = [[] for _ in range(10)]
        for r in batch.to_pylist():
            x, y, ctx, l = r["x"], r["y"], r["ctx"], r["l"]
            mid, right = (x + y) // 2, len(ctx) - l
            for a, b in ((x, mid), (mid, y)):
                if a >= b or max(a, LENGTH - right) > min(b - 1, l):
                    continue                           # no string of this range fits the text
                tag = f"{r['h']}:{a}:{b}".encode()
                core = hashlib.blake2b(ctx[l - a:l - (b - 1) + LENGTH], digest_size=8, key=tag).digest()
                full = l >= b - 1 and right >= LENGTH - a
                hull = hashlib.blake2b(ctx[l - (b - 1):l - a + LENGTH], digest_size=16, key=tag).digest() if full else None
                _row(out, r["tkey"], r["pos"], r["h"], ctx, l, r["alone"], a, b,
                     int.from_bytes(core, "little", signed=True), hull)
        kinds = (pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(),
                 pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                         names=[c.split()[0] for c in _RANGES.split(", ")])


def _sort_cores(batches):
    """Deep-shallow sorting of different contexts, rows sorted by ``g``: (tkey, pos, lo, hi)."""

    def settle(rows: pa.Table):
        group = np.unique(rows["g"].to_numpy(), return_inverse=True)[1]
        alone = rows["alone"].to_numpy(zero_copy_only=False).astype(bool)
        least, greatest = repeated_range(rows["ctx"].to_pylist(), rows["l"].to_numpy().astype(np.int64),
                                         np.where(alone, 1, 2), group)
        keep = np.flatnonzero(alone & (greatest >= 0))
        return pa.RecordBatch.from_arrays(
            [rows["tkey"].take(pa.array(keep)).combine_chunks(), rows["pos"].take(pa.array(keep)).combine_chunks(),
             pa.array(least[keep].astype(np.int32)), pa.array(greatest[keep].astype(np.int32))],
            names=["tkey", "pos", "lo", "hi"])

    for rows in _whole_groups(batches, ["g"]):
        yield settle(rows)


def _crowded_spans(pending: DataFrame, group_cap: int) -> DataFrame:
    """Runs (tkey, start, stop) of pending anchors: groups of few different contexts are sorted,
    the ranges of d of larger ones halved until the groups of their cores are few."""
    rows = pending.select("tkey", "pos", "h", "ctx", "l", "alone", F.lit(0).alias("x"),
                          F.lit(LENGTH - KGRAM + 1).alias("y"), F.col("h").alias("g"), F.lit(None).cast("binary").alias("hull"))
    done = None
    while True:
        cores = cut_lineage(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("alone").alias("open"))
                            .where("n > 1 and open").select("g", "n"), "substr-cores")
        few = rows.join(cores.where(F.col("n") <= group_cap), "g", "left_semi")
        found = cut_lineage(few.select("g", "tkey", "pos", "ctx", "l", "alone").repartition("g").sortWithinPartitions("g")
                            .mapInArrow(_sort_cores, "tkey binary, pos int, lo int, hi int"), "substr-sorted")
        done = found if done is None else done.unionByName(found)
        crowded = cores.where(F.col("n") > group_cap)
        if crowded.isEmpty():
            break
        many = rows.join(crowded, "g", "left_semi")
        again = cut_lineage(many.where("hull is not null").groupBy("hull").agg(F.count(F.lit(1)).alias("n"))
                            .where("n > 1").select("hull", F.lit(True).alias("all")), "substr-hulls")
        many = cut_lineage(many.join(again, "hull", "left").withColumn("all", F.coalesce("all", F.lit(False))), "substr-open")
        done = done.unionByName(many.where("alone and all")
                                .select("tkey", "pos", F.col("x").alias("lo"), (F.col("y") - 1).alias("hi")))
        # settled ones go on as partners; a range of one d is settled either way
        rows = cut_lineage(many.where("y - x > 1").withColumn("alone", F.col("alone") & ~F.col("all"))
                           .select("tkey", "pos", "h", "ctx", "l", "alone", "x", "y").mapInArrow(_halves, _RANGES),
                           "substr-halves")
    return (done.groupBy("tkey", "pos").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .select("tkey", (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + LENGTH).alias("stop")))


def _cut(batches):
    """Merges each text's runs and removes them."""
    for batch in batches:
        texts = as_bytes(batch.column(1))
        n, removed, spans, kept, left = [], [], [], [], []
        for text, runs in zip(texts, batch.column(2).to_pylist(), strict=True):
            merged: list[list[int]] = []
            for s, e in sorted((r["start"], r["stop"]) for r in runs or ()):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            parts, at = [], 0
            for s, e in merged:
                parts.append(text[at:s])
                at = e
            rest = b"".join([*parts, text[at:]])
            n.append(len(text))
            removed.append(len(text) - len(rest))
            spans.append(merged)
            kept.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.list_(pa.list_(pa.int32()))), pa.array(kept, pa.string())],
            names=["id", "n_bytes", "n_removed", "removed", "kept_sha256"])


def repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        group_cap: int = GROUP_CAP, memo_rows: int = MEMO_ROWS) -> DataFrame:
    """One row per document: ``id_col``, n_bytes, n_removed, removed (maximal runs [start, end) of
    removed bytes) and kept_sha256 of the bytes that stay.

    Texts are UTF-8 bytes; null counts as empty; texts shorter than the string length lose
    nothing; repeated rows are documents of their own and so repeats of each other; ids may be
    null or repeat; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    set_arrow_rows(spark)
    sc = spark.sparkContext
    rows = docs.select(ident(id_col).alias("id"), F.coalesce(ident(text_col).cast("string"), F.lit("")).alias("t"))
    counted = (rows.select("t").mapInArrow(_count_anchors, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
               .where("n > 1"))
    counted = cut_lineage(counted, "substr-anchors")
    may = sc.broadcast(_filter(counted.select("h"), FILTER_BITS))
    many = sc.broadcast(_filter(counted.where(F.col("n") > group_cap).select("h"), CROWDED_BITS))
    sent = rows.select("t").mapInArrow(_send(may, many, memo_rows), SENT)
    found = cut_lineage(sent.repartition("g").sortWithinPartitions("kind", "g", "cid")
                        .mapInArrow(_sort_groups, FOUND), "substr-found")
    spans = found.where("not pending").select("tkey", "start", "stop")
    pending = found.where("pending")
    if not pending.where("alone").isEmpty():
        spans = spans.unionByName(_crowded_spans(pending, group_cap))
    by_text = cut_lineage(spans.groupBy("tkey").agg(F.collect_set(F.struct("start", "stop")).alias("runs")), "substr-runs")
    placed = (rows.withColumn("tkey", F.unhex(F.md5("t"))).join(by_text, "tkey", "left").select("id", "t", "runs"))
    cut = placed.mapInArrow(_cut, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, "
                                  "removed array<array<int>>, kept_sha256 string")
    return cut.withColumnRenamed("id", id_col)
