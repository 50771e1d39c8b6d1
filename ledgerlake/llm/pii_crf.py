"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans (email, ip, card, phone).  The field labels every candidate
token of a document (a run of non-space characters holding a digit or an at sign) with a kind
or none.  Potentials: a unary one by token shape, a chain one between neighbouring candidates,
and a skip one between distant tokens that are repeated or similar: tokens that share a key
(equal digits, equal last eight digits, equal mail address start, or equal text).  A key's
occurrences are linked to the first one that a base span covers, or, where there is none, one to the
next: skip edges stay linear in repeats, and evidence does not fade with their number.  Tokens under a base span
are observed, and so is every base span as a whole, which a number written in one piece repeats.
Marginals come from damped loopy sum-product, document by document.  A token that no base span
touches becomes an added span when its marginal for a kind is at least ``min_marginal`` and skip
edges tie it, directly or through others, to an observed one.  A document without base spans has
no evidence and needs no messages.

Potentials are log-linear in indicator features and are estimated, smoothed, from the labels the
patterns give: the unary one on all documents, the pairwise ones on all that hold a base span.  A
token that repeats personal data without matching a pattern has no label there and is not counted.
Only counts by shape and label reach the driver.
"""

from __future__ import annotations

import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import SLICE_BYTES, as_text, byte_slices, field, ident, map_texts, set_arrow_rows

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)                       # label of tokens that are no personal data
LABELS = NONE + 1
#: Hash buckets of shapes, least marginal of a span.
SHAPES = 1024
MIN_MARGINAL = 0.9
#: Most rounds of messages, and the change of a document's messages that ends them.
ROUNDS = 25
SETTLED = 1e-3
#: Log potential of every other label of an observed node; outweighs messages of any number of edges.
FIXED = -1e9
#: Edges whose messages are renewed together.
EDGE_BLOCK = 1 << 15
#: Weight of skip associations against chain associations; most that a shape says against a kind.
SKIP_WEIGHT = 2.0
SHAPE_BOUND = 6.0
#: Characters or digits that a token needs to be tied to others; digits of a similar number's end.
KEY_CHARS = 6
TAIL_DIGITS = 8

_MAIL_START = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_MAIL_REST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive runs: a digit run taken back never helps these patterns, and long runs stay linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"\S+")
_CLUE = re.compile(r"[0-9@]")
_EDGES = ".,;:!?\"'()[]{}<>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches of a local part, an at sign and a dotted domain.  The local part is the
    run before the sign, cut at the last match, so each sign is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _MAIL_START:
            start -= 1
        rest = _MAIL_REST.match(text, at + 1) if start < at else None
        if rest:
            done = rest.end()
            yield start, done
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of all pattern matches that pass their checks, in order."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


class _CharClass(dict):
    """Code point -> "0" for digits, "a" for letters, else itself."""

    def __missing__(self, cp: int) -> str:
        c = chr(cp)
        kind = self[cp] = "0" if "0" <= c <= "9" else "a" if c.isalpha() else c
        return kind


_CLASS = _CharClass()
_RUN = re.compile(r"(.)\1*+", re.S)


def shape(token: str) -> int:
    """Bucket of a token's class pattern: letters, digits with run lengths, other characters."""
    runs = _RUN.sub(lambda m: f"0{m.end() - m.start()}" if m.group(1) == "0" else m.group(1), token.translate(_CLASS))
    return zlib.crc32(runs.encode("utf-8", "surrogatepass")) % SHAPES


def similarity_keys(token: str) -> list[str]:
    """Tokens that share a key are repeated or similar: same digits, same last digits, same start
    of a mail address, else the same text without outer punctuation; short ones have none."""
    if "@" in token:
        start = token[:token.index("@")].strip(_EDGES).lower()
        return ["@" + start] if start else []
    digits = _NOT_DIGIT.sub("", token)
    if 2 * len(digits) >= len(token):
        out = ["#" + digits] if len(digits) >= KEY_CHARS else []
        return out + ["~" + digits[-TAIL_DIGITS:]] if len(digits) >= TAIL_DIGITS else out
    core = token.strip(_EDGES).lower()
    return ["=" + core] if len(core) >= KEY_CHARS else []


@dataclass
class Graph:
    """Candidate tokens of a document, then its base spans as nodes of their own, and edges."""

    start: np.ndarray
    end: np.ndarray
    shape: np.ndarray
    observed: np.ndarray         # label, or -1
    chain: np.ndarray            # pairs of neighbours in text order
    skip: np.ndarray             # pairs of tokens that share a key
    tied: np.ndarray             # whether skip edges lead to an observed node


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return np.stack([first, second], axis=1).astype(np.int64) if first.size else np.zeros((0, 2), np.int64)


def _links(key: np.ndarray, node: np.ndarray, observed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Skip edges of (key, node) rows, and the nodes they tie to an observed one."""
    tied = observed >= 0
    if not key.size:
        return _pairs(key, key), tied
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.ones(key.size, bool)
    new[1:] = key[1:] != key[:-1]
    group = np.cumsum(new) - 1
    groups = int(group[-1]) + 1
    first = np.full(groups, n, np.int64)
    seen = observed[node] >= 0
    np.minimum.at(first, group[seen], node[seen])
    star = (first[group] < n) & (first[group] != node)
    line = ~new[1:] & (first[group[1:]] == n)
    a = np.concatenate([node[:-1][line], first[group[star]]])
    b = np.concatenate([node[1:][line], node[star]])
    edges = np.unique(np.minimum(a, b) * n + np.maximum(a, b))
    while True:
        held = np.zeros(groups, bool)
        held[group[tied[node]]] = True
        more = held[group] & ~tied[node]
        if not more.any():
            return _pairs(edges // n, edges % n), tied
        tied[node[more]] = True


def build(text: str, base: list[tuple[int, int, int]]) -> Graph:
    start, end, shapes, observed, key, node = (array("q") for _ in range(6))

    def tie(me: int, token: str) -> None:
        for k in similarity_keys(token):
            key.append(xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass")) >> 1)
            node.append(me)

    by_end = 0
    for m in _TOKEN.finditer(text) if _CLUE.search(text) else ():
        token = m.group()
        if not _CLUE.search(token):
            continue
        s, e = m.span()
        core = token.strip(_EDGES)
        if core:
            s += len(token) - len(token.lstrip(_EDGES))
            e = s + len(core)
        # spans of a kind do not overlap; those of all kinds over this token are few
        while by_end < len(base) and base[by_end][2] <= s:
            by_end += 1
        label = -1
        for a, k, b in base[by_end:]:
            if a >= e:
                break
            if b > s:
                label = k
                break
        tie(len(start), token)
        start.append(s)
        end.append(e)
        shapes.append(shape(token))
        observed.append(label)
    tokens = len(start)
    for a, k, b in base:
        tie(len(start), text[a:b])
        start.append(a)
        end.append(b)
        shapes.append(0)
        observed.append(k)
    whole = lambda x: np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64)
    observed = whole(observed)
    skip, tied = _links(whole(key), whole(node), observed, len(start))
    i = np.arange(max(tokens - 1, 0))
    return Graph(whole(start), whole(end), whole(shapes), observed, _pairs(i, i + 1), skip, tied)


@dataclass
class Field:
    unary: np.ndarray            # shapes x labels, log potentials
    chain: np.ndarray            # labels x labels
    skip: np.ndarray

    def marginals(self, g: Graph) -> np.ndarray:
        """Label marginals of all nodes by damped loopy sum-product."""
        n = g.observed.size
        own = self.unary[g.shape].astype(np.float32)
        seen = np.flatnonzero(g.observed >= 0)
        own[seen] = FIXED
        own[seen, g.observed[seen]] = 0.0
        # messages along and against each edge; the potentials are shared by all edges of a kind
        sets = [(edges, np.exp(psi).astype(np.float32), np.zeros((2, len(edges), LABELS), np.float32))
                for edges, psi in ((g.chain, self.chain), (g.skip, self.skip)) if len(edges)]
        belief = own
        for _ in range(ROUNDS if sets else 0):
            belief = own.copy()
            for edges, _psi, msg in sets:
                for way in (0, 1):
                    for k in range(LABELS):
                        belief[:, k] += np.bincount(edges[:, 1 - way], msg[way, :, k], n)
            change = max(_renew(edges, psi, msg, belief) for edges, psi, msg in sets)
            if change < SETTLED:
                break
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def _renew(edges: np.ndarray, psi: np.ndarray, msg: np.ndarray, belief: np.ndarray) -> float:
    """Half a step of all messages of a set of edges, block by block; the greatest change."""
    change = 0.0
    for lo in range(0, len(edges), EDGE_BLOCK):
        part = slice(lo, lo + EDGE_BLOCK)
        ends = edges[part]
        made = []
        for way, table in ((0, psi), (1, psi.T)):
            out = belief[ends[:, way]] - msg[1 - way, part]
            out = np.exp(out - out.max(axis=1, keepdims=True)) @ table
            made.append(np.log(out / out.sum(axis=1, keepdims=True) + np.float32(1e-30)))
        for way in (0, 1):
            change = max(change, float(np.abs(made[way] - msg[way, part]).max()))
            msg[way, part] = 0.5 * (msg[way, part] + made[way])
    return change


def added_spans(text: str, base: list[tuple[int, int, int]], model: Field,
                min_marginal: float = MIN_MARGINAL) -> list[tuple[int, int, int]]:
    """Spans that the field adds to the base spans of a text."""
    if not base:
        return []
    g = build(text, base)
    free = g.tied & (g.observed < 0)
    if not free.any():
        return []
    p = model.marginals(g)
    best = p[:, :NONE].argmax(axis=1)
    sure = free & (p[np.arange(best.size), best] >= min_marginal)
    return [(int(g.start[i]), int(best[i]), int(g.end[i])) for i in np.flatnonzero(sure).tolist()]


def find_spans(texts: list[str], model: Field, min_marginal: float = MIN_MARGINAL):
    """Per text: base spans and added spans, each (start, kind index, end) in order."""
    base = [base_spans(t) for t in texts]
    return base, [added_spans(t, b, model, min_marginal) for t, b in zip(texts, base, strict=True)]


def label_counts(texts: list[str]) -> np.ndarray:
    """How often each shape has each label, then label pairs of chain and of skip edges."""
    counts = np.zeros(SHAPES * LABELS + 2 * LABELS * LABELS, np.int64)
    for text in texts:
        base = base_spans(text)
        if not base:                        # all tokens are none
            found = [shape(t) for t in _TOKEN.findall(text) if _CLUE.search(t)] if _CLUE.search(text) else []
            if found:
                np.add.at(counts, np.array(found) * LABELS + NONE, 1)
            continue
        g = build(text, base)
        label = np.where(g.observed < 0, NONE, g.observed)
        known = (g.observed >= 0) | ~g.tied
        own = np.flatnonzero(known[:label.size - len(base)])
        np.add.at(counts, g.shape[own] * LABELS + label[own], 1)
        for k, edges in enumerate((g.chain, g.skip)):
            edges = edges[known[edges].all(axis=1)]
            np.add.at(counts, SHAPES * LABELS + k * LABELS * LABELS + label[edges[:, 0]] * LABELS + label[edges[:, 1]], 1)
    return counts


def train(docs: DataFrame, text_col: str = "text") -> Field:
    """Potentials from the pattern labels of all documents; a fixed number of counts reaches the driver."""
    set_arrow_rows(docs.sparkSession)

    def run(batches):
        total = np.zeros(SHAPES * LABELS + 2 * LABELS * LABELS, np.int64)
        for batch in batches:
            for part in byte_slices(batch, 0, SLICE_BYTES):
                total += label_counts(as_text(part.column(0)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["at", "n"])

    rows = docs.select(ident(text_col).cast("string").alias("text")).mapInArrow(run, "at int, n long")
    counts = np.zeros(SHAPES * LABELS + 2 * LABELS * LABELS)
    for r in rows.groupBy("at").agg(F.sum("n").alias("n")).collect():        # bounded index
        counts[r["at"]] = r["n"]
    unary = counts[:SHAPES * LABELS].reshape(SHAPES, LABELS)
    prior = unary.sum(axis=0) + np.array([0.1] * NONE + [10.0])
    prior /= prior.sum()
    unary = np.log((unary + prior) / (unary.sum(axis=1, keepdims=True) + 1.0))
    unary[:, :NONE] = np.maximum(unary[:, :NONE], unary[:, NONE:] - SHAPE_BOUND)
    chain, skip = counts[SHAPES * LABELS:].reshape(2, LABELS, LABELS)
    return Field(unary, _association(chain, 1.0, 0.0), SKIP_WEIGHT * _association(skip, 1.0, 100.0))


def _association(pairs: np.ndarray, smooth: float, agree: float) -> np.ndarray:
    """Log association of the labels at the two ends, bounded to a factor of e^3 either way;
    ``agree`` pseudo-pairs of equal labels are the prior of edges that tie similar tokens."""
    joint = pairs + pairs.T + smooth + agree * np.eye(LABELS)
    joint /= joint.sum()
    side = joint.sum(axis=1)
    return np.clip(np.log(joint) - np.log(side[:, None] * side[None, :]), -3.0, 3.0)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every maximal covered run replaced by its first span's kind in brackets."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
        i += 1
    return "".join([*out, text[at:]])


class _SpanKernel:
    def __init__(self, model: Field, min_marginal: float, mask: bool):
        self.model, self.least, self.mask = model, min_marginal, mask

    def __call__(self, values: pa.Array):
        texts = as_text(values)
        base, added = find_spans(texts, self.model, self.least)
        both = [sorted(b + a) for b, a in zip(base, added, strict=True)]
        if self.mask:
            return [[None if gone else masked(t, s) for t, s, gone in
                     zip(texts, both, values.is_null().to_pylist(), strict=True)]]
        rows = lambda spans: [[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in x] for x in spans]
        return rows(base), rows(both)


_SPANS = "array<struct<start:int,kind:string,end:int>>"


class _Make:
    """Picklable kernel factory."""

    def __init__(self, *args):
        self.args = args

    def __call__(self):
        return _SpanKernel(*self.args)


def spans(docs: DataFrame, model: Field, text_col: str = "text", keep: list[str] | None = None,
          min_marginal: float = MIN_MARGINAL) -> DataFrame:
    """``keep`` columns (default: all) with ``base`` and ``spans`` (base and added), arrays of
    (start, kind, end) in code points, end exclusive, ordered by start and kind.

    Null and empty texts have none; repeated rows are labelled each; an empty table gives an
    empty result; kept columns named like the output are replaced.
    """
    keep = docs.columns if keep is None else keep
    return map_texts(docs, text_col, _Make(model, min_marginal, False),
                     [field("base", _SPANS), field("spans", _SPANS)], keep)


def mask(docs: DataFrame, model: Field, text_col: str = "text", min_marginal: float = MIN_MARGINAL) -> DataFrame:
    """The documents, columns in order, with every span of the text replaced by its kind in
    brackets; null texts stay null."""
    others = [c for c in docs.columns if c != text_col]
    made = map_texts(docs, text_col, _Make(model, min_marginal, True), [field(text_col, "string")], others)
    return made.select(*[ident(c) for c in docs.columns])
