"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

Terms (words, word shapes and a few repetition counts) are hashed to a fixed number of
buckets.  A bounded, seeded sample of labelled rows gives inverse document frequencies and a
truncated singular value decomposition (randomised range finder); the labelled vectors, at
most ``max_train`` of them, are broadcast with the projection.  Every document is projected
whole and compared with all labelled vectors in exact blocked cosine products; the ``k``
nearest labels vote, weighted by similarity.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import as_text, field, ident, map_texts
from ledgerlake.session import cut_lineage

#: Bound of the labelled sample the model is fitted on and that is broadcast.
MAX_TRAIN = 4096
#: Hash buckets of terms, latent dimensions, voting neighbours.
BUCKETS = 4096
DIMS = 64
NEIGHBOURS = 15
#: Scores from here on keep a document.
KEEP_SCORE = 0.3
#: Documents per cosine block, characters of the words whose buckets a task remembers.
BLOCK = 512
MEMO_CHARS = 8 << 20
#: Whole units of weights, axes and latent vectors: products of whole numbers add up exactly in any
#: order, so a document's score does not depend on the batch it is in.
WEIGHT_UNITS = 1 << 16
AXIS_UNITS = 1 << 20
#: Cosines are compared in whole millionths, so that equal ones are ties.
COSINE_UNITS = 1_000_000
#: Columns that count repetition instead of words, and the weight of their shares.
STRUCTURE = 4
STRUCTURE_WEIGHT = 1.5

_RUNS = re.compile(r"(.)\1+", re.S)


class _CharClass(dict):
    """Code point -> its class letter: upper, lower or other letter, digit, else itself."""

    def __missing__(self, cp: int) -> str:
        c = chr(cp)
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        self[cp] = kind
        return kind


_CLASS = _CharClass()


class Terms:
    """Dense term counts of texts: two buckets a word (the word itself and its shape, runs of a
    class collapsed), and in the last columns adjacent repeats, repeated lines, words, lines."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.words = buckets - STRUCTURE
        self.memo: dict[str, int] = {}
        self.held = 0                                   # characters in the memo
        self.pairs = np.zeros((1024, 2), np.int64)

    def _ids(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        if self.held > MEMO_CHARS:
            memo.clear()
            self.held = 0
            self.pairs = np.zeros((1024, 2), np.int64)
        new = set(words).difference(memo)
        if new:
            self.held += sum(map(len, new))
            need = len(memo) + len(new)
            if need > len(self.pairs):
                self.pairs = np.concatenate([self.pairs, np.zeros((2 * need - len(self.pairs), 2), np.int64)])
            for w in new:
                at = memo[w] = len(memo)
                shape = _RUNS.sub(r"\1", w.translate(_CLASS))
                self.pairs[at] = (zlib.crc32(w.encode()) % self.words,
                                  zlib.crc32(b"shape " + shape.encode()) % self.words)
        return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))

    def counts(self, texts: list[str]) -> np.ndarray:
        split = [t.split() for t in texts]
        size = np.array([len(w) for w in split], np.int64)
        ids = self._ids([w for words in split for w in words])
        row = np.repeat(np.arange(len(texts)), size) * self.buckets
        both = self.pairs[ids] + row[:, None]
        out = np.bincount(both.ravel(), minlength=len(texts) * self.buckets).astype(np.float32)
        out = out.reshape(len(texts), self.buckets)
        if ids.size:
            same = (ids[1:] == ids[:-1]) & (row[1:] == row[:-1])
            out[:, self.words] = np.bincount(row[1:][same] // self.buckets, minlength=len(texts))
        lines = [t.split("\n") for t in texts]
        out[:, self.words + 1] = [len(x) - len(set(x)) for x in lines]
        out[:, self.words + 2] = size
        out[:, self.words + 3] = [len(x) for x in lines]
        return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit rows of log term counts times idf, with the shares of repeated neighbours and
    repeated lines beside them."""
    words = counts.shape[1] - STRUCTURE
    x = np.zeros(counts.shape, np.float32)
    np.log1p(counts[:, :words], out=x[:, :words])
    x[:, :words] *= idf[:words]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    x[:, words] = STRUCTURE_WEIGHT * counts[:, words] / np.maximum(counts[:, words + 2], 1)
    x[:, words + 1] = STRUCTURE_WEIGHT * counts[:, words + 1] / np.maximum(counts[:, words + 3], 1) * (counts[:, words + 2] > 0)
    return x


@dataclass
class Model:
    idf: np.ndarray          # buckets
    axes: np.ndarray         # buckets x dims, whole units
    vectors: np.ndarray      # labelled x dims, unit length in whole units
    labels: np.ndarray       # labelled, 0..1
    prior: float
    k: int

    def project(self, counts: np.ndarray) -> np.ndarray:
        """Unit latent vectors in whole units; zero rows stay zero."""
        z = np.rint(weighted(counts, self.idf).astype(np.float64) * WEIGHT_UNITS) @ self.axes
        size = np.linalg.norm(z, axis=1, keepdims=True)
        return np.rint(np.divide(z, size, out=np.zeros_like(z), where=size > 0) * AXIS_UNITS)

    def cosines(self, counts: np.ndarray) -> np.ndarray:
        """Cosines with all labelled vectors, in whole millionths."""
        return np.rint(self.project(counts) @ self.vectors.T * (COSINE_UNITS / AXIS_UNITS**2)).astype(np.int64)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior, np.float64)
        if not len(self.labels):
            return out
        n = len(self.labels)
        k = min(self.k, n)
        place = np.arange(n)
        for at in range(0, len(counts), BLOCK):
            cos = self.cosines(counts[at:at + BLOCK])
            # one key of cosine and place: ties fall to the earlier labelled vector
            near = np.argpartition(place - cos * n, k - 1, axis=1)[:, :k]
            near.sort(axis=1)
            weight = np.maximum(np.take_along_axis(cos, near, axis=1), 0)
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1)
            some = total > 0
            out[at:at + BLOCK][some] = vote[some] / total[some]
        return np.clip(out, 0.0, 1.0)


def fit(counts: np.ndarray, labels: np.ndarray, dims: int = DIMS, k: int = NEIGHBOURS, seed: int = 7) -> Model:
    """Model of a bounded labelled sample (rows of term counts)."""
    n, buckets = counts.shape
    if not n:
        return Model(np.ones(buckets, np.float32), np.zeros((buckets, 1)),
                     np.zeros((0, 1)), labels.astype(np.float64), 0.5, k)
    idf = np.log((1.0 + n) / (1.0 + (counts > 0).sum(axis=0))).astype(np.float32) + 0.1
    x = weighted(counts, idf)
    dims = min(dims, n, buckets)
    q = np.random.default_rng(seed).standard_normal((buckets, min(dims + 16, n, buckets))).astype(np.float32)
    for _ in range(4):
        q, _r = np.linalg.qr(x.T @ (x @ q))
    _u, _s, vt = np.linalg.svd(x @ q, full_matrices=False)
    axes = np.rint((q @ vt.T)[:, :dims].astype(np.float64) * AXIS_UNITS)
    model = Model(idf, np.ascontiguousarray(axes), np.zeros((0, dims)), labels.astype(np.float64), float(labels.mean()), k)
    model.vectors = model.project(counts)
    return model


class _CountKernel:
    """Sparse counts of the labelled sample (indices, values)."""

    def __init__(self, buckets: int):
        self.terms = Terms(buckets)

    def __call__(self, values: pa.Array):
        at, n = [], []
        texts = as_text(values)
        for start in range(0, len(texts), BLOCK):
            for row in self.terms.counts(texts[start:start + BLOCK]):
                i = np.flatnonzero(row)
                at.append(i.astype(np.int32))
                n.append(row[i])
        return at, n


class _ScoreKernel:
    def __init__(self, model, buckets: int):
        self.model, self.terms = model.value, Terms(buckets)

    def __call__(self, values: pa.Array):
        texts = as_text(values)
        out = [self.model.scores(self.terms.counts(texts[at:at + BLOCK])) for at in range(0, len(texts), BLOCK)]
        return [np.concatenate(out)]


def held_out(id_col: str):
    """Ids never learnt from: crc32 of the id as text is divisible by 5 (a null id is not)."""
    return F.coalesce(F.crc32(ident(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_rows(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return labels.where(~held_out(id_col))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_train: int = MAX_TRAIN, buckets: int = BUCKETS) -> Model:
    """Fit on at most ``max_train`` labelled ids, those of smallest seeded hash.  Null ids and
    null labels are left out, repeated labels of an id are averaged; only term counts of the
    sample reach the driver (at most ``buckets`` numbers a row)."""
    chosen = (labels.where(ident(id_col).isNotNull() & ident(label_col).isNotNull())
              .groupBy(ident(id_col).alias("__llm_id")).agg(F.avg(ident(label_col).cast("double")).alias("__llm_label"))
              .orderBy(F.xxhash64("__llm_id"), "__llm_id").limit(max_train))
    chosen = cut_lineage(chosen, "quality-sample")
    found = docs.select(ident(id_col).alias("__llm_id"), ident(text_col).alias("text")).join(
        F.broadcast(chosen), "__llm_id")       # at most max_train rows
    rows = map_texts(found, "text", partial(_CountKernel, buckets),
                     [field("at", "array<int>"), field("n", "array<float>")], ["__llm_id", "__llm_label"])
    got = rows.groupBy("__llm_id").agg(F.first("__llm_label").alias("label"), F.min_by("at", F.xxhash64("at")).alias("at"),
                                       F.min_by("n", F.xxhash64("at")).alias("n")).toArrow()
    order = np.argsort(got["__llm_id"].to_numpy())
    counts = np.zeros((len(order), buckets), np.float32)
    for row, i in enumerate(order.tolist()):
        counts[row, got["at"][i].values.to_numpy()] = got["n"][i].values.to_numpy()
    return fit(counts, got["label"].to_numpy()[order])


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
          out_col: str = "score") -> DataFrame:
    """``keep`` columns (default: all) with ``out_col``, a score in 0..1, higher for label 1.

    Null, empty and word-free texts resemble nothing and score the share of label 1 in the
    sample; without labelled rows every score is 0.5; repeated rows score alike, whatever batch
    they are in; neighbours of equal cosine (in whole millionths) are taken by id; an empty table gives an empty result; a kept
    column named like the output is replaced.
    """
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)   # bounded by max_train and buckets
    return map_texts(docs, text_col, partial(_ScoreKernel, shared, model.idf.size),
                     [field(out_col, "double")], keep)
