"""Near-duplicate vectors by product quantisation over coarse inverted lists.

A coarse quantiser (k-means on a bounded sample) deals every vector to the list of its nearest
centroid; its residual is stored as one byte a subspace, with the length of what the codes
miss.  A query reads the lists whose bisector with its own list is within the threshold distance
of it, gets asymmetric distances from per-subspace look-up tables, and keeps an entry unless its
distance minus the stored error is over the threshold distance.  What is kept is re-ranked by
exact cosine in double precision.

Both steps are lossless for any vectors: the way between two vectors of different lists crosses
the bisector, so a link is never longer than the way to it; the codes obey the triangle
inequality.  Every pair of lists is read from one side only (the lower list queries the higher),
so a pair is counted once for both ends.

Equal vectors are one class with a count.  Neighbouring lists share a cell of about one block, so
a query travels once a cell, not once a list.  Cells are cut into blocks of bounded size, each pair
of blocks is one group of a cogrouped job, and a group returns per vector a link count and its
smallest linked vector in the group: never pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import connected_components, ident, set_arrow_rows
from ledgerlake.session import cut_lineage

MIN_COSINE = 0.95
#: Vectors and bytes of the sample the quantisers are fitted on.
TRAIN_ROWS = 16384
TRAIN_BYTES = 64 << 20
#: Vectors a list holds on average, and the most lists.
LIST_ROWS = 128
MAX_LISTS = 1024
SUBSPACES = 8
CODES = 256
ROUNDS = 6
#: Entries and queries of one block.
ENTRY_BLOCK = 4096
QUERY_BLOCK = 2048


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    # scaled by a power of two first (exact), so that no square leaves the range of a double
    _, exponent = np.frexp(np.abs(v).max(axis=1, initial=0.0, keepdims=True))
    v = np.ldexp(v, -exponent)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres ** 2).sum(axis=1) / 2
    return np.concatenate([(half - x[i:i + 4096] @ centres.T).argmin(axis=1) for i in range(0, len(x), 4096)]
                          or [np.zeros(0, np.int64)])


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        own = _nearest(x, centres)
        n = np.bincount(own, minlength=k)
        total = np.stack([np.bincount(own, x[:, j], k) for j in range(x.shape[1])], axis=1)
        some = n > 0
        centres[some] = total[some] / n[some, None]
    return centres


@dataclass
class Quantiser:
    lists: np.ndarray            # lists x dims, in the order of their cells
    cells: np.ndarray            # cell of each list
    books: list[np.ndarray]      # per subspace: codes x its dims
    cuts: np.ndarray             # subspace borders
    reach: float                 # distance of unit vectors at the least cosine

    @classmethod
    def fit(cls, x: np.ndarray, n_lists: int, n_cells: int, min_cosine: float, seed: int = 5) -> Quantiser:
        rng = np.random.default_rng(seed)
        dims = x.shape[1]
        lists = _kmeans(x, n_lists, rng)
        rest = x - lists[_nearest(x, lists)]
        cuts = np.linspace(0, dims, min(SUBSPACES, dims) + 1).astype(int)
        books = [_kmeans(rest[:, a:b], CODES, rng) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        cells = _nearest(lists, _kmeans(lists, n_cells, rng))
        order = np.argsort(cells, kind="stable")
        return cls(lists[order], cells[order], books, cuts, float(np.sqrt(max(0.0, 2 - 2 * min_cosine))))

    def parts(self):
        return list(zip(self.books, self.cuts[:-1], self.cuts[1:], strict=True))

    def own(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x, self.lists)

    def reads(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Lists each unit vector queries: those in reach from its own one on."""
        half = (self.lists ** 2).sum(axis=1) / 2
        between = np.sqrt(np.maximum(2 * (half[:, None] + half[None, :] - self.lists @ self.lists.T), 0))
        score = half - x @ self.lists.T
        # distance to the bisector of the own list and each other one
        gap = score - score[np.arange(len(x)), own][:, None]
        return (gap <= self.reach * between[own] + 1e-9) & (np.arange(len(self.lists))[None, :] >= own[:, None])

    def encode(self, x: np.ndarray, own: np.ndarray):
        """(codes, code error) of each unit vector."""
        rest = x - self.lists[own]
        codes = np.zeros((len(x), len(self.books)), np.uint8)
        left = rest.copy()
        for m, (book, a, b) in enumerate(self.parts()):
            codes[:, m] = _nearest(rest[:, a:b], book)
            left[:, a:b] -= book[codes[:, m]]
        return codes, np.linalg.norm(left, axis=1)

    def norms(self, own: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared lengths of the coded entries."""
        point = self.lists[own]
        for m, (book, a, b) in enumerate(self.parts()):
            point[:, a:b] += book[codes[:, m]]
        return (point ** 2).sum(axis=1)

    def distances(self, q: np.ndarray, own: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Squared asymmetric distances, coded entries x unit queries."""
        # |q - c - b|^2 = 1 + |c + b|^2 - 2 q.c - 2 q.b; the look-up tables are matrix products
        q = q.astype(np.float32)
        out = np.take(self.lists.astype(np.float32) @ q.T, own, axis=0)
        for m, (book, a, b) in enumerate(self.parts()):
            out += np.take(book.astype(np.float32) @ q[:, a:b].T, codes[:, m], axis=0)
        out *= -2
        out += (1 + norms).astype(np.float32)[:, None]
        return out


def _valid(kind: str):
    """Rows of (id, components) whose vector has a direction, as (id, bytes)."""
    def run(batches):
        for batch in batches:
            ids, vecs = [], []
            for i, v in zip(batch.column(0), batch.column(1), strict=True):
                if not v.is_valid or len(v.values) == 0 or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(kind)
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    vecs.append((x + x.dtype.type(0)).tobytes())       # -0.0 becomes 0.0
            yield pa.RecordBatch.from_arrays([pa.array([i.as_py() for i in ids], batch.column(0).type),
                                              pa.array(vecs, pa.binary())], names=["id", "v"])
    return run


def _entries(shared, kind: str):
    def run(batches):
        model: Quantiser = shared.value
        starts = np.flatnonzero(np.diff(model.cells, prepend=-1))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column(1).to_pylist(), kind)
            own = model.own(x)
            codes, err = model.encode(x, own)
            read = np.logical_or.reduceat(model.reads(x, own), starts, axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), batch.column(1), pa.array(own.astype(np.int32)),
                pa.array(model.cells[own].astype(np.int32)),
                pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(err),
                pa.array([model.cells[starts[r]].astype(np.int32) for r in read], pa.list_(pa.int32()))],
                names=["rid", "m", "v", "own", "cell", "codes", "err", "read"])
    return run


def _link_block(shared, kind: str, min_cosine: float):
    """Links of one block of entries and one of queries: (rid, n, root) of linked vectors."""
    def run(key, entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"rid": np.zeros(0, np.int64), "n": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})
        if not len(entries) or not len(queries):
            return none
        model: Quantiser = shared.value
        entries, queries = entries.sort_values("own"), queries.sort_values("own")
        e, q = _unit(entries["v"].tolist(), kind), _unit(queries["v"].tolist(), kind)
        codes = np.frombuffer(b"".join(entries["codes"]), np.uint8).reshape(len(e), -1)
        e_own, q_own = entries["own"].to_numpy(), queries["own"].to_numpy()
        norms = model.norms(e_own, codes)
        # single-precision sums of a few values up to 4
        least = ((model.reach + entries["err"].to_numpy()) ** 2 + 1e-4).astype(np.float32)
        e_id, q_id = entries["rid"].to_numpy(), queries["rid"].to_numpy()
        e_m, q_m = entries["m"].to_numpy(), queries["m"].to_numpy()
        e_n, q_n = np.zeros(len(e), np.int64), np.zeros(len(q), np.int64)
        found = []
        for at in range(0, len(q), 256):
            part = slice(at, at + 256)
            reads = model.reads(q[part], q_own[part]).T
            use = np.flatnonzero(reads.any(axis=1)[e_own])
            near = model.distances(q[part], e_own[use], codes[use], norms[use]) <= least[use][:, None]
            near &= reads[e_own[use]]
            # inside a list each pair meets twice; the smaller id queries
            same = e_own[use][:, None] == q_own[part][None, :]
            near &= ~same | (q_id[part][None, :] < e_id[use][:, None])
            rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            if not rows.size:
                continue
            links = (e[use[rows]] @ q[part][cols].T >= min_cosine) & near[np.ix_(rows, cols)]
            r, c = np.nonzero(links)
            r, c = use[rows[r]], at + cols[c]
            np.add.at(q_n, c, e_m[r])
            np.add.at(e_n, r, q_m[c])
            found.append(np.stack([c, r], axis=1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        if not len(pairs):
            return none
        # smallest label over the block's link graph, so only (vector, root) leaves the task
        ids, at = np.unique(np.concatenate([q_id[pairs[:, 0]], e_id[pairs[:, 1]]]), return_inverse=True)
        a, b = at[:len(pairs)], at[len(pairs):]
        root = np.arange(ids.size)
        while True:
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            low = low[low]
            if (low == root).all():
                break
            root = low
        n = np.zeros(ids.size, np.int64)
        for own, count in ((q_id, q_n), (e_id, e_n)):
            some = count > 0
            np.add.at(n, np.searchsorted(ids, own[some]), count[some])
        return pd.DataFrame({"rid": ids, "n": n, "root": ids[root]})
    return run


def _by_cell(counts: dict[int, int], block: int):
    """Column: number of blocks of the cell in column ``cell``."""
    many = {k: -(-n // block) for k, n in counts.items() if n > block}
    if not many:
        return F.lit(1)
    return F.coalesce(F.create_map(*[F.lit(x) for kv in many.items() for x in kv])[F.col("cell")], F.lit(1))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row per vector: ``id_col``, n_links, component_id (smallest id reachable by links, itself
    included) and kept (it is that id).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    nor do vectors of different length with each other; equal vectors link; repeated rows are
    vectors of their own; a null id never names a component of rows with ids and is not kept;
    an empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    set_arrow_rows(spark)
    kind = "<f4" if isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType) else "<f8"
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(ident(id_col).alias("id"), ident(vec_col).alias("vec"))
    good = rows.mapInArrow(_valid(kind), f"id {id_type}, v binary")
    classes = cut_lineage(good.groupBy("v").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("m"))
                          .withColumn("rid", F.monotonically_increasing_id()), "pq-classes")
    sizes = {r["b"]: r["n"] for r in classes.groupBy(F.octet_length("v").alias("b"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}   # one row a vector length
    linked = None
    for size, n in sizes.items():
        found = _links_of(spark, classes.where(F.octet_length("v") == size), size, n, kind, min_cosine)
        linked = found if linked is None else linked.unionByName(found)
    if linked is None:
        linked = spark.createDataFrame([], "rid long, n long, root long")
    linked = cut_lineage(linked, "pq-links")
    parts = cut_lineage(connected_components(linked, "rid", "root"), "pq-components")
    links = linked.groupBy("rid").agg(F.sum("n").alias("n"))
    marked = cut_lineage(
        classes.drop("v").join(links, "rid", "left").join(parts.withColumnRenamed("node", "rid"), "rid", "left")
        .select("rid", "first", "m", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "rid").alias("group")),
        "pq-marked")
    roots = marked.groupBy("group").agg(F.min("first").alias("component_id"))
    answer = cut_lineage(marked.join(roots, "group").join(classes.select("rid", "v"), "rid")
                         .select("v", (F.col("n") + F.col("m") - 1).alias("n_links"), "component_id"), "pq-answer")
    valid = good.join(answer, "v").select("id", "n_links", "component_id")
    bad = rows.where(~_has_direction("vec")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    both = valid.unionByName(bad)
    return both.select(F.col("id").alias(id_col), "n_links", "component_id",
                       F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _has_direction(column: str):
    """The same test as ``_valid`` in SQL functions."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(column, lambda x: x != 0), F.lit(False))


def _links_of(spark, classes: DataFrame, size: int, n: int, kind: str, min_cosine: float) -> DataFrame:
    """(rid, n, root) parts over the classes of one vector length."""
    take = min(TRAIN_ROWS, max(CODES, TRAIN_BYTES // size))
    sample = classes.orderBy(F.xxhash64("v"), "v").limit(take).select("v").toArrow()["v"].to_pylist()
    lists = max(1, min(MAX_LISTS, n // LIST_ROWS))
    cells = min(lists, -(-n // ENTRY_BLOCK))
    shared = spark.sparkContext.broadcast(Quantiser.fit(_unit(sample, kind), lists, cells, min_cosine))   # bounded
    entries = cut_lineage(classes.select("rid", "v", "m").mapInArrow(
        _entries(shared, kind),
        "rid long, m long, v binary, own int, cell int, codes binary, err double, read array<int>"), "pq-entries")
    counts = {r["cell"]: r["n"] for r in entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = {r["cell"]: r["n"] for r in entries.select(F.explode("read").alias("cell")).groupBy("cell")
             .agg(F.count(F.lit(1)).alias("n")).collect()}       # one row a cell, at most MAX_LISTS
    e_blocks, q_blocks = _by_cell(counts, ENTRY_BLOCK), _by_cell(asked, QUERY_BLOCK)
    spread = F.xxhash64("rid")
    stored = entries.select("rid", "m", "v", "own", "cell", "codes", "err",
                            F.pmod(spread, e_blocks).cast("int").alias("eb"),
                            F.explode(F.sequence(F.lit(0), (q_blocks - 1).cast("int"))).alias("qb"))
    queries = (entries.select("rid", "m", "v", "own", F.explode("read").alias("cell"))
               .select("rid", "m", "v", "own", "cell", F.pmod(spread, q_blocks).cast("int").alias("qb"),
                       F.explode(F.sequence(F.lit(0), (e_blocks - 1).cast("int"))).alias("eb")))
    return (stored.groupBy("cell", "eb", "qb").cogroup(queries.groupBy("cell", "eb", "qb"))
            .applyInPandas(_link_block(shared, kind, min_cosine), "rid long, n long, root long"))
