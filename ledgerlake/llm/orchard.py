"""Centroid clustering of integer vectors with Orchard's search for the nearest centroid.

Every centroid has a list of the other centroids, nearest first.  A vector starts at a centroid
and walks its list; a closer one found there (or one as close with a smaller number) is jumped
to and its list walked instead, centroids already compared are marked and passed over, and the
walk ends at an entry strictly farther from the list's centroid than twice the vector's current
distance: by the triangle inequality nothing from there on is nearer or as near.  All vectors of
an Arrow batch walk in step, one numpy operation a step.

Distances are sums of squares of integers in 64 bits and therefore exact.  A task sends one row
a centroid (count and component sums of its vectors), so a cluster with most of the rows is
added up before the shuffle; the driver sees k sums of fixed length a round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import field, ident, set_arrow_rows
from ledgerlake.session import cut_lineage

#: Clusters, components of a vector, units of one, rounds of reassignment, seed text before the id.
CLUSTERS = 40
DIMS = 64
SCALE = 256
ROUNDS = 5
SEED = "2"
#: Bound of an integer component: four times the sum of 64 squared differences still fits 64 bits.
LARGEST = 1 << 26
#: Vectors that walk together.
BLOCK = 4096

_V = "__llm_v"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS,
              scale: int = SCALE) -> DataFrame:
    """(id, components as integers) of the vectors with ``dims`` components, none null or non-finite.

    The job fails on a component beyond ``LARGEST``, whose distances would not fit a long.
    """
    v = F.col("x")
    whole = F.transform(v, lambda x: F.floor(F.lit(scale) * x))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # the magnitude is tested as a double, before it is cut to a long
    small = F.forall(v, lambda x: F.abs(x) < F.lit(float(LARGEST // scale)))
    return (vectors.select(ident(id_col).alias("id"), ident(vector_col).cast("array<double>").alias("x"))
            .where(F.coalesce((F.size("x") == dims) & finite, F.lit(False)))
            .select("id", F.when(small, whole).otherwise(F.raise_error(F.lit(
                f"a component of a vector is {LARGEST // scale} or more in magnitude"))).alias("v")))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: str = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest seeded hash of the id, in hash order (equal ids: by
    components); k rows reach the driver."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


@dataclass
class Neighbours:
    """Centroids, and for each one the others by distance (ties: smaller number)."""

    centroids: np.ndarray
    order: np.ndarray            # k x (k - 1) centroid numbers
    gap: np.ndarray              # their squared distances from the row's centroid

    @staticmethod
    def of(centroids: np.ndarray) -> Neighbours:
        k = len(centroids)
        d = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
        d[np.arange(k), np.arange(k)] = -1              # itself first, then cut off
        order = np.argsort(d, axis=1, kind="stable")[:, 1:]
        return Neighbours(centroids, order, np.take_along_axis(d, order, axis=1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid (ties: smaller number),
        and how many distances were computed."""
        n, k = len(x), len(self.centroids)
        at = np.zeros(n, np.int64)
        best = ((x - self.centroids[0]) ** 2).sum(axis=1)
        compared = n
        if k == 1:
            return at, best, compared
        marked = np.zeros((n, k), bool)
        marked[:, 0] = True
        place = np.zeros(n, np.int64)                   # in the list of the current centroid
        walking = np.arange(n)
        while walking.size:
            # squared distances: farther than twice is more than four times the square
            walking = walking[(place[walking] < k - 1)]
            walking = walking[self.gap[at[walking], place[walking]] <= 4 * best[walking]]
            other = self.order[at[walking], place[walking]]
            new = ~marked[walking, other]
            w, other = walking[new], other[new]
            place[walking] += 1
            if not w.size:
                continue
            marked[w, other] = True
            d = ((x[w] - self.centroids[other]) ** 2).sum(axis=1)
            compared += w.size
            closer = (d < best[w]) | ((d == best[w]) & (other < at[w]))
            w, other, d = w[closer], other[closer], d[closer]
            at[w], best[w], place[w] = other, d, 0
        return at, best, compared


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def assign(vectors: DataFrame, lists: Neighbours) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    set_arrow_rows(vectors.sparkSession)
    schema = T.StructType([vectors.schema["id"], field("cluster", "int"), field("distance", "long")])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                c, d, _ = lists.nearest(_matrix(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(c, pa.int32()), pa.array(d, pa.int64())],
                                                 names=schema.names)

    return vectors.select("id", "v").mapInArrow(run, schema)


def moved(vectors: DataFrame, lists: Neighbours) -> np.ndarray:
    """The centroids after one round: floor of the mean of each one's vectors; empty ones stay."""
    set_arrow_rows(vectors.sparkSession)
    k, dims = lists.centroids.shape

    def run(batches):
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                x = _matrix(batch.slice(lo, BLOCK).column(0))
                c, _, _ = lists.nearest(x)
                count += np.bincount(c, minlength=k)
                order = np.argsort(c, kind="stable")
                starts = np.flatnonzero(np.diff(c[order], prepend=-1))
                total[c[order][starts]] += np.add.reduceat(x[order], starts, axis=0)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(count[held]),
                                          pa.array(list(total[held]), pa.list_(pa.int64()))], names=["c", "n", "v"])

    parts = vectors.select("v").mapInArrow(run, "c int, n long, v array<long>")
    # sums of all tasks as decimals: any number of rows stays exact
    sums = (parts.select("c", "n", F.posexplode("v").alias("dim", "x")).groupBy("c", "dim")
            .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")))
    out = lists.centroids.copy()
    for r in sums.collect():                            # k x dims rows
        out[r["c"], r["dim"]] = int(r["x"]) // int(r["n"])
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS,
            rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of every vector that counts.

    Vectors that are null, of another length or with a null or non-finite component give no row.
    Repeated rows and ids give a row each.  With fewer than ``k`` vectors each is a centroid;
    equal centroids keep their numbers, and ties go to the smaller one.  An empty table gives an
    empty result.  Other columns are not read.
    """
    spark = vectors.sparkSession
    x = cut_lineage(quantised(vectors, id_col, vector_col, dims, scale), "orchard-vectors")
    centroids = first_centroids(x, k, seed)
    if not len(centroids):
        found = x.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    else:
        for _ in range(rounds):
            centroids = moved(x, Neighbours.of(centroids))
        found = cut_lineage(assign(x, Neighbours.of(centroids)), "orchard-assigned")
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    tail = spark.createDataFrame([(i, inertia[i], sum(inertia.values()), c.tolist()) for i, c in enumerate(centroids) if i in inertia],
                                 "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return (found.join(F.broadcast(tail), "cluster")            # at most k rows of one centroid each
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid"))
