"""Shared pieces of the training-data operators.

``map_texts`` runs a per-task kernel over whole texts in byte-balanced Arrow slices;
``connected_components`` labels graph nodes with alternating star contraction (joins and
minimum aggregates only, so a hub node is pre-aggregated and AQE can split its edges).
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlake.session import cut_lineage, table_path

#: Rows of one Arrow batch between the JVM and Python, so that a batch of long texts stays small.
ARROW_ROWS = 1024
#: Bytes of text that a kernel gets at once (one longer text is a slice of its own).
SLICE_BYTES = 4 << 20

_TEXT = "__llm_text"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def ident(name: str):
    """Column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


@lru_cache(8)
def _ship(application_id: str) -> None:
    """Send this package to the Python workers (once an application), as they may not have it on
    their path; Spark serves the archive from the driver."""
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ledgerlake-")) / "ledgerlake.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    SparkContext.getOrCreate().addPyFile(str(archive))


def set_arrow_rows(spark: SparkSession) -> None:
    """Ready the session for Python operators: the package on the workers, and Arrow batches
    small unless the session already asks for smaller ones."""
    _ship(spark.sparkContext.applicationId)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def byte_slices(batch: pa.RecordBatch, column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about equal text bytes, none over ``max_bytes`` unless one
    text alone is longer."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = int(size.sum())
    want = max(1, -(-total // max_bytes))
    target = total / want
    start, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > start and (held + n > max_bytes or held >= target):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def as_text(values: pa.Array) -> list[str]:
    return ["" if v is None else v for v in values.to_pylist()]


def as_bytes(values: pa.Array) -> list[bytes]:
    if pa.types.is_string(values.type):
        values = values.cast(pa.binary())
    elif pa.types.is_large_string(values.type):
        values = values.cast(pa.large_binary())
    return [b"" if v is None else v for v in values.to_pylist()]


def map_texts(df: DataFrame, text_col: str, kernel: Callable, fields: Sequence[T.StructField],
              keep: Sequence[str], max_bytes: int = SLICE_BYTES) -> DataFrame:
    """``keep`` columns passed through plus ``fields`` computed from the whole text.

    ``kernel()`` is made once per task and maps an Arrow array of texts (nulls inside) to one
    sequence per field.  Fields replace kept columns of the same name.
    """
    set_arrow_rows(df.sparkSession)
    names = {f.name for f in fields}
    keep = [c for c in keep if c not in names]
    inner = df.select(*[ident(c) for c in keep])
    if text_col in keep and isinstance(df.schema[text_col].dataType, T.StringType):
        at = keep.index(text_col)           # the kept column is read, not sent twice
    else:
        at = len(keep)
        inner = df.select(*[ident(c) for c in keep], ident(text_col).cast("string").alias(_TEXT))
    schema = T.StructType([inner.schema[c] for c in keep] + list(fields))
    kinds = [to_arrow_type(f.dataType) for f in fields]
    out_names = [f.name for f in schema.fields]
    n_keep = len(keep)

    def run(batches):
        compute = kernel()
        for batch in batches:
            for part in byte_slices(batch, at, max_bytes):
                made = [v if isinstance(v, pa.Array) else pa.array(v, type=k)
                        for v, k in zip(compute(part.column(at)), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_keep], *made], names=out_names)
                del made, part
        # the worker process serves other tasks and stages after this one
        del compute
        pa.default_memory_pool().release_unused()

    return inner.mapInArrow(run, schema)


def field(name: str, kind: str | T.DataType, nullable: bool = True) -> T.StructField:
    kind = T._parse_datatype_string(kind) if isinstance(kind, str) else kind
    return T.StructField(name, kind, nullable)


def first_true(mask: np.ndarray) -> int:
    hits = np.flatnonzero(mask)
    return int(hits[0]) if hits.size else -1


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """(node, component): every node with an edge to another, and the smallest node reachable.

    Alternating large-star / small-star contraction: each half step replaces the neighbours of
    a node by its smallest neighbour.  The minimum is a partial aggregate and is written before
    the join back, so both join inputs are plain exchanges that AQE can split at a hub.
    Nulls and self loops are ignored; an empty input gives an empty result.
    """
    e = (edges.select(F.greatest(ident(a), ident(b)).alias("u"), F.least(ident(a), ident(b)).alias("v"))
         .where("u > v").distinct())
    e = cut_lineage(e, "cc-edges")
    seen = _fingerprint(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m"))
                          .select("u", F.least("u", "m").alias("m")), "cc-low")
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        large = cut_lineage(large, "cc-large")
        small_low = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        links = (large.join(small_low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = cut_lineage(links.unionByName(small_low.withColumnRenamed("m", "v")).distinct(), "cc-edges")
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
