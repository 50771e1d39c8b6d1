"""SimHash near-duplicates by multi-index hashing.

A fingerprint has two 32-bit segments.  Two fingerprints at most two bits apart have either
first segments at most one bit apart or equal second segments, so every fingerprint looks up
the radius-1 Hamming ball of its first segment and the value of its second one in a table of
segment values, and the complete distance of each table match is verified.  Of a pair whose
first segments differ in one bit only the side with a 0 there enumerates the flip.

Tables are over different fingerprints, so exact copies never meet as pairs.  A segment value
that more than ``bucket_cap`` fingerprints share is not joined; its fingerprints and those that
look it up enumerate their whole radius-1 ball instead.  Two fingerprints at most two bits
apart share a ball member, all that share a member are at most two bits apart, and at most 65
fingerprints can share one, so linking each to the smallest is exact and linear.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import as_bytes, connected_components, field, ident, map_texts
from ledgerlake.session import cut_lineage

#: Segment values shared by more different fingerprints than this take the linear way.
BUCKET_CAP = 64
SEED = 42
_BLOCK = 1 << 16


def fingerprint(raw: bytes, words_per_shingle: int) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text; zero without words."""
    words = raw.lower().split()              # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    buf = b" ".join(words)
    n = len(words)
    digest = xxhash.xxh64_intdigest
    if n <= words_per_shingle:
        return digest(buf, SEED)
    size = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[:n - words_per_shingle + 1].tolist()
    stops = ends[words_per_shingle - 1:].tolist()
    total = len(starts)
    ones = np.zeros(64, np.int64)
    for at in range(0, total, _BLOCK):
        some = [digest(buf[s:e], SEED) for s, e in zip(starts[at:at + _BLOCK], stops[at:at + _BLOCK], strict=True)]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


class _Kernel:
    def __init__(self, words_per_shingle: int):
        self.k = words_per_shingle

    def __call__(self, values: pa.Array):
        prints = np.array([fingerprint(t, self.k) for t in as_bytes(values)], np.uint64)
        return [prints.view(np.int64)]


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, text_col: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text) with ``fp``, the signed 64-bit SimHash."""
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    return map_texts(docs, text_col, partial(_Kernel, words_per_shingle), [field("fp", "long")], keep)


def links(prints: DataFrame, max_bits: int = 2, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """Edges (a, b) over different values of ``fp`` that connect exactly the fingerprints that
    chains of at most ``max_bits`` (1 or 2) differing bits connect."""
    if max_bits not in (1, 2):
        raise ValueError("two segments with radius-1 and radius-0 look-ups cover 1 or 2 bits")
    different = cut_lineage(prints.select("fp").where("fp is not null").distinct(), "simhash-fp")
    seg0 = F.shiftrightunsigned("fp", 32)
    seg1 = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)) + F.lit(1 << 32)   # own value range
    table = different.select(F.explode(F.array(seg0, seg1)).alias("key"), F.col("fp").alias("e"))
    crowded = cut_lineage(table.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
                          .where(F.col("n") > bucket_cap).select("key"), "simhash-crowded")
    flips = F.filter(F.transform(F.sequence(F.lit(0), F.lit(31)),
                                 lambda i: seg0.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))),
                     lambda v: v != seg0)
    lookups = different.select(F.explode(F.concat(F.array(seg0, seg1), flips)).alias("key"),
                               F.col("fp").alias("q"))
    if not crowded.isEmpty():
        near = (lookups.join(crowded, "key", "left_semi").select(F.col("q").alias("fp"))
                .unionByName(table.join(crowded, "key", "left_semi").select(F.col("e").alias("fp")))
                .distinct())
        table = table.join(crowded, "key", "left_anti")
    else:
        near = None
    found = (lookups.join(table, "key")
             .where((F.col("q") != F.col("e"))
                    & (F.bit_count(F.col("q").bitwiseXOR(F.col("e"))) <= max_bits))
             .select(F.least("q", "e").alias("a"), F.greatest("q", "e").alias("b")))
    if near is None:
        return found
    one = F.lit(1).cast("long")
    if max_bits == 1:
        # at most one bit apart: each neighbour is looked up directly
        ball = near.select(F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(63)),
            lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", one, i)))).alias("z"), F.col("fp").alias("a"))
        return found.unionByName(ball.join(different.withColumnRenamed("fp", "b"), F.col("z") == F.col("b"))
                                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    ball = near.select(F.explode(F.concat(F.array("fp"), F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", one, i))))).alias("z"), "fp")
    shared = (ball.groupBy("z").agg(F.sort_array(F.collect_list("fp")).alias("g"))   # at most 65
              .where(F.size("g") > 1))
    stars = shared.select(F.col("g")[0].alias("a"), F.explode(F.slice("g", 2, 64)).alias("b"))
    return found.unionByName(stars)


def _groups(prints: DataFrame, id_col: str, max_bits: int, bucket_cap: int) -> DataFrame:
    """(fp, __llm_group, __llm_first): every fingerprint's component and its smallest id."""
    parts = cut_lineage(connected_components(links(prints, max_bits, bucket_cap)), "simhash-components")
    firsts = prints.groupBy("fp").agg(F.min(ident(id_col)).alias("__llm_first"))
    return firsts.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("__llm_group"), "__llm_first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = 3, max_bits: int = 2,
                    bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """One row per document: ``id_col``, ``fp`` and ``component_id``, the smallest id reachable
    over links of at most ``max_bits`` differing bits, itself included.

    Null and empty texts have fingerprint zero and link like any other; repeated rows and equal
    texts share a fingerprint; a null id takes its component's smallest id (null if all are
    null); an empty table gives an empty result; other columns are not read.
    """
    prints = cut_lineage(fingerprints(docs, words_per_shingle, text_col, [id_col]), "simhash-docs")
    grouped = cut_lineage(_groups(prints, id_col, max_bits, bucket_cap), "simhash-groups")
    roots = grouped.groupBy("__llm_group").agg(F.min("__llm_first").alias("component_id"))
    by_print = cut_lineage(grouped.join(roots, "__llm_group").select("fp", "component_id"), "simhash-roots")
    return prints.join(by_print, "fp").select(ident(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
             max_bits: int = 2, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """The documents without near-duplicates, columns in order: of each group the one of
    smallest id stays (ids before nulls, then the smaller fingerprint; of rows equal in both, the
    one whose text hashes lowest)."""
    tagged = cut_lineage(map_texts(docs, text_col, partial(_Kernel, words_per_shingle),
                                   [field("__llm_fp", "long")], docs.columns), "simhash-tagged")
    prints = tagged.select(ident(id_col).alias("__llm_id"), F.col("__llm_fp").alias("fp"))
    grouped = _groups(prints, "__llm_id", max_bits, bucket_cap)
    # a null id sorts last, so it represents a group only where no row has an id
    best = cut_lineage(grouped.groupBy("__llm_group").agg(F.min(F.struct(
        F.col("__llm_first").isNull().alias("gone"), F.col("__llm_first").alias("id"), F.col("fp").alias("fp"))
    ).alias("b")).select(F.col("b.id").alias("__llm_id"), F.col("b.fp").alias("__llm_best")), "simhash-kept")
    kept = tagged.join(best, F.col("__llm_fp").eqNullSafe(F.col("__llm_best"))
                       & ident(id_col).eqNullSafe(F.col("__llm_id")), "left_semi")
    repeated = prints.groupBy("__llm_id", "fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        order = Window.partitionBy(ident(id_col), F.col("__llm_fp")).orderBy(F.xxhash64(ident(text_col)), ident(text_col))
        kept = kept.withColumn("__llm_nth", F.row_number().over(order)).where("__llm_nth = 1")
    return kept.select(*[ident(c) for c in docs.columns])
