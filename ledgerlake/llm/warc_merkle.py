"""Merkle fixity audit of archived records.

Pages become WARC response records, identical records being stored once with a count.  Records
are laid out in volumes and get byte offsets.  Each record is hashed; records whose offsets
fall in the same 64 KiB range are hashed together in offset order, then ranges of 1 MiB, whole
volumes, 16 volumes at a time and so on up to one root.  Offsets, not positions, place a
record, so a lost record changes only the ranges that held it.

An audit compares the roots of two replicas and goes down only from nodes that differ: at each
level the children of differing nodes are joined, all others are never looked at, and at the
bottom the records of the differing ranges are compared one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ident
from ledgerlake.session import cut_lineage

#: Records a volume holds on average.
VOLUME_RECORDS = 512
#: Bytes of the offset ranges, smallest first; above them one node a volume.
RANGE_BYTES = (1 << 16, 1 << 20)
#: Volumes (and groups of volumes) under one node above.
FANOUT = 16


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Columns ``id``, ``record``: one WARC response record a page.  Null fields are empty."""
    url = F.coalesce(ident(url_col).cast("string"), F.lit(""))
    body = F.coalesce(ident(body_col).cast("string"), F.lit(""))
    return pages.select(
        ident(id_col).alias("id"),
        F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
                 F.coalesce(ident(id_col).cast("string"), F.lit("")),
                 F.lit(">\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
                 F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n")).alias("record"))


def digest(record) -> tuple:
    """(sha256 in hex, length in bytes) of a record column."""
    return F.sha2(record, 256), F.octet_length(record).cast("long")


def volume_count(n_records: int) -> int:
    return max(1, -(-n_records // VOLUME_RECORDS))


def layout(hashed: DataFrame, volumes: int) -> DataFrame:
    """Adds ``volume`` and ``offset`` to rows with ``sha`` and ``length``, one row a stored record.
    The volume follows from the record's hash, so volumes are even whatever the ids or hosts are;
    the offset is the running length in hash order."""
    placed = hashed.withColumn("volume", F.conv(F.substring("sha", 1, 8), 16, 10).cast("long") % volumes)
    before = Window.partitionBy("volume").orderBy("sha").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))


def _hash_children(nodes: DataFrame, key: list) -> DataFrame:
    """One node a key: the hash of its children's (order, hash) in order."""
    kids = F.sort_array(F.collect_list(F.struct("at", "sha")))
    return nodes.groupBy(*key).agg(
        F.sha2(F.array_join(F.transform(kids, lambda x: F.concat_ws(":", x["at"], x["sha"])), ","), 256).alias("sha"))


def tree(manifest: DataFrame, volumes: int) -> list[DataFrame]:
    """Levels of (a, b, sha), ranges first, one root last: ``a`` is the volume (or group of
    volumes), ``b`` the offset range in it.  ``manifest`` has volume, offset, length, sha; an
    empty manifest gives empty levels."""
    at = F.col("offset")
    level = cut_lineage(_hash_children(
        manifest.select(F.col("volume").alias("a"), F.expr(f"offset div {RANGE_BYTES[0]}").alias("b"), at.alias("at"),
                        F.sha2(F.concat_ws(":", "length", "sha"), 256).alias("sha")),
        ["a", "b"]), "merkle-ranges")
    levels = [level]
    for small, large in zip(RANGE_BYTES, [*RANGE_BYTES[1:], None]):
        step = large // small if large else None
        level = _hash_children(level.select(
            "a", (F.expr(f"b div {step}") if step else F.lit(0).cast("long")).alias("b"),
            F.col("b").alias("at"), "sha"), ["a", "b"])
        levels.append(level)
    level = levels[-1] = cut_lineage(levels[-1], "merkle-volumes")
    left = volumes
    while left > 1:
        level = _hash_children(level.select(F.expr(f"a div {FANOUT}").alias("a"), F.lit(0).cast("long").alias("b"),
                                            F.col("a").alias("at"), "sha"), ["a", "b"])
        levels.append(level)
        left = -(-left // FANOUT)
    return levels


def _parents(level: int, n_levels: int) -> tuple[str, str]:
    """Expressions of a node's parent key at the next level."""
    if level + 1 < len(RANGE_BYTES):
        return "a", f"b div {RANGE_BYTES[level + 1] // RANGE_BYTES[level]}"
    if level + 1 == len(RANGE_BYTES):
        return "a", "0"
    return f"a div {FANOUT}", "0"


def differing(mine: list[DataFrame], other: list[DataFrame]) -> DataFrame:
    """(a, b) of the smallest ranges that differ, found from the root down."""
    found = None
    top = len(mine) - 1
    for level in range(top, -1, -1):
        sides = []
        for nodes, name in ((mine[level], "x"), (other[level], "y")):
            side = nodes
            if found is not None:
                pa, pb = _parents(level, len(mine))
                side = (side.withColumn("pa", F.expr(pa)).withColumn("pb", F.expr(pb).cast("long"))
                        .join(found, ["pa", "pb"], "left_semi"))
            sides.append(side.select("a", "b", F.col("sha").alias(name)))
        found = (sides[0].join(sides[1], ["a", "b"], "full")
                 .where(~F.col("x").eqNullSafe(F.col("y"))).select(F.col("a").alias("pa"), F.col("b").alias("pb")))
        if level in (top, len(RANGE_BYTES)):
            found = cut_lineage(found, "merkle-differing")
    return found.select(F.col("pa").alias("a"), F.col("pb").alias("b"))


def audit(mine: DataFrame, other: DataFrame, volumes: int) -> DataFrame:
    """Damaged records of ``other`` against ``mine`` (both with volume, offset, length, sha, one row a
    stored record): volume, offset, fault (missing, extra, resized, altered), the lengths and
    hashes of both sides, and the volume roots of both.  Equal replicas give an empty result."""
    a, b = tree(mine, volumes), tree(other, volumes)
    ranges = differing(a, b)
    sides = []
    for rows, name in ((mine, "x"), (other, "y")):
        inside = (rows.withColumn("a", F.col("volume")).withColumn("b", F.expr(f"offset div {RANGE_BYTES[0]}"))
                  .join(ranges, ["a", "b"], "left_semi"))
        sides.append(inside.select("volume", "offset", F.col("length").alias(f"{name}_length"),
                                   F.col("sha").alias(f"{name}_sha")))
    both = sides[0].join(sides[1], ["volume", "offset"], "full").where(
        ~(F.col("x_sha").eqNullSafe(F.col("y_sha")) & F.col("x_length").eqNullSafe(F.col("y_length"))))
    fault = (F.when(F.col("y_sha").isNull(), "missing").when(F.col("x_sha").isNull(), "extra")
             .when(F.col("x_length") != F.col("y_length"), "resized").otherwise("altered"))
    roots = [lv[len(RANGE_BYTES)].select(F.col("a").alias("volume"), F.col("sha").alias(f"{n}_root"))
             for lv, n in ((a, "x"), (b, "y"))]
    return reduce(lambda d, r: d.join(r, "volume", "left"), roots, both.withColumn("fault", fault))


def aged(record, sha):
    """A replica's copy of a record after storage faults that its hash decides: of 101 parts one
    has a flipped character in the middle, one lost its second half, one is gone (null)."""
    dice = F.conv(F.substring(sha, 9, 8), 16, 10).cast("long") % 101
    mid = F.floor(F.char_length(record) / 2).cast("int")
    old = F.substr(record, mid, F.lit(1))
    flipped = F.concat(F.substr(record, F.lit(1), mid - 1), F.when(old == "#", "%").otherwise("#"),
                       F.substr(record, mid + 1))
    return (F.when(dice == 0, flipped).when(dice == 1, F.substr(record, F.lit(1), mid))
            .when(dice == 2, F.lit(None)).otherwise(record))


def audit_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Writes nothing back: archives the pages, ages a replica of the archive, audits it, and returns
    one row a damaged record with ``id``, the smallest page id stored in it, and ``copies``.

    Null fields count as empty; repeated rows are one record with copies; rows whose records are
    equal in every byte are the same record; an empty table gives an empty result; other columns
    are not read.
    """
    made = records(pages, id_col, url_col, body_col)
    sha, length = digest(F.col("record"))
    first = made.withColumn("sha", sha).withColumn("length", length)
    copy = aged(F.col("record"), F.col("sha"))
    seen = first.select("id", "sha", "length", copy.alias("copy")).select(
        "id", "sha", "length", F.sha2("copy", 256).alias("copy_sha"), F.octet_length("copy").cast("long").alias("copy_length"))
    stored = cut_lineage(seen.groupBy("sha", "length", "copy_sha", "copy_length")
                         .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "warc-records")
    volumes = volume_count(stored.count())
    placed = cut_lineage(layout(stored, volumes), "warc-layout")
    mine = placed.select("volume", "offset", "length", "sha")
    other = placed.where("copy_sha is not null").select(
        "volume", "offset", F.col("copy_length").alias("length"), F.col("copy_sha").alias("sha"))
    return audit(mine, other, volumes).join(placed.select("volume", "offset", "id", "copies"), ["volume", "offset"])
