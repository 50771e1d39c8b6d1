"""The registered queries opN_<name>: each applies its operator to the whole of its table and
derives the digest columns of its contract.  ``QUERIES`` and ``ORACLE_SQL`` are added to the
driver's registry by the entry module."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    byte_bpe,
    decontaminate,
    orchard,
    pii_crf,
    pq_neardup,
    quality_knn,
    sharding,
    simhash,
    site_style,
    source_audit,
    substring_dedup,
    token_counts,
    warc_merkle,
)
from ledgerlake.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# The record text, volume size, range sizes and fault rule of the operator.
OP1_SQL = r"""
WITH made AS (
  SELECT page_id,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
         || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(coalesce(html, ''))::VARCHAR || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
hashed AS (SELECT *, sha256(record) AS sha FROM made),
diced AS (SELECT *, ('0x' || substr(sha, 9, 8))::BIGINT % 101 AS dice, length(record) // 2 AS mid FROM hashed),
copied AS (
  SELECT *, CASE dice
      WHEN 0 THEN substr(record, 1, mid - 1) || CASE WHEN substr(record, mid, 1) = '#' THEN '%' ELSE '#' END
                  || substr(record, mid + 1)
      WHEN 1 THEN substr(record, 1, mid) WHEN 2 THEN NULL ELSE record END AS copy
  FROM diced),
stored AS (
  SELECT sha, strlen(record) AS length, sha256(copy) AS copy_sha, strlen(copy) AS copy_length,
         min(page_id) AS page_id, count(*) AS copies
  FROM copied GROUP BY ALL),
placed AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY volume ORDER BY sha
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM (SELECT *, ('0x' || substr(sha, 1, 8))::BIGINT
                  % (SELECT greatest(1, (count(*) + 511) // 512) FROM stored) AS volume FROM stored)),
leaves AS (
  SELECT 0 AS side, volume, "offset", length AS l, sha AS s FROM placed
  UNION ALL SELECT 1, volume, "offset", copy_length, copy_sha FROM placed WHERE copy_sha IS NOT NULL),
r0 AS (SELECT side, volume, "offset" // 65536 AS b,
              sha256(string_agg("offset"::VARCHAR || ':' || sha256(l::VARCHAR || ':' || s), ',' ORDER BY "offset")) AS h
       FROM leaves GROUP BY ALL),
r1 AS (SELECT side, volume, b // 16 AS b, sha256(string_agg(b::VARCHAR || ':' || h, ',' ORDER BY b)) AS h
       FROM r0 GROUP BY side, volume, b // 16),
roots AS (SELECT side, volume, sha256(string_agg(b::VARCHAR || ':' || h, ',' ORDER BY b)) AS h
          FROM r1 GROUP BY side, volume)
SELECT p.volume::BIGINT AS volume, p."offset" AS record_offset, p.page_id, p.copies,
       CASE WHEN copy_sha IS NULL THEN 'missing' WHEN copy_length <> length THEN 'resized' ELSE 'altered' END AS fault,
       p.sha AS archived_sha256, p.copy_sha AS replica_sha256, x.h AS archived_root, y.h AS replica_root
FROM placed p LEFT JOIN roots x ON x.side = 0 AND x.volume = p.volume
     LEFT JOIN roots y ON y.side = 1 AND y.volume = p.volume
WHERE copy_sha IS DISTINCT FROM sha
"""


@query("op1_warc_merkle", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_merkle.audit_pages(read_table(spark, sf_dir, "pages"))
    return found.select("volume", F.col("offset").alias("record_offset"), F.col("id").alias("page_id"), "copies", "fault",
                        F.col("x_sha").alias("archived_sha256"), F.col("y_sha").alias("replica_sha256"),
                        F.col("x_root").alias("archived_root"), F.col("y_root").alias("replica_root"))


def _listed(column: str):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op2_pii_crf")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = pii_crf.spans(docs, pii_crf.train(docs), keep=["doc_id"])
    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii_crf.KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"),
                        _listed("spans").alias("spans"))


OP3_SQL = """
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
good AS (
  SELECT * FROM rows WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                       AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.rid AS a, b.rid AS b, a.vec_id AS a_id, b.vec_id AS b_id FROM good a JOIN good b
    ON a.rid <> b.rid AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  SELECT rid, rid AS other, vec_id AS other_id FROM rows
  UNION SELECT r.rid, l.b, l.b_id FROM reach r JOIN links l ON r.other = l.a),
parts AS (SELECT rid, min(other_id) AS component_id FROM reach GROUP BY rid),
degree AS (SELECT a AS rid, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM rows LEFT JOIN parts USING (rid) LEFT JOIN degree USING (rid)
"""


@query("op3_pq_neardup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_neardup.near_duplicates(read_table(spark, sf_dir, "embeddings"), min_cosine=pq_neardup.MIN_COSINE)


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query("op5_substring_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_substrings(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


@query("op6_stratified_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    placed = sharding.interleave(rows, "source", ("doc_id", "text_crc32", "size"), shards=sharding.SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(docs, words_per_shingle=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


OP8_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS t
  FROM (SELECT item, w, least(10, len(w)) AS l, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)),
doc_windows AS (
  SELECT rid, l, i, array_to_string(w[i:i + l - 1], ' ') AS t
  FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM docs, (SELECT DISTINCT l FROM item_windows) WHERE len(w) >= l)),
found AS (SELECT rid, item, i, d.l FROM doc_windows d JOIN item_windows USING (l, t)),
hit AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + l)) AS p FROM found) GROUP BY rid),
held AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
         FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(held.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN held USING (rid)
"""


@query("op8_decontaminate", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark_contaminated(read_table(spark, sf_dir, "documents"),
                                             read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return marked.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), keep=["doc_id"])


@query("op10_quality_knn")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality_knn.train(docs, quality_knn.training_rows(read_table(spark, sf_dir, "labels")))
    scored = quality_knn.score(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select("doc_id", quality_knn.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= quality_knn.KEEP_SCORE).cast("int").alias("predicted"))


# Kept documents of a term, units of a share, ranks of terms.
OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT rid, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
grps AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
  FROM grps g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN totals t USING (lang, source)
       LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT g.lang, g.source, o.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM grps g JOIN grps o ON g.lang = o.lang AND g.source <> o.source
       LEFT JOIN (SELECT a.lang, a.source, b.source AS other, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
                  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
                  GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source AND s.other = o.source),
terms AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS "rank" FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, r::INTEGER
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS r FROM terms) WHERE r <= 200
"""


@query("op11_source_divergence", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(read_table(spark, sf_dir, "documents"))


def _op13_sql() -> str:
    """The rounds of the clustering, one common table expression each."""
    near = """
assigned{i} AS MATERIALIZED (
  SELECT rid, vec_id, v, min(c) AS c, min(d) AS d FROM (
    SELECT x.rid, x.vec_id, x.v, k.c, d, min(d) OVER (PARTITION BY x.rid) AS least
    FROM (SELECT x.*, k.c, list_sum(list_transform(list_zip(x.v, k.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
          FROM x, cent{i} k) x JOIN cent{i} k USING (c)) WHERE d = least GROUP BY ALL)"""
    move = """
cent{j} AS MATERIALIZED (
  SELECT k.c, coalesce(m.v, k.v) AS v FROM cent{i} k LEFT JOIN (
    SELECT c, list(f ORDER BY j) AS v FROM (
      SELECT c, j, floor_div AS f FROM (
        SELECT c, j, CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END AS floor_div
        FROM (SELECT c, j, sum(e)::HUGEINT AS s, count(*)::HUGEINT AS n
              FROM (SELECT c, unnest(v) AS e, unnest(range(1, 65)) AS j FROM assigned{i}) GROUP BY c, j)))
    GROUP BY c) m USING (c))"""
    ctes = ["""
x AS MATERIALIZED (
  SELECT rid, vec_id, list_transform(e, lambda y: floor(256 * y)::BIGINT) AS v
  FROM (SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e FROM embeddings)
  WHERE len(e) = 64 AND len(list_filter(e, lambda y: y IS NULL OR NOT isfinite(y))) = 0)""", """
cent0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
    SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, list_transform(v, lambda y: y::HUGEINT) AS v FROM x)
  ORDER BY h, v LIMIT 40)"""]
    for i in range(orchard.ROUNDS):
        ctes += [near.format(i=i), move.format(i=i, j=i + 1)]
    ctes.append(near.format(i=orchard.ROUNDS))
    last = orchard.ROUNDS
    return f"""WITH {",".join(ctes)}
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM assigned{last} a JOIN cent{last} k ON a.c = k.c"""


@query("op13_orchard", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = orchard.cluster(read_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


@query("op12_site_style")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extract(read_table(spark, sf_dir, "pages"), keep=["page_id", "url"])
