"""Corpus pipeline: documents through quality classifier, near-dedup, benchmark decontamination,
personal-data masking and byte-level BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import byte_bpe, decontaminate, pii_crf, quality_knn, simhash
from ledgerlake.llm.common import ident, read_table
from ledgerlake.session import cut_lineage


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[ident(c) for c in like.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose score is below the classifier's threshold."""
    labels = read_table(spark, sf_dir, "labels")
    model = quality_knn.train(docs, quality_knn.training_rows(labels))
    scored = quality_knn.score(docs, model, out_col="__llm_score")
    return _columns(scored.where(F.col("__llm_score") >= quality_knn.KEEP_SCORE), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group."""
    return simhash.keep_one(docs, words_per_shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every span of personal data in the text; n_chars follows the new text."""
    masked = pii_crf.mask(docs, pii_crf.train(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.char_length("text").cast(kind))
    return masked


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text that is left, with the byte offsets of its slices."""
    coded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            keep=[c for c in docs.columns if c != "text"])
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality classifier", quality), ("simhash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("personal data", personal_data),
          ("byte-level bpe", encoding)]

# hashes, votes and merges are beyond SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
