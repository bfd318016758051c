"""A corpus pipeline: quality classifier, SimHash near-dedup, secret scans, source mixing, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes every stage's rows to the shared folder and
reads them back as the next stage's documents. All stages but the last return the columns of their documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentgate.llm import mixing, packing, quality, secrets, simhash
from contentgate.llm.common import passing_tables, read, remove, save
from contentgate.llm.queries import WORD_FILE, ranks, vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts good."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return simhash.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by a mark and n_chars counted anew."""
    clean = secrets.redact(docs, ranks(), public_tokenizers.PATTERN)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns) if "n_chars" in docs.columns else clean


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and its place there."""
    return packing.pack_documents(docs, vocabulary(WORD_FILE))


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("secret scans", secrets_stage),
    ("source mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

# Scores, SimHash and the tokenizer's merges have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. What the stages save on their way is removed once the next table is written."""
    docs, kept = read(spark, sf_dir, "documents"), []
    for _, stage in STAGES:
        with passing_tables(spark) as paths:
            docs = save(stage(spark, docs, sf_dir))
            made = paths.pop()
        remove(spark, kept)
        kept = [made]
    return docs
