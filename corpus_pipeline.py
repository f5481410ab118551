"""Corpus pipeline over `documents`: quality rules, near-duplicate removal, decontamination, masking, tokenisation.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; all but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, common, decontam, jaccard, pii, quality
from quire.llm.queries import VOCABULARY, table, trusted_ids


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.quality_rules(docs, trusted_ids(spark, sf_dir))
    return judged.where("kept").select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents: the one with the smallest id."""
    return jaccard.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the new text."""
    masked = pii.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and digests of the documents that are left."""
    done = bpe.encode_decode(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY), with_output=True)
    return done.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("BPE encoding and decoding", tokenise),
]

# Hashed likelihood ratios, the random field and BPE are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = common.staged(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
