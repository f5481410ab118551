"""Registered queries of the training-data operators, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, codes, common, decontam, jaccard, licenses, lm, oracle, periods, pii, quality, ranking, simhash, substrings, wrapper)

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted target of the quality rules: documents that `labels` marks as good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY)).drop("text")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(common.documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(common.documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(common.documents(spark, sf_dir), trusted_ids(spark, sf_dir)).drop("text")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(common.documents(spark, sf_dir))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(common.documents(spark, sf_dir)).drop("text")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(common.documents(spark, sf_dir)).drop("text")


def license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.notice_scan(common.documents(spark, sf_dir)).drop("text")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).withColumn("held_out", lm.held_out(F.col("doc_id"), 3, 1))
    labelled = table(spark, sf_dir, "labels").where(~lm.held_out(F.col("doc_id"), 3, 1)).select(
        "doc_id", (F.col("quality") == 1).alias("good"))
    return ranking.quality_scores(docs, labelled).drop("text")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(common.documents(spark, sf_dir))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.periodic_runs(common.documents(spark, sf_dir), plant=True)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return codes.with_label_error(codes.compress(vectors)[0])


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_decontaminate, op3_ngram_jaccard, op4_quality_rules, op5_html_extract, op6_substring_dedup,
    op7_pii, op8_license_scan, license_notices, op9_quality_classifier, op10_lm_score,
    op11_simhash, op12_periodic_runs, op13_vector_codes)}

ORACLE = dict(oracle.ORACLE)
