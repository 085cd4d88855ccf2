"""Registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vhist.llm import align, bpe, centroids, debruijn, decontam, jaccard, pii, quality, suffix_dedup, token_files, topk, url_filter, warc
from vhist.llm.common import table
from vhist.llm.shipping import ship_package


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op4_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.document_token_counts(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.aligned_tokens(table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeated_words(table(spark, sf_dir, "documents"))


def _shipped(f: Callable[[SparkSession, str], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    query.__name__, query.__doc__ = f.__name__, f.__doc__
    return query


QUERIES = {f.__name__: _shipped(f) for f in (
    op1_quality_classifier, op2_decontamination, op3_bpe, op4_top_inner_products, op5_personal_data, op6_warc, op7_suffix_dedup,
    op8_token_counts, op9_ngram_jaccard_join, op10_url_filter, op11_token_alignment, op12_centroid_clusters,
    op13_substring_dedup,
)}
