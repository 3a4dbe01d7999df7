"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import jaccard, licenses, mixing, outliers, pieces, pii, quality, repeats, shallot, topk, toxicity, turns, urls
from daybook.llm.common import read_table


def q_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op1_mix(read_table(spark, sf_dir, "documents"))


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op2_pii(read_table(spark, sf_dir, "documents"))


def q_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.op3_urls(read_table(spark, sf_dir, "pages"))


def q_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.op4_sentencepiece(read_table(spark, sf_dir, "documents"))


def q_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.op5_topk(read_table(spark, sf_dir, "embeddings"))


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op6_licenses(read_table(spark, sf_dir, "documents"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op7_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def q_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.op8_jaccard(read_table(spark, sf_dir, "documents"))


def q_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.op9_repeats(read_table(spark, sf_dir, "documents"))


def q_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(read_table(spark, sf_dir, "documents"))


def q_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.op11_turns(read_table(spark, sf_dir, "conversations"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op12_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def q_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.op13_cluster(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_source_mix": q_source_mix,
    "op2_pii_boosting": q_pii,
    "op3_url_filter": q_urls,
    "op4_sentencepiece": q_sentencepiece,
    "op5_exact_topk": q_topk,
    "op6_license_digests": q_licenses,
    "op7_quality_compression": q_quality,
    "op8_ngram_jaccard": q_jaccard,
    "op9_repeated_strings": q_repeats,
    "op10_robust_outliers": q_outliers,
    "op11_conversation_repair": q_turns,
    "op12_toxicity_compression": q_toxicity,
    "op13_shallot_clusters": q_shallot,
}

#: The others have no SQL form (trained models, iterations); tests/llm holds them against brute force.
ORACLE_SQL = {
    "op1_source_mix": mixing.ORACLE,
    "op5_exact_topk": topk.ORACLE,
    "op6_license_digests": licenses.ORACLE,
    "op13_shallot_clusters": shallot.ORACLE,
}
