"""Registered queries: each applies an operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from farespan.llm import bayes, bpe, decontaminate, jaccard, licenses, lines, mixing, quality, sharding, substrings, urls, variants, whitening
from farespan.llm.common import read
from farespan.llm.sql import SQL  # noqa: F401


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(read(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), 16)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(read(spark, sf_dir, "documents"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(read(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_decontaminate, op3_shards, op4_jaccard_join, op5_substrings, op6_mix,
        op7_license_scan, op8_quality_rules, op9_quality_classifier, op10_url_filter, op11_spelling_variants, op12_byte_bpe, op13_whitening,
    )
}
