"""The registered queries of the corpus operators and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm import bpe, decontamination, license_scan, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, spelling_variants, substring_dedup, token_counts, whitening
from chronoloom.llm import quality_rules as rules

QUERIES: dict = {}
ORACLES: dict = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(_docs(spark, sf_dir))


ORACLES["op1_quality_rules"] = rules.ORACLE_SQL


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_docs(spark, sf_dir), _vocabulary("piece_bpe_32k.model"), budget=4096)


@_query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_docs(spark, sf_dir), k=4, percent=80)


@_query
def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_docs(spark, sf_dir)).drop("blocks")


@_query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir), _vocabulary("byte_bpe_50k.json"))


@_query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_docs(spark, sf_dir)).drop("spans")


@_query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(_docs(spark, sf_dir))


@_query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_docs(spark, sf_dir)).withColumn("kept_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)).drop("text")


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(_docs(spark, sf_dir))


@_query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@_query
def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(_docs(spark, sf_dir), _vocabulary("byte_bpe_50k.json"))
