"""The training-data queries of the entry file and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from allelic.llm import (bloom_lm, centroids, decontaminate, exact_dedup, fill_middle, licenses, mixing, packing,
                         personal_data, quality, simhash, token_store, warc)
from allelic.llm.common import ship_package, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_round_trip(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_digest(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.language_scores(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_digest(table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_digest(table(spark, sf_dir, "documents"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _shipped(f) for f in (
        op1_warc, op2_exact_dedup, op3_token_ids, op4_quality, op5_licenses, op6_mixing, op7_simhash, op8_decontamination,
        op9_personal_data, op10_language_model, op11_packing, op12_centroids, op13_fill_middle)}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": warc.ORACLE, "op2_exact_dedup": exact_dedup.ORACLE, "op6_mixing": mixing.ORACLE,
            "op8_decontamination": decontaminate.ORACLE, "op12_centroids": centroids.ORACLE, "op13_fill_middle": fill_middle.ORACLE}
