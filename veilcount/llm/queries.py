"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilcount.llm import alignment, credentials, decontaminate, licenses, manifest, mixing, neighbours, ngram_join, oracles, pii, shards, toxicity, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.report(_table(spark, sf_dir, "embeddings"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents"))


def op3_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(_table(spark, sf_dir, "documents"))


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_report(_table(spark, sf_dir, "documents"))


def op5_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(_table(spark, sf_dir, "documents"))


def op7_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.report(_table(spark, sf_dir, "pages"))


def op8_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.report(_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.report(_table(spark, sf_dir, "documents"))


def op13_warc_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(_table(spark, sf_dir, "pages"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_cross_polytope,
        op2_personal_data,
        op3_license_signatures,
        op4_feistel_shards,
        op5_temperature_mix,
        op6_ngram_join,
        op7_url_cascade,
        op8_credentials,
        op9_decontaminate,
        op10_toxicity,
        op11_token_alignment,
        op12_merkle_manifest,
        op13_warc_reader,
    )
}
ORACLES = oracles.ORACLES
