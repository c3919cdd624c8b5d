"""The registered queries over the driver's tables: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, linededup, lm, minhash, packing, quality, sharding, suffix, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strata are languages."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "shard", "depth", "shard_docs", "shard_bytes", "oversized")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the documents' sources. Returns the cleaned text's digest and how many lines went."""
    out = linededup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removals(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_minhash_near_dedup, op2_lm_scoring, op3_quality_rules, op4_sharding, op5_line_dedup, op6_benchmark_decontamination, op7_warc, op8_best_fit_packing, op9_language_id, op10_suffix_array_dedup)}
