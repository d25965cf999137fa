"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import (
    alignment,
    decontaminate,
    language,
    licenses,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    phrases,
    rules,
    sharding,
    site_quality,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model).drop("text")
    return scored.withColumn("held_out", toxicity.held_out(F.col("doc_id")))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    return mixing.mix(sized, F.col("words")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op6_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator of op6 over pages, whose addresses give hosts and paths."""
    return site_quality.page_quality(
        table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["words"])), F.lit(0)).alias("longest"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.remove_later_lines(table(spark, sf_dir, "documents"), tokens_of=line_dedup.words)
    return kept.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.quality_rules(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", *rules.COUNTS, "base_failed", "kept"
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs)
    return language.identify(docs, model).select(
        "doc_id",
        language.held_out(F.col("doc_id")),
        "lang_pred",
        "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = [
        op1_toxicity,
        op2_near_dedup,
        op3_sharding,
        op4_licenses,
        op5_mixing,
        op6_site_quality,
        page_quality,
        op7_decontamination,
        op8_line_dedup,
        op9_quality_rules,
        op10_substring_dedup,
        op11_alignment,
        op12_language,
        op13_merkle,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    from bazaarlake.llm import sql

    return sql.ORACLE
