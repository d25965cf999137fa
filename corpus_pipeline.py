"""A corpus pipeline of the document operators: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import decontaminate, mixing, near_dedup, rules, sharding
from bazaarlake.llm.common import forget, stage


# Columns an operator does not read travel in one struct, so those it adds cannot clash with them.
PACKED = "_document"


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, *([F.struct(*rest).alias(PACKED)] if rest else []))


def unpacked(rows: DataFrame, docs: DataFrame, *more: str) -> DataFrame:
    """The columns of ``docs`` again, and ``more`` beside them where their names are free."""
    inside = rows.schema[PACKED].dataType.names if PACKED in rows.columns else []
    columns = [(F.col(PACKED)[c] if c in inside else F.col(f"`{c}`")).alias(c) for c in docs.columns]
    return rows.select(*columns, *[name for name in more if name not in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that base rules or the learned list reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = rules.quality_rules(packed(docs, "doc_id", "text"), labels)
    return unpacked(judged.filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_matches(packed(docs, "text"), benchmark)
    return unpacked(found.filter("not contaminated"), docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    return unpacked(mixing.emit(mixing.mix(packed(docs, "doc_id", "source", "text"))), docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place there."""
    placed = sharding.assign_shards(packed(docs, "doc_id", "text"))
    return unpacked(placed, docs, "size", "shard", "slot", "grown_shard")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

# Learned rules, shingle sketches and verbatim matches are beyond plain SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again, and freed by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        if before is not None:
            forget(before)
        before = docs
    return docs
