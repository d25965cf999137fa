"""One row per key: the first under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINEAGE = ["source_filename", "ingestion_date", "ingest_ordinal"]


def recency() -> list[Column]:
    """Newest delivery first; file name and row position make the order total."""
    return [
        F.col("ingestion_date").desc(),
        F.col("source_filename").desc(),
        F.col("ingest_ordinal").desc(),
    ]


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key.

    The rank filter lets Spark keep one row per key in each input task before the shuffle, so a
    key that holds most of the rows sends at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def newest_per(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return first_per(df, keys, recency())
