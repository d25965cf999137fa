"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import forget, stage


def connected(links: DataFrame, name: str = "print") -> DataFrame:
    """``name`` and ``root`` (the smallest node of its component) for every node but the roots.

    Links (a, b) are rewritten until every node points at its root: a large step hangs a node's
    larger neighbours on its smallest one, a small step its smaller ones. Rounds grow with the
    logarithm of the size of a component. Smallest neighbours come from partial aggregates, so a
    node with very many links is not gathered in one task. Each round is a written table.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u != v")
        .distinct(),
        "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.filter("u != v").distinct()
        smallest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(smallest, "u")
            .filter("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(smallest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        contracted = stage(small, "edges")
        after = _mark(contracted)
        forget(edges)
        edges = contracted
        if after == mark:
            break
        mark = after
    return edges.select(F.col("u").alias(name), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())
