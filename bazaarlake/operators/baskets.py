"""How often two labels are bought in the same order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SMALL_BASKET = 32


def pair_counts(lines: DataFrame, label: str, small: int = SMALL_BASKET) -> DataFrame:
    """(label_a, label_b, pair_count) over all line pairs of an order with product a < product b.

    Repeated products of an order are counted once with a weight. Orders of at most ``small``
    products list their pairs (496 at most) from one sorted array. Larger ones are scanned by
    product with a running count per label, so a basket costs its products times its labels and
    no pair is listed. Neither joins the lines with themselves, and both use one shuffle by order.
    """
    weighted = lines.groupBy("order_id", "product_key", label).agg(F.count("*").alias("_n"))
    of_order = Window.partitionBy("order_id")
    sized = weighted.withColumn("_products", F.count("*").over(of_order))
    listed = _listed(sized.filter(F.col("_products") <= small), label)
    scanned = _scanned(sized.filter(F.col("_products") > small), label)
    return (
        listed.unionByName(scanned)
        .groupBy("label_a", "label_b")
        .agg(F.sum("pair_count").alias("pair_count"))
        .filter("pair_count > 0")
    )


def _listed(weighted: DataFrame, label: str) -> DataFrame:
    basket = weighted.groupBy("order_id").agg(
        F.array_sort(
            F.collect_list(F.struct(F.col("product_key").alias("p"), F.col(label).alias("l"), F.col("_n").alias("n")))
        ).alias("basket")
    )

    def with_later(a, i):
        later = F.slice("basket", i + 2, F.size("basket"))
        return F.transform(
            F.filter(later, lambda b: b["p"] > a["p"]),
            lambda b: F.struct(
                a["l"].alias("label_a"), b["l"].alias("label_b"), (a["n"] * b["n"]).alias("pair_count")
            ),
        )

    several = basket.filter(F.size("basket") > 1)
    pairs = several.select(F.explode(F.flatten(F.transform("basket", with_later))).alias("pair"))
    return pairs.groupBy("pair.label_a", "pair.label_b").agg(F.sum("pair.pair_count").alias("pair_count"))


def _scanned(weighted: DataFrame, label: str) -> DataFrame:
    """Every product meets, for each label of its order, the lines below it that carry the label."""
    labels = F.collect_set(F.struct(F.col(label).alias("l"))).over(Window.partitionBy("order_id"))
    wanted = weighted.withColumn("_labels", labels).withColumn("_a", F.explode("_labels")).drop("_labels")
    below = (
        Window.partitionBy("order_id", "_a")
        .orderBy("product_key")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    carries = F.when(F.col(label).eqNullSafe(F.col("_a.l")), F.col("_n")).otherwise(0)
    met = wanted.withColumn("_below", F.coalesce(F.sum(carries).over(below), F.lit(0)))
    return met.groupBy(F.col("_a.l").alias("label_a"), F.col(label).alias("label_b")).agg(
        F.sum(F.col("_below") * F.col("_n")).alias("pair_count")
    )
