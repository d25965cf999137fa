"""Sums of the orders of every fact folder, kept beside it and added up when asked.

A folder never changes, so its sums are taken once, when a load has written it; a reload that
replaces a folder replaces its part of the sums with it, and the parts of all other folders stay.
The sums of a table are those of its folders together, whatever loads they come from.

Distinct customers add up too: per folder and day there is a bitmap over the dense customer keys,
cut into buckets of 32,768. The customers of any days are counted by or-ing their bitmaps.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DAY = "transaction_date_key"
KEYS = [DAY, "customer_key", "merchant_key", "staff_key", "campaign_key"]
MEASURES = ["orders", "net", "discount", "delay", "availed", "on_time"]


def net_measures() -> list[Column]:
    """What the order queries need per dimension key: one pass gives sums that add up again."""
    return [
        F.count("*").alias("orders"),
        F.sum("net_order_amount").alias("net"),
        F.sum("discount_amount").alias("discount"),
        F.sum("delay_in_days").alias("delay"),
        F.count_if(F.col("availed_flag")).alias("availed"),
        F.count_if(F.col("delay_in_days") <= 0).alias("on_time"),
    ]


def order_sums(orders: DataFrame) -> DataFrame:
    """Measures per folder, kind of key and key, from one scan (``_folder`` names the folder)."""
    keys = [F.struct(F.lit(name).alias("kind"), F.col(name).cast("long").alias("key")) for name in KEYS]
    measured = ["net_order_amount", "discount_amount", "delay_in_days", "availed_flag"]
    exploded = orders.select("_folder", *measured, F.explode(F.array(*keys)).alias("k"))
    return exploded.groupBy("_folder", "k.kind", "k.key").agg(*net_measures())


def customer_days(orders: DataFrame) -> DataFrame:
    """Bitmaps of the customers with orders, and of those with several, per folder, day and bucket."""
    key = F.col("customer_key").cast("long")
    counted = orders.groupBy("_folder", F.col(DAY).alias("day"), key.alias("key")).agg(F.count("*").alias("n"))
    bit = F.bitmap_bit_position("key")
    return counted.groupBy("_folder", "day", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(bit).alias("customers"),
        F.bitmap_construct_agg(F.when(F.col("n") > 1, bit)).alias("again"),
    )


def distinct_customers(days: DataFrame, *period: Column) -> DataFrame:
    """Distinct customers per period, from the or of its daily bitmaps: no key is shuffled."""
    names = [f"_p{i}" for i in range(len(period))]
    cut = days.select(*[p.alias(n) for p, n in zip(period, names)], "bucket", "customers")
    per_bucket = cut.groupBy(*names, "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))
    return per_bucket.groupBy(*names).agg(
        F.coalesce(F.sum(F.bitmap_count("customers")), F.lit(0)).cast("long").alias("customers")
    )


def build(orders: DataFrame, target: str) -> str:
    """Writes the sums and bitmaps of the folders in ``orders`` and returns the name they go by."""
    load = f"load={uuid.uuid4().hex}"
    order_sums(orders).write.partitionBy("kind").parquet(f"{target}/orders/{load}")
    customer_days(orders).write.parquet(f"{target}/days/{load}")
    return load


_SUMS = (
    "_folder string, key long, orders long, net decimal(28,2), discount decimal(28,2), "
    "delay long, availed long, on_time long, kind string"
)
_DAYS = "_folder string, day int, bucket long, customers binary, again binary"


def _kept(
    spark: SparkSession, root: str, loads: Mapping[str, str], schema: str, fresh: DataFrame | None
) -> DataFrame | None:
    """Stored parts of the given folders, and ``fresh`` ones of folders that have none."""
    if not loads:
        return fresh
    paths = sorted({f"{root}/{load}" for load in loads.values()})
    # Old parts may still hold folders that are no longer in use; the list names a few hundred.
    stored = spark.read.schema(schema).option("basePath", root).parquet(*paths).drop("load")
    stored = stored.filter(F.col("_folder").isin(list(loads)))
    return stored if fresh is None else stored.unionByName(fresh)


class OrderSums:
    """The sums of one version of the fact: stored ones, and sums taken now of other folders."""

    def __init__(self, spark: SparkSession, root: str, loads: Mapping[str, str], rest: DataFrame | None):
        fresh = (None, None) if rest is None else (order_sums(rest), customer_days(rest))
        self.sums = _kept(spark, f"{root}/orders", loads, _SUMS, fresh[0])
        self.days = _kept(spark, f"{root}/days", loads, _DAYS, fresh[1])

    def by(self, key: str) -> DataFrame:
        """Measures per value of a key."""
        added = [F.sum(name).alias(name) for name in MEASURES]
        kind = F.col("kind") == key
        return self.sums.filter(kind).groupBy(F.col("key").alias(key)).agg(*added)

    def customers_since(self, first: int | None, name: str) -> DataFrame:
        """Distinct customers with orders from a day key on (all when None), as one number."""
        days = self.days if first is None else self.days.filter(F.col("day") >= first)
        return distinct_customers(days).select(F.col("customers").alias(name))

    def repeated_since(self, first: int) -> DataFrame:
        """``customers`` with orders from a day key on, and ``repeated``: those with several.

        A customer has several orders with two on one day (of one folder), or with one on a day
        that a bit of an earlier day already stands for. Bitmaps of a bucket are or-ed along the
        days; a bucket has one row per day and folder.
        """
        days = self.days.filter(F.col("day") >= first)
        along = Window.partitionBy("bucket").orderBy("day", "_folder")
        earlier = along.rowsBetween(Window.unboundedPreceding, -1)
        seen = days.withColumn("_seen", F.bitmap_or_agg("customers").over(earlier)).withColumn(
            "_first", F.row_number().over(along) == 1
        )
        both = (
            seen.filter(~F.col("_first"))
            .select("bucket", "day", "_folder", F.explode(F.array("_seen", "customers")).alias("bits"))
            .groupBy("bucket", "day", "_folder")
            .agg(F.bitmap_and_agg("bits").alias("again"))
        )
        several = days.select("bucket", "again").unionByName(both.select("bucket", "again"))
        several = several.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("again")).alias("repeated"))
        once = days.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("customers")).alias("customers"))
        return once.join(several, "bucket").agg(
            F.coalesce(F.sum("repeated"), F.lit(0)).cast("long").alias("repeated"),
            F.coalesce(F.sum("customers"), F.lit(0)).cast("long").alias("customers"),
        )

    def customers_by_month(self) -> DataFrame:
        """``year_month`` (yyyymm) and its distinct ``customers``."""
        month = F.floor(F.col("day") / 100).cast("int")
        return distinct_customers(self.days, month).withColumnRenamed("_p0", "year_month")
