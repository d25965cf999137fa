"""Order and line-item facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.functions.dates import date_key
from bazaarlake.operators import asof
from bazaarlake.operators.cleaning import HOT_ORDER_LINES, LINE_ORDER
from bazaarlake.operators.latest import first_per
from bazaarlake.operators.lookup import left_lookup, spread_missing
from bazaarlake.operators.ordinal import (
    highest_key,
    number_in_chunks,
    number_usual,
    split_hot,
    surrogate_keys,
)
from bazaarlake.sources.schemas import WAREHOUSE, conform

_LINES_PER_KEY_CHUNK = 65_536
# Up to so many versions of a member are met by a plain join.
FEW_VERSIONS = 64
PRICE = "struct<unit_price: decimal(18,2), quantity: int, line_total_amount: decimal(28,2)>"

# Columns an order already loaded takes over from a later delivery; all others stay.
UPDATED_BY_RELOAD = [
    "order_total_amount",
    "net_order_amount",
    "discount_amount",
    "number_of_items",
    "delay_in_days",
    "actual_arrival_date_key",
    "campaign_key",
    "availed_flag",
]


def campaign_per_order(clean_campaign_transactions: DataFrame) -> DataFrame:
    """The campaign of an order: an availed one if there is any, then the newest."""
    order = [
        F.col("availed").desc(),
        F.col("ingestion_date").desc(),
        F.col("source_filename").desc(),
        F.col("ingest_ordinal").desc(),
        F.col("campaign_id").asc(),
    ]
    return first_per(clean_campaign_transactions, ["order_id"], order).select(
        "order_id", "campaign_id", "availed"
    )


def order_metrics(line_prices: DataFrame) -> DataFrame:
    return line_prices.groupBy("order_id").agg(
        F.sum("quantity").alias("number_of_items"),
        F.sum("line_total_amount").cast("decimal(18,2)").alias("order_total_amount"),
    )


def as_of_version(
    rows: DataFrame,
    dimension: DataFrame,
    on: str,
    at: str,
    key: str,
    effective: str,
    most: int | None = None,
    few: int | None = None,
) -> DataFrame:
    """Left join to the versions valid at the date ``at``, adding ``key`` and ``effective``.

    Several matches stay; the caller chooses among them. ``most`` is the highest number of
    versions a member can have, where the caller knows it: a load adds one at most. Up to
    ``few`` of them (``FEW_VERSIONS`` when not given) are met by an equality join with the interval as residual. Members
    with more are looked up along time instead (``operators.asof``), once per member and moment.
    """
    versions = dimension.select(
        F.col(on).alias("_on"),
        F.col(key),
        F.col("effective_date").alias(effective),
        F.col("end_date").alias("_end"),
    )
    rows = rows.withColumn("_lookup", spread_missing(on, "order_id")).withColumn(
        "_moment", F.col(at).cast("timestamp")
    )
    few = FEW_VERSIONS if few is None else few
    if most is not None and most <= few:
        found = asof.by_interval(rows, versions, effective)
    else:
        found = asof.along_time(rows, versions, effective, few)
    return found.drop("_lookup", "_moment", "_on", "_end")


def orders_with_versions(
    orders: DataFrame,
    bridge: DataFrame,
    dim_customer: DataFrame,
    dim_merchant: DataFrame,
    dim_staff: DataFrame,
    most: int | None = None,
) -> DataFrame:
    """Orders with the customer, merchant and staff versions valid on their date.

    ``most``: versions a member can have, where known.
    """
    at = "transaction_date"
    # Several customers may share a user id, each with versions of its own. They are looked up
    # before the bridge comes in, so its long business keys are not shuffled by user.
    rows = as_of_version(orders, dim_customer, "user_id", at, "customer_key", "_customer_from")
    rows = rows.join(bridge.select("order_id", "merchant_bk", "staff_bk"), "order_id", "left")
    rows = as_of_version(rows, dim_merchant, "merchant_bk", at, "merchant_key", "_merchant_from", most)
    return as_of_version(rows, dim_staff, "staff_bk", at, "staff_key", "_staff_from", most)


def one_row_per_order(rows: DataFrame) -> DataFrame:
    """Latest customer version, then latest merchant version; keys make the order total."""
    order = [
        F.col(c).desc()
        for c in [
            "_customer_from",
            "_merchant_from",
            "customer_key",
            "merchant_key",
            "_staff_from",
            "staff_key",
        ]
    ]
    return first_per(rows, ["order_id"], order)


def build_fact_order(
    orders: DataFrame,
    bridge: DataFrame,
    campaigns: DataFrame,
    delays: DataFrame,
    metrics: DataFrame,
    dim_customer: DataFrame,
    dim_merchant: DataFrame,
    dim_staff: DataFrame,
    dim_campaign: DataFrame,
    most: int | None = None,
) -> DataFrame:
    """One row per order that has priced lines."""
    versioned = one_row_per_order(
        orders_with_versions(orders, bridge, dim_customer, dim_merchant, dim_staff, most)
    )
    joined = (
        versioned.join(metrics, "order_id")
        .join(campaigns, "order_id", "left")
        .join(delays.select("order_id", "delay_in_days"), "order_id", "left")
    )
    rates = dim_campaign.select("campaign_id", "campaign_key", "discount_value")
    joined = left_lookup(joined, rates, "campaign_id", "order_id")
    unknown = F.lit(-1)
    availed = F.coalesce(F.col("availed"), F.lit(False))
    total = F.coalesce(F.col("order_total_amount"), F.lit(0)).cast("decimal(18,2)")
    rate = F.coalesce(F.col("discount_value"), F.lit(0)).cast("decimal(18,2)")
    discount = F.when(availed, total * rate).otherwise(F.lit(0).cast("decimal(36,4)"))
    delay = F.coalesce(F.col("delay_in_days"), F.lit(0))
    estimated = F.date_add("transaction_date", F.col("estimated_arrival"))
    fact = joined.select(
        "order_id",
        F.coalesce("customer_key", unknown).alias("customer_key"),
        F.coalesce("merchant_key", unknown).alias("merchant_key"),
        F.coalesce("staff_key", unknown).alias("staff_key"),
        F.coalesce("campaign_key", unknown).alias("campaign_key"),
        date_key(F.col("transaction_date")).alias("transaction_date_key"),
        date_key(estimated).alias("estimated_arrival_date_key"),
        date_key(F.date_add(estimated, delay)).alias("actual_arrival_date_key"),
        availed.alias("availed_flag"),
        total.alias("order_total_amount"),
        discount.cast("decimal(18,2)").alias("discount_amount"),
        (total - discount).cast("decimal(18,2)").alias("net_order_amount"),
        F.coalesce("number_of_items", F.lit(0)).alias("number_of_items"),
        delay.alias("delay_in_days"),
    )
    return conform(fact, WAREHOUSE["fact_order"])


def upsert_fact_order(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """New orders are added; known ones take over ``UPDATED_BY_RELOAD`` only."""
    columns = [c for c in WAREHOUSE["fact_order"].names if c != "order_id"]
    old = existing.select(
        "order_id", F.lit(True).alias("_old"), *[F.col(c).alias(f"_old_{c}") for c in columns]
    )
    new = incoming.withColumn("_new", F.lit(True))
    take_new = {
        c: F.col("_new").isNotNull()
        if c in UPDATED_BY_RELOAD
        else F.col("_old").isNull()
        for c in columns
    }
    return old.join(new, "order_id", "full_outer").select(
        "order_id",
        *[F.when(take_new[c], F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in columns],
    )


def match_lines(
    product_lines: DataFrame, price_lines: DataFrame, hot_rows: int = HOT_ORDER_LINES
) -> DataFrame:
    """n-th product line of an order with its n-th price line; the rest is dropped.

    Product lines have a ``product_id`` and, where it is wanted, a ``product_name``.
    Both kinds are shuffled by order together, numbered per order and kind and zipped by their
    number, all in one exchange of the lines. Orders with more than ``hot_rows`` lines are
    numbered in chunks of row positions and zipped by (order, number) instead.
    """
    product = F.struct(*[c for c in ["product_id", "product_name"] if c in product_lines.columns])
    product_type = product_lines.select(product.alias("product")).schema["product"].dataType
    lines = product_lines.select(
        "order_id",
        *LINE_ORDER,
        product.alias("product"),
        F.lit(None).cast(PRICE).alias("price"),
    ).unionByName(
        price_lines.select(
            "order_id",
            *LINE_ORDER,
            F.lit(None).cast(product_type).alias("product"),
            F.struct(F.col("price").alias("unit_price"), "quantity", "line_total_amount").cast(PRICE).alias("price"),
        )
    )
    lines = lines.withColumn("kind", F.col("price").isNotNull())
    usual, large = split_hot(lines, "order_id", hot_rows)
    of_kind = ["order_id", "kind"]
    usual = number_usual(usual.repartition("order_id"), of_kind, LINE_ORDER, "line_item_seq")
    if large is None:
        return _zipped(usual)
    large = number_in_chunks(large, of_kind, LINE_ORDER, "line_item_seq")
    return _zipped(usual).unionByName(_zipped(large))


def _zipped(numbered: DataFrame) -> DataFrame:
    # A number of an order has a product line at most, and a price line at most after it.
    pair = Window.partitionBy("order_id", "line_item_seq").orderBy("kind")
    paired = numbered.withColumn("_priced", F.lead("price").over(pair)).filter(~F.col("kind"))
    whole = paired.filter("product.product_id is not null and _priced is not null")
    return whole.select("order_id", "product.*", "_priced.*", "line_item_seq")


def lines_with_product(matched: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Product key of the current version, whatever the date; unknown products are dropped."""
    current = dim_product.filter("is_current").select("product_id", "product_key")
    return matched.join(current, "product_id").select(
        "order_id", "line_item_seq", "product_key", "quantity", "unit_price", "line_total_amount"
    )


def replace_lines(
    existing: DataFrame,
    reloaded: DataFrame,
    lines: DataFrame,
    key_start: Column | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Lines of reloaded orders make room for the new ones.

    Orders are spread over key buckets in pieces of 65,536 lines, so a very large order is not
    numbered in one task. Keys go on after ``key_start``, by default after those of ``existing``.
    ``stage``: as of ``surrogate_keys``.
    """
    kept = existing.join(reloaded.select("order_id"), "order_id", "left_anti")
    piece = F.floor(F.col("line_item_seq") / _LINES_PER_KEY_CHUNK).cast("string")
    keyed = surrogate_keys(
        lines,
        "line_item_key",
        spread=F.md5(F.concat_ws("/", "order_id", piece)),
        order=["order_id", "line_item_seq"],
        start=highest_key(existing, "line_item_key") if key_start is None else key_start,
        digits=4,
        stage=stage,
    )
    schema = WAREHOUSE["fact_order_line_item"]
    return conform(kept, schema).unionByName(conform(keyed, schema))
