"""Cleaned staging tables: trimmed, typed, keyed and without repeats."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.text import (
    PLACEHOLDER_IDS,
    attribute_hash,
    digits,
    digits_int,
    discount_fraction,
    lower_or_unknown,
    phone_dashed,
    present,
    repair_contractions,
    stamp_text,
    text_or_unknown,
    title_case,
    title_or_unknown,
)
from bazaarlake.operators.latest import LINEAGE, newest_per
from bazaarlake.operators.lookup import left_lookup
from bazaarlake.operators.ordinal import number_within

LINE_ORDER = ["ingestion_date", "source_filename", "ingest_ordinal"]
HOT_ORDER_LINES = 1_000_000


# --- orders -------------------------------------------------------------------------------


def clean_orders(stg_orders: DataFrame) -> DataFrame:
    cleaned = stg_orders.filter(
        present(F.col("order_id")) & present(F.col("user_id")) & F.col("transaction_date").isNotNull()
    ).select(
        F.trim("order_id").alias("order_id"),
        F.trim("user_id").alias("user_id"),
        digits_int(F.col("estimated_arrival")).alias("estimated_arrival"),
        "transaction_date",
        *LINEAGE,
    )
    return newest_per(cleaned, ["order_id"])


def clean_order_delays(stg_order_delays: DataFrame) -> DataFrame:
    cleaned = stg_order_delays.filter(
        present(F.col("order_id")) & F.col("delay_in_days").isNotNull()
    ).select(F.trim("order_id").alias("order_id"), "delay_in_days", *LINEAGE)
    return newest_per(cleaned, ["order_id"])


def line_prices(stg_line_items_prices: DataFrame) -> DataFrame:
    """Lines with a positive quantity and their total, not yet numbered."""
    priced = stg_line_items_prices.filter(F.col("order_id").isNotNull()).select(
        F.trim("order_id").alias("order_id"),
        F.coalesce(F.col("price"), F.lit(0)).cast("decimal(18,2)").alias("price"),
        digits_int(F.col("quantity")).alias("quantity"),
        *LINEAGE,
    )
    total = (F.col("price") * F.col("quantity")).cast("decimal(28,2)")
    return priced.filter("quantity > 0").withColumn("line_total_amount", total)


def clean_line_prices(
    stg_line_items_prices: DataFrame, hot_rows: int = HOT_ORDER_LINES
) -> DataFrame:
    """Numbering comes after the quantity filter: a dropped line moves the following ones up."""
    return number_within(
        line_prices(stg_line_items_prices), "order_id", LINE_ORDER, "line_item_seq", hot_rows
    )


def line_products(stg_line_items_products: DataFrame) -> DataFrame:
    """Product lines, not yet numbered."""
    return stg_line_items_products.filter(F.col("order_id").isNotNull()).select(
        F.trim("order_id").alias("order_id"),
        F.trim("product_name").alias("product_name"),
        F.upper(F.trim("product_id")).alias("product_id"),
        *LINEAGE,
    )


def clean_line_products(
    stg_line_items_products: DataFrame, hot_rows: int = HOT_ORDER_LINES
) -> DataFrame:
    cleaned = line_products(stg_line_items_products)
    return number_within(cleaned, "order_id", LINE_ORDER, "line_item_seq", hot_rows)


def clean_order_merchant(
    stg_order_merchant: DataFrame, merchant_identity: DataFrame, staff_identity: DataFrame
) -> DataFrame:
    """Newest merchant and staff of each order with their business keys.

    An id used by several identities takes the smallest business key. Reducing the lookups to
    one row per id first gives that without multiplying the orders.
    """
    newest = newest_per(
        stg_order_merchant.filter(present(F.col("order_id"))).select(
            F.trim("order_id").alias("order_id"),
            F.trim("merchant_id").alias("merchant_id"),
            F.upper(F.trim("staff_id")).alias("staff_id"),
            *LINEAGE,
        ),
        ["order_id"],
    )
    merchants = merchant_identity.groupBy("merchant_id").agg(
        F.min("merchant_bk").alias("merchant_bk")
    )
    staff = staff_identity.groupBy("staff_id").agg(F.min("staff_bk").alias("staff_bk"))
    keyed = left_lookup(newest, merchants, "merchant_id", "order_id")
    keyed = left_lookup(keyed, staff, "staff_id", "order_id")
    return keyed.select("order_id", "merchant_id", "merchant_bk", "staff_id", "staff_bk", *LINEAGE)


# --- campaigns and products -----------------------------------------------------------------


def clean_campaigns(stg_campaign: DataFrame) -> DataFrame:
    cleaned = stg_campaign.filter(present(F.col("campaign_id"))).select(
        F.upper(F.trim("campaign_id")).alias("campaign_id"),
        repair_contractions(title_case(F.trim("campaign_name"))).alias("campaign_name"),
        F.trim("campaign_description").alias("campaign_description"),
        discount_fraction(F.col("discount")).alias("discount_value"),
        *LINEAGE,
    )
    return newest_per(cleaned, ["campaign_id"])


def clean_campaign_transactions(stg_campaign_transactions: DataFrame) -> DataFrame:
    cleaned = stg_campaign_transactions.filter(
        present(F.col("order_id")) & present(F.col("campaign_id"))
    ).select(
        F.upper(F.trim("campaign_id")).alias("campaign_id"),
        F.trim("order_id").alias("order_id"),
        "transaction_date",
        digits_int(F.col("estimated_arrival")).alias("estimated_arrival"),
        F.coalesce(F.col("availed") == 1, F.lit(False)).alias("availed"),
        *LINEAGE,
    )
    return newest_per(cleaned, ["campaign_id", "order_id"])


def clean_products(stg_product_list: DataFrame) -> DataFrame:
    product_id = F.upper(F.trim("product_id"))
    cleaned = (
        stg_product_list.filter(present(F.col("product_id")) & ~product_id.isin(PLACEHOLDER_IDS))
        .select(
            product_id.alias("product_id"),
            repair_contractions(title_case(F.trim("product_name"))).alias("product_name"),
            title_case(F.replace(F.trim("product_type"), F.lit("_"), F.lit(" "))).alias(
                "product_type"
            ),
            F.greatest(F.coalesce(F.col("price"), F.lit(0)), F.lit(0))
            .cast("decimal(18,2)")
            .alias("price"),
            *LINEAGE,
        )
        .withColumn("product_bk", F.md5("product_id"))
        .withColumn(
            "product_attribute_hash",
            attribute_hash(F.col("product_name"), F.col("product_type"), F.col("price")),
        )
    )
    return newest_per(cleaned, ["product_id"])


# --- merchants and staff --------------------------------------------------------------------


def clean_merchants(stg_merchant_data: DataFrame, merchant_identity: DataFrame) -> DataFrame:
    cleaned = stg_merchant_data.filter(present(F.col("merchant_id"))).select(
        F.trim("merchant_id").alias("merchant_id"),
        "creation_date",
        title_or_unknown(F.col("name")).alias("name"),
        title_or_unknown(F.col("street")).alias("street"),
        title_or_unknown(F.col("state")).alias("state"),
        title_or_unknown(F.col("city")).alias("city"),
        text_or_unknown(F.col("country")).alias("country"),
        phone_dashed(F.col("contact_number")).alias("contact_number"),
        stamp_text(F.col("creation_date")).alias("_created"),
        *LINEAGE,
    )
    lookup = merchant_identity.withColumnRenamed("creation_date", "_created")
    keyed = cleaned.join(lookup, ["merchant_id", "name", "_created"]).drop("_created")
    return newest_per(
        keyed,
        [
            "merchant_bk",
            "creation_date",
            "street",
            "state",
            "city",
            "country",
            "contact_number",
        ],
    )


def clean_staff(stg_staff: DataFrame, staff_identity: DataFrame) -> DataFrame:
    cleaned = stg_staff.filter(present(F.col("staff_id"))).select(
        F.upper(F.trim("staff_id")).alias("staff_id"),
        title_or_unknown(F.col("name")).alias("name"),
        title_or_unknown(F.col("job_level")).alias("job_level"),
        title_or_unknown(F.col("street")).alias("street"),
        title_or_unknown(F.col("city")).alias("city"),
        title_or_unknown(F.col("state")).alias("state"),
        title_or_unknown(F.col("country")).alias("country"),
        digits(F.col("contact_number")).alias("contact_number"),
        "creation_date",
        stamp_text(F.col("creation_date")).alias("_created"),
        *LINEAGE,
    )
    lookup = staff_identity.withColumnRenamed("creation_date", "_created")
    keyed = cleaned.join(lookup, ["staff_id", "_created"]).drop("_created")
    return newest_per(
        keyed,
        [
            "staff_bk",
            "creation_date",
            "job_level",
            "street",
            "state",
            "city",
            "country",
            "contact_number",
        ],
    )


# --- users ----------------------------------------------------------------------------------

USER_LOOKUP = ["user_id", "name"]


def user_profiles(stg_user_data: DataFrame) -> DataFrame:
    return stg_user_data.filter(present(F.col("user_id"))).select(
        F.trim("user_id").alias("user_id"),
        "creation_date",
        title_or_unknown(F.col("name")).alias("name"),
        title_or_unknown(F.col("street")).alias("street"),
        title_or_unknown(F.col("state")).alias("state"),
        title_or_unknown(F.col("city")).alias("city"),
        text_or_unknown(F.col("country")).alias("country"),
        "birthdate",
        lower_or_unknown(F.col("gender")).alias("gender"),
        text_or_unknown(F.col("device_address"), "unknown").alias("device_address"),
        lower_or_unknown(F.col("user_type")).alias("user_type"),
        *LINEAGE,
    )


def user_jobs(stg_user_job: DataFrame) -> DataFrame:
    return stg_user_job.filter(present(F.col("user_id"))).select(
        F.trim("user_id").alias("user_id"),
        title_or_unknown(F.col("name")).alias("name"),
        title_or_unknown(F.col("job_title")).alias("job_title"),
        title_or_unknown(F.col("job_level")).alias("job_level"),
        *LINEAGE,
    )


def user_cards(stg_user_credit_card: DataFrame) -> DataFrame:
    return stg_user_credit_card.filter(
        present(F.col("user_id")) & present(F.col("credit_card_number"))
    ).select(
        F.trim("user_id").alias("user_id"),
        title_or_unknown(F.col("name")).alias("name"),
        F.trim("credit_card_number").alias("credit_card_number"),
        F.coalesce(F.lower(F.trim("issuing_bank")), F.lit("unknown")).alias("issuing_bank"),
        *LINEAGE,
    )


def _user_keys(user_identity: DataFrame) -> DataFrame:
    return user_identity.select(*USER_LOOKUP, "user_bk")


@dataclass(frozen=True)
class SharedRows:
    """Cleaned rows of users, kept once per (user id, name) instead of once per key that shares it.

    ``classes`` hold the distinct rows of each (user id, name), ``members`` its keys. A key belongs
    to one (user id, name), so both together say the same as their join, and stay linear in the
    input where the join grows with the product of the two sides.
    """

    classes: DataFrame
    members: DataFrame

    def expanded(self) -> DataFrame:
        """One row per key and class."""
        return self.classes.join(self.members, USER_LOOKUP)

    def rows_per_key(self) -> DataFrame:
        """``user_bk`` and its ``row_count``, without the rows themselves."""
        counts = self.classes.groupBy(*USER_LOOKUP).agg(F.count("*").alias("row_count"))
        return counts.join(self.members, USER_LOOKUP).select("user_bk", "row_count")


def _shared(rows: DataFrame, told_apart: list[str], user_identity: DataFrame) -> SharedRows:
    return SharedRows(newest_per(rows, [*USER_LOOKUP, *told_apart]), _user_keys(user_identity))


def shared_user_data(stg_user_data: DataFrame, user_identity: DataFrame) -> SharedRows:
    told_apart = [
        "creation_date",
        "birthdate",
        "gender",
        "street",
        "state",
        "city",
        "country",
        "device_address",
        "user_type",
    ]
    return _shared(user_profiles(stg_user_data), told_apart, user_identity)


def shared_user_job(stg_user_job: DataFrame, user_identity: DataFrame) -> SharedRows:
    return _shared(user_jobs(stg_user_job), ["job_title", "job_level"], user_identity)


def shared_user_credit_card(stg_user_credit_card: DataFrame, user_identity: DataFrame) -> SharedRows:
    told_apart = ["credit_card_number", "issuing_bank"]
    return _shared(user_cards(stg_user_credit_card), told_apart, user_identity)


def clean_user_data(stg_user_data: DataFrame, user_identity: DataFrame) -> DataFrame:
    return shared_user_data(stg_user_data, user_identity).expanded()


def clean_user_job(stg_user_job: DataFrame, user_identity: DataFrame) -> DataFrame:
    return shared_user_job(stg_user_job, user_identity).expanded()


def clean_user_credit_card(stg_user_credit_card: DataFrame, user_identity: DataFrame) -> DataFrame:
    return shared_user_credit_card(stg_user_credit_card, user_identity).expanded()


def customer_source(
    stg_user_data: DataFrame,
    stg_user_job: DataFrame,
    stg_user_credit_card: DataFrame,
    user_identity: DataFrame,
) -> DataFrame:
    """Newest profile, job and card of every user key, ready for the customer dimension.

    Keys are found through (user_id, name), so the newest row per (user_id, name) is also the
    newest per key. Reducing before the joins keeps all four inputs on one partitioning and
    never multiplies rows where several keys share a user.
    """
    profile = newest_per(user_profiles(stg_user_data), USER_LOOKUP).drop(*LINEAGE)
    job = newest_per(user_jobs(stg_user_job), USER_LOOKUP).drop(*LINEAGE)
    card = newest_per(user_cards(stg_user_credit_card), USER_LOOKUP).drop(*LINEAGE)
    source = (
        profile.join(_user_keys(user_identity), USER_LOOKUP)
        .join(job, USER_LOOKUP, "left")
        .join(card, USER_LOOKUP, "left")
    )
    for column in ["job_title", "job_level", "credit_card_number", "issuing_bank"]:
        source = source.withColumn(column, F.coalesce(F.col(column), F.lit("Unknown")))
    return source
