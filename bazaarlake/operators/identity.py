"""Business keys of users, merchants, staff and products, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.text import (
    business_key,
    key_part,
    present,
    stamp_text,
    title_or_unknown,
)
from bazaarlake.operators.latest import LINEAGE, newest_per


def user_identity(stg_user_data: DataFrame) -> DataFrame:
    keyed = stg_user_data.filter(present(F.col("user_id"))).select(
        F.trim("user_id").alias("user_id"),
        business_key(
            key_part(F.col("user_id")),
            key_part(F.col("name")),
            stamp_text(F.col("birthdate")),
            key_part(F.col("gender")),
            stamp_text(F.col("creation_date")),
        ).alias("user_bk"),
        title_or_unknown(F.col("name")).alias("name"),
        stamp_text(F.col("birthdate")).alias("birthdate"),
        F.lower(F.trim("gender")).alias("gender"),
        stamp_text(F.col("creation_date")).alias("creation_date"),
        *LINEAGE,
    )
    return newest_per(keyed, ["user_bk"]).drop(*LINEAGE)


def merchant_identity(stg_merchant_data: DataFrame) -> DataFrame:
    keyed = stg_merchant_data.filter(present(F.col("merchant_id"))).select(
        business_key(
            key_part(F.col("merchant_id")),
            key_part(F.col("name")),
            stamp_text(F.col("creation_date")),
        ).alias("merchant_bk"),
        F.trim("merchant_id").alias("merchant_id"),
        title_or_unknown(F.col("name")).alias("name"),
        stamp_text(F.col("creation_date")).alias("creation_date"),
        *LINEAGE,
    )
    return newest_per(keyed, ["merchant_bk"]).drop(*LINEAGE)


def staff_identity(stg_staff: DataFrame) -> DataFrame:
    """Ids are upper-cased here as well, since cleaning upper-cases them before the lookup."""
    keyed = stg_staff.filter(present(F.col("staff_id"))).select(
        F.upper(F.trim("staff_id")).alias("staff_id"),
        business_key(key_part(F.col("staff_id")), stamp_text(F.col("creation_date"))).alias(
            "staff_bk"
        ),
        stamp_text(F.col("creation_date")).alias("creation_date"),
        *LINEAGE,
    )
    return newest_per(keyed, ["staff_bk"]).drop(*LINEAGE)


def product_identity(stg_product_list: DataFrame) -> DataFrame:
    keyed = stg_product_list.filter(present(F.col("product_id"))).select(
        F.trim("product_id").alias("product_id"),
        business_key(
            key_part(F.col("product_id")),
            key_part(F.col("product_name")),
            key_part(F.col("product_type")),
        ).alias("product_bk"),
        F.coalesce(F.lower(F.trim("product_name")), F.lit("unknown")).alias("product_name"),
        F.coalesce(F.lower(F.trim("product_type")), F.lit("unknown")).alias("product_type"),
        *LINEAGE,
    )
    return newest_per(keyed, ["product_bk"]).drop(*LINEAGE)
