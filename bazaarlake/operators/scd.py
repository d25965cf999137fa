"""Slowly changing dimensions: what a delivery changes, the versions it closes and begins."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.text import attribute_hash
from bazaarlake.operators.cleaning import LINEAGE
from bazaarlake.operators.latest import newest_per
from bazaarlake.operators.ordinal import highest_key, surrogate_keys
from bazaarlake.sources.schemas import WAREHOUSE, conform

BEGINNING = "1900-01-01 00:00:00"
UNKNOWN_KEY = -1


def differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True when any pair differs, NULLs counting as equal to each other."""
    return reduce(lambda a, b: a | b, [~new.eqNullSafe(old) for new, old in pairs])


def scd2_changes(
    current: DataFrame, source: DataFrame, key: str, bk: str, tracked: Sequence[str]
) -> DataFrame:
    """Source rows that are new or differ from their current version, with ``_old_key``."""
    live = current.filter("is_current").select(
        bk, F.col(key).alias("_old_key"), *[F.col(c).alias(f"_old_{c}") for c in tracked]
    )
    changed = differs([(F.col(c), F.col(f"_old_{c}")) for c in tracked])
    return (
        source.join(live, bk, "left")
        .filter(F.col("_old_key").isNull() | changed)
        .drop(*[f"_old_{c}" for c in tracked])
    )


@dataclass(frozen=True)
class Type2:
    """How a dimension keeps versions: its keys, what a change is, where its rows come from."""

    table: str
    key: str
    bk: str
    tracked: tuple[str, ...]
    # Cleaned table the rows come from, and what makes one row per business key of it.
    source: str
    one_per_key: Callable[[DataFrame], DataFrame]
    # Values of the member with key -1, if there is one.
    unknown: dict | None = None
    # When the first version of a member begins; None for the time of the load.
    first_effective: str | None = BEGINNING


def scd2_inserts(kind: Type2, current: DataFrame, changes: DataFrame, now: str) -> DataFrame:
    """New versions of the changes: one begins at ``now``, that of a member seen for the first
    time at ``first_effective``. The unknown member comes along when it is not there yet."""
    moment = F.lit(now).cast("timestamp")
    first = moment if kind.first_effective is None else F.lit(kind.first_effective).cast("timestamp")
    begun = (
        changes.withColumn("is_current", F.lit(True))
        .withColumn("effective_date", F.when(F.col("_old_key").isNull(), first).otherwise(moment))
        .withColumn("end_date", F.lit(None).cast("timestamp"))
    )
    inserted = surrogate_keys(
        begun,
        kind.key,
        spread=F.col(kind.bk),
        order=[kind.bk],
        start=highest_key(current, kind.key),
    )
    inserted = conform(inserted, WAREHOUSE[kind.table])
    if kind.unknown is None:
        return inserted
    return inserted.unionByName(unknown_member(kind.table, current, kind.key, kind.unknown))


def scd2_apply(kind: Type2, rows: DataFrame, changes: DataFrame, now: str) -> DataFrame:
    """Rows of the dimension, those whose member changes closed one second before ``now``."""
    closing = changes.filter(F.col("_old_key").isNotNull()).select(
        F.col("_old_key").alias(kind.key), F.lit(True).alias("_closing")
    )
    closed = F.col("_closing").isNotNull()
    end = F.lit(now).cast("timestamp") - F.expr("interval 1 second")
    applied = (
        rows.join(closing, kind.key, "left")
        .withColumn("is_current", F.col("is_current") & ~closed)
        .withColumn("end_date", F.when(closed, end).otherwise(F.col("end_date")))
    )
    return conform(applied, WAREHOUSE[kind.table])


def unknown_member(table: str, dimension: DataFrame, key: str, values: dict) -> DataFrame:
    """The row with key -1, unless the dimension has it."""
    literals = {key: UNKNOWN_KEY, **values}
    schema = WAREHOUSE[table]
    member = dimension.sparkSession.range(1).select(
        [F.lit(literals.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    present = dimension.filter(F.col(key) == UNKNOWN_KEY).select(key)
    return member.join(present, key, "left_anti").select(*schema.names)


_OPEN = {"is_current": True, "effective_date": BEGINNING}
_STAFF_HASHED = ["name", "job_level", "street", "city", "state", "country", "contact_number"]


def _newest(bk: str) -> Callable[[DataFrame], DataFrame]:
    return lambda clean: newest_per(clean, [bk]).drop(*LINEAGE)


def _staff(clean: DataFrame) -> DataFrame:
    return _newest("staff_bk")(clean).withColumn(
        "staff_attribute_hash", attribute_hash(*[F.col(c) for c in _STAFF_HASHED])
    )


TYPE2 = {
    kind.table: kind
    for kind in [
        # Gender, birth and creation date are inside the business key; the user id is not compared.
        Type2(
            "dim_customer",
            "customer_key",
            "user_bk",
            (
                "name",
                "street",
                "city",
                "state",
                "country",
                "device_address",
                "user_type",
                "job_title",
                "job_level",
                "credit_card_number",
                "issuing_bank",
            ),
            "customer_source",
            lambda source: source,
            {**_OPEN, "user_bk": "UNKNOWN", "user_id": "UNKNOWN", "name": "Unknown Customer"},
        ),
        Type2(
            "dim_merchant",
            "merchant_key",
            "merchant_bk",
            ("street", "city", "state", "country", "contact_number"),
            "merchants",
            _newest("merchant_bk"),
            {**_OPEN, "merchant_bk": "UNKNOWN", "merchant_id": "UNKNOWN", "name": "Unknown Merchant"},
        ),
        Type2(
            "dim_staff",
            "staff_key",
            "staff_bk",
            ("staff_attribute_hash",),
            "staff",
            _staff,
            {
                **_OPEN,
                "staff_bk": "UNKNOWN",
                "staff_id": "UNKNOWN",
                "name": "Unknown Staff",
                "staff_attribute_hash": hashlib.md5(b"UNKNOWN").hexdigest(),
            },
        ),
        # New products start at the load; there is no unknown product.
        Type2(
            "dim_product",
            "product_key",
            "product_bk",
            ("product_attribute_hash",),
            "products",
            lambda clean: clean.drop(*LINEAGE),
            first_effective=None,
        ),
    ]
}


def load_dim_campaign(current: DataFrame, clean_campaigns: DataFrame) -> DataFrame:
    """Type 1: values of known ids are overwritten, their keys stay."""
    values = ["campaign_name", "campaign_description", "discount_value"]
    new = clean_campaigns.select(
        "campaign_id", *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_given")
    )
    updated = current.join(new, "campaign_id", "left").select(
        "campaign_key",
        "campaign_id",
        *[
            F.when(F.col("_given"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            for c in values
        ],
    )
    added = surrogate_keys(
        clean_campaigns.join(current, "campaign_id", "left_anti"),
        "campaign_key",
        spread=F.md5("campaign_id"),
        order=["campaign_id"],
        start=highest_key(current, "campaign_key"),
    )
    schema = WAREHOUSE["dim_campaign"]
    merged = conform(updated, schema).unionByName(conform(added, schema))
    unknown = {
        "campaign_id": "UNKNOWN",
        "campaign_name": "Unknown Campaign",
        "campaign_description": "Unknown",
        "discount_value": 0,
    }
    return merged.unionByName(unknown_member("dim_campaign", current, "campaign_key", unknown))
