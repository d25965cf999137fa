"""Fixed schemas of the staging and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LINEAGE = "source_filename string, ingestion_date timestamp, ingest_ordinal bigint"

_STAGING = {
    "stg_product_list": (
        "product_id string, product_name string, product_type string, price decimal(8,2)"
    ),
    "stg_line_items_products": "order_id string, product_name string, product_id string",
    "stg_line_items_prices": "order_id string, price decimal(8,2), quantity string",
    "stg_orders": (
        "order_id string, user_id string, estimated_arrival string, transaction_date date"
    ),
    "stg_order_delays": "order_id string, delay_in_days int",
    "stg_user_data": (
        "user_id string, creation_date timestamp, name string, street string, state string, "
        "city string, country string, birthdate timestamp, gender string, "
        "device_address string, user_type string"
    ),
    "stg_user_job": "user_id string, name string, job_title string, job_level string",
    "stg_user_credit_card": (
        "user_id string, name string, credit_card_number string, issuing_bank string"
    ),
    "stg_merchant_data": (
        "merchant_id string, creation_date timestamp, name string, street string, state string, "
        "city string, country string, contact_number string"
    ),
    "stg_order_merchant": "order_id string, merchant_id string, staff_id string",
    "stg_staff": (
        "staff_id string, name string, job_level string, street string, state string, "
        "city string, country string, contact_number string, creation_date timestamp"
    ),
    "stg_campaign": (
        "campaign_id string, campaign_name string, campaign_description string, discount string"
    ),
    "stg_campaign_transactions": (
        "transaction_date date, campaign_id string, order_id string, "
        "estimated_arrival string, availed int"
    ),
}

_VALIDITY = "is_current boolean, effective_date timestamp, end_date timestamp"

_WAREHOUSE = {
    "dim_product": (
        f"product_key bigint, product_bk string, {_VALIDITY}, product_id string, "
        "product_name string, product_type string, price decimal(18,2), "
        "product_attribute_hash string"
    ),
    "dim_merchant": (
        f"merchant_key bigint, merchant_bk string, merchant_id string, {_VALIDITY}, "
        "name string, contact_number string, street string, city string, state string, "
        "country string, creation_date timestamp"
    ),
    "dim_staff": (
        f"staff_key bigint, staff_bk string, {_VALIDITY}, staff_id string, name string, "
        "job_level string, street string, city string, state string, country string, "
        "contact_number string, creation_date timestamp, staff_attribute_hash string"
    ),
    "dim_customer": (
        f"customer_key bigint, user_bk string, {_VALIDITY}, user_id string, name string, "
        "gender string, birthdate timestamp, creation_date timestamp, street string, "
        "city string, state string, country string, device_address string, user_type string, "
        "job_title string, job_level string, credit_card_number string, issuing_bank string"
    ),
    "dim_campaign": (
        "campaign_key bigint, campaign_id string, campaign_name string, "
        "campaign_description string, discount_value decimal(18,2)"
    ),
    "dim_date": (
        "date_key int, full_date date, day int, month int, year int, month_name string, "
        "quarter int, day_of_week int"
    ),
    "fact_order": (
        "order_id string, customer_key bigint, merchant_key bigint, staff_key bigint, "
        "campaign_key bigint, transaction_date_key int, estimated_arrival_date_key int, "
        "actual_arrival_date_key int, availed_flag boolean, order_total_amount decimal(18,2), "
        "discount_amount decimal(18,2), net_order_amount decimal(18,2), number_of_items bigint, "
        "delay_in_days int"
    ),
    "fact_order_line_item": (
        "line_item_key bigint, order_id string, product_key bigint, quantity int, "
        "unit_price decimal(18,2), line_total_amount decimal(18,2)"
    ),
}

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(8,2)": T.DecimalType(8, 2),
    "decimal(18,2)": T.DecimalType(18, 2),
}


def _struct(columns: str) -> T.StructType:
    """Schema from "name type, name type"; usable before a session exists."""
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


STAGING = {name: _struct(f"{columns}, {_LINEAGE}") for name, columns in _STAGING.items()}
WAREHOUSE = {name: _struct(columns) for name, columns in _WAREHOUSE.items()}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types."""
    return df.selectExpr(
        *[f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in schema.fields]
    )


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table the optimizer knows to be empty, so joins with it disappear."""
    nothing = [f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in schema.fields]
    return spark.range(1).where("false").selectExpr(*nothing)
