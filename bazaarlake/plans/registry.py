"""Every operator and dashboard query as a callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.operators import calendar, checks, cleaning, facts, ordinal, scd
from bazaarlake.plans import batch, dashboards, star
from bazaarlake.session import shared_dir
from bazaarlake.sources import files, html, tpch, tpch_files

Query = Callable[[SparkSession, str], DataFrame]

# Ages are taken on this day, so results do not change with the calendar.
AS_OF = "2002-01-01"


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, decimals as doubles: the same in every engine."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(columns)


# --- dashboards -------------------------------------------------------------------------------


def _dashboard(name: str) -> Query:
    build = dashboards.QUERIES[name]
    extra = {"as_of": AS_OF} if name in ("cust_age_groups_spend", "seg_age_gender") else {}

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(star.driver_star(spark, sf_dir), **extra))

    return query


# --- identity and cleaning ----------------------------------------------------------------------

CLEANED = {
    "identity_user": "user_identity",
    "identity_merchant": "merchant_identity",
    "identity_staff": "staff_identity",
    "identity_product": "product_identity",
    "clean_orders": "orders",
    "clean_order_delays": "order_delays",
    "clean_campaigns": "campaigns",
    "clean_campaign_transactions": "campaign_transactions",
    "clean_line_prices": "line_prices",
    "clean_line_products": "line_products",
    "clean_merchants": "merchants",
    "clean_order_merchant": "order_merchant",
    "clean_products": "products",
    "clean_staff": "staff",
    "clean_user_credit_card": "user_credit_card",
    "clean_user_data": "user_data",
    "clean_user_job": "user_job",
    "customer_source": "customer_source",
    "fact_order_metrics": "order_metrics",
}


def _cleaned(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        clean = batch.clean_sources(tpch.staging(spark, sf_dir))
        return plain(clean[CLEANED[name]].drop("ingest_ordinal"))

    return query


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys 1..n over the product business keys."""
    products = batch.clean_sources(tpch.staging(spark, sf_dir))["products"]
    keyed = ordinal.surrogate_keys(
        products.select("product_bk"), "product_key", F.col("product_bk"), ["product_bk"], F.lit(0)
    )
    return keyed.select("product_bk", "product_key")


# --- dimensions and facts -------------------------------------------------------------------------


def _table(table: str, load: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = getattr(star, load)(spark, sf_dir).tables()
        return plain(tables[table].drop("order_year"))

    return query


def scd_changes_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers the second delivery adds or changes, with the key they replace."""
    current = star.driver_star(spark, sf_dir).dim_customer
    source = batch.clean_sources(tpch.staging(spark, sf_dir, 2))["customer_source"]
    tracked = ["name", "street", "city", "state", "country", "device_address", "user_type"]
    tracked += ["job_title", "job_level", "credit_card_number", "issuing_bank"]
    changes = scd.scd2_changes(current, source, "customer_key", "user_bk", tracked)
    return changes.select("user_bk", "city", F.col("_old_key").alias("old_customer_key"))


def dim_unknown_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star.driver_star(spark, sf_dir)
    members = [
        tables.dim_customer.filter("customer_key = -1").select(
            F.lit("dim_customer").alias("dimension"), F.col("name")
        ),
        tables.dim_merchant.filter("merchant_key = -1").select(F.lit("dim_merchant"), "name"),
        tables.dim_staff.filter("staff_key = -1").select(F.lit("dim_staff"), "name"),
        tables.dim_campaign.filter("campaign_key = -1").select(
            F.lit("dim_campaign"), "campaign_name"
        ),
    ]
    return reduce(DataFrame.union, members)


def dim_date_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = calendar.date_span(tpch.staging(spark, sf_dir))
    return plain(span.select(F.col("first").alias("first_date"), F.col("last").alias("last_date")))


def fact_campaign_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = batch.clean_sources(tpch.staging(spark, sf_dir))
    return facts.campaign_per_order(clean["campaign_transactions"])


def _versioned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second delivery against dimensions that have two versions of changed members."""
    clean = batch.clean_sources(tpch.staging(spark, sf_dir, 2))
    later = star.second_star(spark, sf_dir)
    return facts.orders_with_versions(
        clean["orders"],
        clean["order_merchant"],
        later.dim_customer,
        later.dim_merchant,
        later.dim_staff,
    )


_KEYS = ["order_id", "customer_key", "merchant_key", "staff_key"]


def fact_as_of_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned_orders(spark, sf_dir).select(_KEYS)


def as_of_customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per state of a customer when they were shipped; every order day begins a new state.

    Customers have dozens of states, so those with more than eight are looked up along time.
    """
    orders = tpch.driver_table(spark, sf_dir, "orders")
    customer = F.col("o_custkey").cast("string").alias("customer")
    begun = F.col("o_orderdate").cast("timestamp")
    states = orders.groupBy(customer, begun.alias("effective_date")).agg(F.max("o_orderkey").alias("state"))
    ends = F.lead("effective_date").over(Window.partitionBy("customer").orderBy("effective_date"))
    lines = tpch.driver_table(spark, sf_dir, "lineitem").join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), customer), "l_orderkey"
    )
    shipped = lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"), "customer", F.col("l_shipdate").alias("shipped")
    )
    found = facts.as_of_version(
        shipped, states.withColumn("end_date", ends), "customer", "shipped", "state", "_from", few=8
    )
    return found.groupBy("customer", "state").agg(F.count("*").alias("line_count"))


def customers_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers of every month after the second delivery, from the daily bitmaps."""
    return star.second_star(spark, sf_dir).order_sums.customers_by_month()


def fact_one_row_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.one_row_per_order(_versioned_orders(spark, sf_dir)).select(_KEYS)


def fact_order_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second delivery resolved against the second dimensions, before it meets old orders."""
    clean = batch.clean_sources(tpch.staging(spark, sf_dir, 2))
    dimensions = star.second_star(spark, sf_dir).tables()
    return plain(batch.incoming_orders(clean, dimensions))


def fact_lines_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = batch.clean_sources(tpch.staging(spark, sf_dir))
    return plain(facts.match_lines(clean["product_lines"], clean["price_lines"]))


# --- loads and checks -----------------------------------------------------------------------------


def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.integrity_report(star.driver_star(spark, sf_dir, whole=True).tables())


def integrity_report_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.integrity_report(star.second_star(spark, sf_dir, whole=True).tables())


def repeated_business_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business keys with several cleaned profiles and how many, counted without listing them."""
    staging = tpch.staging(spark, sf_dir)
    identities = batch.clean_sources(staging)["user_identity"]
    profiles = cleaning.shared_user_data(staging["stg_user_data"], identities)
    return checks.repeated_keys(profiles.rows_per_key())


def batch_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every warehouse table after the second delivery."""
    tables = star.second_star(spark, sf_dir, whole=True).tables()
    counts = [
        rows.agg(F.count("*").alias("row_count")).select(
            F.lit(table).alias("table_name"), "row_count"
        )
        for table, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# --- files ------------------------------------------------------------------------------------------

_delivered: dict[tuple[str, str, str], str] = {}
_departments: set[tuple[str, str]] = set()
_delivering = threading.RLock()


def delivery(spark: SparkSession, sf_dir: str, kind: str = "delivery", *tables: str) -> str:
    """Folder with driver tables written out as departmental files, once per application.

    Only the departments of ``tables`` are written, of all tables when none is named: a table is
    looked for among all files of its department, and nowhere else.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    with _delivering:
        if key not in _delivered:
            name = re.sub(r"\W+", "_", sf_dir)
            _delivered[key] = f"{shared_dir(spark)}/{kind}/{key[0]}/{name}-{uuid.uuid4().hex}"
        root = _delivered[key]
        for department in dict.fromkeys(files.INGESTS[t].folder for t in tables or files.INGESTS):
            if (root, department) not in _departments:
                getattr(tpch_files, f"write_{kind}")(spark, sf_dir, root, department)
                _departments.add((root, department))
        return root


def _ingested(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        valid, _ = files.ingest(spark, delivery(spark, sf_dir, "delivery", table), table, tpch_files.LOAD_TIME)
        return plain(valid.drop("source_filename", "ingest_ordinal"))

    return query


def ingest_orders_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = files.ingest(
        spark, delivery(spark, sf_dir, "delivery", "stg_orders"), "stg_orders", tpch_files.LOAD_TIME
    )
    return plain(rejected.drop("source_filename", "ingest_ordinal"))


def ingest_file_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows found per staging table, with the format and delimiter of its files."""
    root = delivery(spark, sf_dir)
    found = []
    for table, job in files.INGESTS.items():
        layouts, _ = files.discover(spark, f"{root}/{job.folder}", job.required)
        for rows in files.scan(spark, layouts, job.required):
            kinds = {(each.format, each.delimiter or "") for each in layouts}
            kind = ", ".join(f"{k}{' ' + d.strip() if d.strip() else ''}" for k, d in sorted(kinds))
            found.append(
                rows.agg(F.count("*").alias("row_count")).select(
                    F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), "row_count"
                )
            )
    counts = reduce(DataFrame.unionByName, found)
    return counts.groupBy("table_name", "kind").agg(F.sum("row_count").alias("row_count"))


def ingest_staging_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every staging table after the delivery has replaced them."""
    root = delivery(spark, sf_dir)
    files.load_staging(spark, root, f"{root}-staging", tpch_files.LOAD_TIME)
    counts = [
        rows.agg(F.count("*").alias("row_count")).select(
            F.lit(table).alias("table_name"), "row_count"
        )
        for table, rows in files.read_staging(spark, f"{root}-staging").items()
    ]
    return reduce(DataFrame.unionByName, counts)


def ingest_row_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct (file, position) pairs of the scanned product lines."""
    root = delivery(spark, sf_dir, "delivery", "stg_line_items_products")
    valid, _ = files.ingest(spark, root, "stg_line_items_products", tpch_files.LOAD_TIME)
    places = valid.groupBy("source_filename", "ingest_ordinal").agg(F.count("*").alias("n"))
    return places.agg(
        F.sum("n").alias("row_count"), F.count("*").alias("distinct_positions")
    )


def ingest_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns whose descriptions hold line breaks, quotes and delimiters inside quotes."""
    root = delivery(spark, sf_dir, "quoted_delivery", "stg_campaign")
    valid, _ = files.ingest(spark, root, "stg_campaign", tpch_files.LOAD_TIME)
    return valid.select(
        "campaign_id",
        "campaign_name",
        F.md5("campaign_description").alias("description_md5"),
        F.length("campaign_description").cast("long").alias("description_length"),
        "discount",
    )


def ingest_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs from pretty-printed and one-line arrays with braces inside strings."""
    root = delivery(spark, sf_dir, "array_delivery", "stg_user_job")
    valid, _ = files.ingest(spark, root, "stg_user_job", tpch_files.LOAD_TIME)
    return valid.select(
        "user_id",
        "name",
        F.md5("job_title").alias("title_md5"),
        F.length("job_title").cast("long").alias("title_length"),
        "job_level",
    )


def html_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html.table_rows(tpch_files.supplier_pages(spark, sf_dir))
    return html.table_columns(rows, ["field_name", "field_value"])


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name in dashboards.QUERIES:
        found[name] = _dashboard(name)
    for name in CLEANED:
        found[name] = _cleaned(name)
    for table in batch.DIMENSIONS + ["fact_order", "fact_order_line_item"]:
        found[f"{table}_load"] = _table(table, "driver_star")
        found[f"{table}_reload"] = _table(table, "second_star")
    for table in files.INGESTS:
        found[f"ingest_{table}"] = _ingested(table)
    for query in [
        surrogate_keys,
        scd_changes_customer,
        dim_unknown_members,
        dim_date_span,
        fact_campaign_per_order,
        fact_as_of_versions,
        as_of_customer_history,
        customers_by_month,
        fact_one_row_per_order,
        fact_order_incoming,
        fact_lines_matched,
        integrity_report,
        integrity_report_reload,
        repeated_business_keys,
        batch_row_counts,
        ingest_orders_rejected,
        ingest_file_discovery,
        ingest_staging_counts,
        ingest_row_ordinal,
        ingest_csv_quoted,
        ingest_json_array,
        html_table_scan,
    ]:
        found[query.__name__] = query
    return found
