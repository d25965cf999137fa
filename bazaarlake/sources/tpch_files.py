"""The driver-table delivery as departmental files in mixed formats, to run the ingest on."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.sources import paths, tpch
from bazaarlake.sources.files import INGESTS
from bazaarlake.sources.schemas import STAGING

LOAD_TIME = "2002-01-05 06:00:00"

# Per table: file format, delimiter.
LAYOUT = {
    "stg_campaign": ("csv", "\t"),
    "stg_campaign_transactions": ("csv", ","),
    "stg_line_items_prices": ("parquet", None),
    "stg_line_items_products": ("csv", "|"),
    "stg_merchant_data": ("csv", ","),
    "stg_orders": ("csv", ";"),
    "stg_order_delays": ("csv", ","),
    "stg_order_merchant": ("csv", "|"),
    "stg_product_list": ("csv", ","),
    "stg_staff": ("parquet", None),
    "stg_user_credit_card": ("csv", ";"),
    "stg_user_data": ("csv", ","),
    "stg_user_job": ("json", None),
}


def _spelled(df: DataFrame, table: str) -> DataFrame:
    """Dates as the departments write them; every 131st order has an impossible one."""
    spelled: dict[str, Column] = {}
    if table == "stg_orders":
        iso = F.date_format("transaction_date", "yyyy-MM-dd")
        short = F.date_format("transaction_date", "M/d/yy")
        spelled["transaction_date"] = (
            F.when(F.col("ingest_ordinal") % 131 == 7, "2021-99-99")
            .when(F.col("ingest_ordinal") % 2 == 0, short)
            .otherwise(iso)
        )
    if table == "stg_merchant_data":
        spelled["creation_date"] = F.date_format("creation_date", "M/d/yy H:mm")
    if table == "stg_user_data":
        for column in ["creation_date", "birthdate"]:
            spelled[column] = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(spelled) if spelled else df


def write_delivery(spark: SparkSession, sf_dir: str, root: str, department: str) -> None:
    """Files of all tables of one department."""
    staging = tpch.staging(spark, sf_dir)
    for table in staging:
        if INGESTS[table].folder != department:
            continue
        rows = staging[table]
        kind, delimiter = LAYOUT[table]
        columns = STAGING[table].names[:-3]
        # Headers need trimming, lower-casing and underscores; an index column goes first.
        titled = {c: f" {c.replace('_', ' ').title()}" for c in columns}
        out = _spelled(rows, table)
        if kind == "csv":
            out = out.select(
                F.col("ingest_ordinal").alias(""), *[F.col(c).alias(titled[c]) for c in columns]
            )
        else:
            out = out.select(*columns)
        writer = out.write.mode("append")
        if kind == "csv":
            writer = (
                writer.option("header", True)
                .option("sep", delimiter)
                .option("escape", '"')
                .option("ignoreLeadingWhiteSpace", False)
                .option("ignoreTrailingWhiteSpace", False)
            )
        getattr(writer, kind)(f"{root}/{INGESTS[table].folder}")


def write_quoted_delivery(spark: SparkSession, sf_dir: str, root: str, department: str) -> None:
    """Documents as campaign files: commas, doubled quotes and line breaks inside quoted fields."""
    docs = tpch.driver_table(spark, sf_dir, "documents")
    campaigns = docs.select(
        F.concat(F.lit("C"), F.col("doc_id")).alias("Campaign ID"),
        F.concat("lang", F.lit(', "'), "source", F.lit('"')).alias("Campaign Name"),
        F.replace("text", F.lit("."), F.lit('."')).alias("Campaign Description"),
        F.concat(F.col("n_chars") % 90, F.lit("%")).alias("Discount"),
    )
    writer = campaigns.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    writer.csv(f"{root}/{department}")


def _as_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The objects of a partition as one JSON array."""
    mark = "["
    for batch in batches:
        texts = []
        for value in batch.column(0).to_pylist():
            texts.append(mark + value)
            mark = ","
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if mark == "[" else "]"])], ["value"])


def write_array_delivery(spark: SparkSession, sf_dir: str, root: str, department: str) -> None:
    """Documents as JSON arrays of user jobs, pretty-printed or on one line each, with braces,
    brackets, quotes and backslashes inside strings and nested objects."""
    docs = tpch.driver_table(spark, sf_dir, "documents")
    jobs = docs.select(
        F.col("doc_id"),
        F.struct(
            F.concat(F.lit("U"), F.col("doc_id")).alias("user_id"),
            F.concat(F.lit('{"}\\" '), "lang").alias("name"),
            F.replace("text", F.lit("."), F.lit('}]{[".')).alias("job_title"),
            F.when(F.col("n_chars") % 5 != 0, F.col("source")).alias("job_level"),
            F.struct(F.col("n_chars"), F.array(F.lit("]")).alias("marks")).alias("more"),
        ).alias("job"),
    )
    folder = f"{root}/{department}"
    for half, (pretty, line_end) in enumerate([("true", "\n"), ("false", " ")]):
        texts = jobs.filter(F.col("doc_id") % 2 == half).select(
            F.to_json("job", {"pretty": pretty, "ignoreNullFields": "false"}).alias("value")
        )
        part = f"{root}/arrays-{half}"
        texts.mapInArrow(_as_arrays, "value string").write.option("lineSep", line_end).text(part)
        for number, file in enumerate(paths.files_in(spark, part)):
            paths.make_folder(spark, folder)
            paths.move(spark, file, f"{folder}/array-{half}-{number}.json")


def supplier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One HTML page per supplier with a table of its name, nation and region."""
    nations = tpch.driver_table(spark, sf_dir, "nation")
    regions = tpch.driver_table(spark, sf_dir, "region")
    placed = (
        tpch.driver_table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return placed.select(
        F.concat(F.lit("supplier-"), F.col("s_suppkey").cast("string"), F.lit(".html")).alias(
            "source"
        ),
        F.concat(
            F.lit("<html><body><h1>Supplier</h1><table border=1><thead><tr><th> Field Name </th>"),
            F.lit("<th>Field Value</th></tr></thead><tbody><tr><td>name</td><td><b>"),
            F.col("s_name"),
            F.lit("</b> &amp; Co</td></tr><tr><td>nation</td><td>"),
            F.col("n_name"),
            F.lit("</td></tr><tr><td>region<td>"),
            F.col("r_name"),
            F.lit("</tr></tbody></table><table><tr><td>other</td></tr></table></body></html>"),
        ).alias("html"),
    )
