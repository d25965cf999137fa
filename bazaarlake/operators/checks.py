"""Key, reference and presence rules of the warehouse as counted violations."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIQUE = [
    ("dim_product", "product_key"),
    ("dim_merchant", "merchant_key"),
    ("dim_staff", "staff_key"),
    ("dim_customer", "customer_key"),
    ("dim_campaign", "campaign_key"),
    ("dim_campaign", "campaign_id"),
    ("dim_date", "date_key"),
    ("fact_order", "order_id"),
    ("fact_order_line_item", "line_item_key"),
]
REQUIRED = [
    ("dim_product", "product_bk"),
    ("dim_merchant", "merchant_bk"),
    ("dim_staff", "staff_bk"),
    ("dim_customer", "user_bk"),
]
REFERENCES = [
    ("fact_order", "customer_key", "dim_customer", "customer_key"),
    ("fact_order", "merchant_key", "dim_merchant", "merchant_key"),
    ("fact_order", "staff_key", "dim_staff", "staff_key"),
    ("fact_order", "campaign_key", "dim_campaign", "campaign_key"),
    ("fact_order", "transaction_date_key", "dim_date", "date_key"),
    ("fact_order", "estimated_arrival_date_key", "dim_date", "date_key"),
    ("fact_order", "actual_arrival_date_key", "dim_date", "date_key"),
    ("fact_order_line_item", "product_key", "dim_product", "product_key"),
]


def _mark(rule: int, rows: DataFrame, column: str, when: Column, known: bool = False) -> Column:
    """A row's entry under a rule: its key (a number or a text), and the side it is seen on.

    Where the rule does not take the row, the entry has no rule.
    """
    number = isinstance(rows.schema[column].dataType, T.IntegralType)
    return F.struct(
        F.when(when, F.lit(rule)).alias("rule"),
        (F.col(column).cast("long") if number else F.lit(None).cast("long")).alias("number"),
        (F.lit(None).cast("string") if number else F.col(column)).alias("text"),
        F.lit(known).alias("known"),
    )


def integrity_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per rule with the number of violations.

    Every table is scanned once: its rows give an entry for each rule they take part in, and one
    aggregation over (rule, key) settles all rules, references included, where the keys used and
    the keys known meet. Entries are summed in the tasks that read them, so a fact is reduced to
    its distinct keys before the shuffle.
    """
    names: list[str] = []
    kinds: list[str] = []
    marks: dict[str, list[Column]] = defaultdict(list)

    def rule(kind: str, name: str) -> int:
        names.append(name)
        kinds.append(kind)
        return len(names) - 1

    for table, column in UNIQUE:
        n = rule("unique", f"unique {table}.{column}")
        marks[table].append(_mark(n, tables[table], column, F.col(column).isNotNull()))
    for table, column in REQUIRED:
        n = rule("required", f"required {table}.{column}")
        marks[table].append(_mark(n, tables[table], column, F.col(column).isNull()))
        n = rule("unique", f"one current row {table}.{column}")
        current = F.col("is_current") & F.col(column).isNotNull()
        marks[table].append(_mark(n, tables[table], column, current))
    for table, column, target, key in REFERENCES:
        n = rule("reference", f"reference {table}.{column}")
        marks[table].append(_mark(n, tables[table], column, F.col(column).isNotNull()))
        marks[target].append(_mark(n, tables[target], key, F.col(key).isNotNull(), known=True))
    entries = [
        tables[table].select(F.inline(F.array(*found))).filter("rule is not null")
        for table, found in marks.items()
    ]
    settled = (
        reduce(DataFrame.unionByName, entries)
        .groupBy("rule", "number", "text")
        .agg(F.count_if(~F.col("known")).alias("used"), F.max("known").alias("known"))
    )
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), F.col("rule") + 1)
    broken = (
        F.when(kind == "unique", (F.col("used") > 1).cast("long"))
        .when(kind == "required", F.col("used"))
        .otherwise((~F.col("known")).cast("long"))
    )
    # Every rule is reported, kept or not.
    spark = settled.sparkSession
    all_rules = spark.range(len(names)).select(F.col("id").cast("int").alias("rule"), F.lit(0).cast("long").alias("n"))
    return (
        settled.select("rule", broken.alias("n"))
        .unionByName(all_rules)
        .groupBy("rule")
        .agg(F.sum("n").alias("violations"))
        .select(
            F.element_at(F.array(*[F.lit(name) for name in names]), F.col("rule") + 1).alias("rule"),
            "violations",
        )
    )


def repeated_keys(counts: DataFrame) -> DataFrame:
    """Of keys with their ``row_count``, those with several rows."""
    return counts.filter(F.col("row_count") > 1)
