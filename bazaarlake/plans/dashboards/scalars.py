"""Single-number answers several dashboards show under their own names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import mean, money, percent


def total_of(rows: DataFrame, column: str, name: str) -> DataFrame:
    return rows.agg(money(F.sum(column)).alias(name))


def units_of(rows: DataFrame, column: str, name: str) -> DataFrame:
    return rows.agg(F.sum(column).cast("long").alias(name))


def average_of(rows: DataFrame, column: str, name: str) -> DataFrame:
    return rows.agg(mean(F.sum(column), F.count(column)).alias(name))


def row_count(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count("*").alias(name))


def distinct_of(rows: DataFrame, column: str, name: str) -> DataFrame:
    return rows.agg(F.count_distinct(column).alias(name))


def share_of(rows: DataFrame, condition, name: str) -> DataFrame:
    return rows.agg(percent(F.count_if(condition), F.count("*")).alias(name))


def orders_per(rows: DataFrame, key: str, name: str) -> DataFrame:
    return rows.agg(mean(F.count("*"), F.count_distinct(key)).alias(name))
