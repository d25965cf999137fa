"""Versions valid at a moment against brute force, whichever way a member is looked up."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bazaarlake.operators import asof
from bazaarlake.operators.facts import as_of_version

START = datetime(2020, 1, 1)


def day(n):
    return START + timedelta(days=n)


def case(seed):
    pick = random.Random(seed)
    versions, key = [], 0
    for member in range(12):
        at = 0
        for _ in range(pick.choice([1, 2, 9, 40])):
            length = pick.choice([0, 1, 3, 30])
            end = None if pick.random() < 0.05 else day(at + length) - timedelta(seconds=pick.choice([0, 1]))
            key += 1
            versions.append((f"m{member}", key, day(at), end))
            # Members 9 to 11 have versions that overlap.
            at += length if member < 9 else pick.choice([0, length, length // 2])
    rows = [
        (f"o{i}", pick.choice(["m0", f"m{pick.randrange(13)}", None]), day(pick.randrange(-5, 400)))
        for i in range(400)
    ]
    return versions, rows


@pytest.mark.parametrize("few, seed", [(0, 1), (5, 1), (5, 2), (1000, 1)])
def test_as_of(spark, monkeypatch, few, seed):
    monkeypatch.setattr("bazaarlake.operators.facts.FEW_VERSIONS", few)
    versions, rows = case(seed)
    dimension = spark.createDataFrame(
        versions, "member string, key long, effective_date timestamp, end_date timestamp"
    )
    orders = spark.createDataFrame(rows, "order_id string, member string, at timestamp")
    found = as_of_version(orders, dimension, "member", "at", "key", "_from").collect()
    expected = []
    for order, member, at in rows:
        keys = [k for m, k, a, b in versions if m == member and a <= at and (b is None or at < b)]
        expected += [(order, k) for k in keys or [None]]
    assert sorted(((r.order_id, r.key) for r in found), key=str) == sorted(expected, key=str)


def test_a_member_with_very_many_versions(spark):
    """10,000 versions and 200,000 rows of one member: looked up in work linear in their sum."""
    versions = spark.range(10_000).select(
        F.lit("hot").alias("member"),
        F.col("id").alias("key"),
        F.timestamp_seconds(F.col("id") * 86_400).alias("effective_date"),
        F.timestamp_seconds((F.col("id") + 1) * 86_400 - 1).alias("end_date"),
    )
    rows = spark.range(200_000).select(
        F.col("id").cast("string").alias("order_id"),
        F.lit("hot").alias("member"),
        F.timestamp_seconds((F.col("id") % 10_000) * 86_400 + 5).alias("at"),
    )
    found = as_of_version(rows, versions, "member", "at", "key", "_from")
    assert found.filter("key = cast(order_id as long) % 10000").count() == 200_000


def test_chunks_carry_their_state(spark, monkeypatch):
    monkeypatch.setattr(asof, "CHUNK_SECONDS", 86_400)
    versions = spark.createDataFrame(
        [("m", 1, day(0), day(50)), ("m", 2, day(60), None)],
        "member string, key long, effective_date timestamp, end_date timestamp",
    )
    monkeypatch.setattr("bazaarlake.operators.facts.FEW_VERSIONS", 1)
    rows = spark.createDataFrame([(f"o{i}", "m", day(i)) for i in range(100)], "order_id string, member string, at timestamp")
    found = as_of_version(rows, versions, "member", "at", "key", "_from").collect()
    want = {f"o{i}": 1 if i < 50 else None if i < 60 else 2 for i in range(100)}
    assert {r.order_id: r.key for r in found} == want
