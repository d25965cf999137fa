"""Numbering, keys and pairs against brute force, with the paths for large groups forced."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bazaarlake.operators import ordinal
from bazaarlake.operators.baskets import pair_counts


@pytest.mark.parametrize("hot_rows", [1, 40, 10_000])
@pytest.mark.parametrize("stride", [1, 1 << 40])
def test_number_within(spark, hot_rows, stride):
    random.seed(hot_rows)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else f"k{random.randrange(150)}"
        rows.append((key, f"file{random.randrange(3)}", i * stride))
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, file string, position bigint")
    numbered = ordinal.number_within(df, "key", ["file", "position"], "seq", hot_rows).collect()
    groups = defaultdict(list)
    for key, file, position in rows:
        groups[key].append((file, position))
    expected = {
        (key, file, position): i
        for key, members in groups.items()
        for i, (file, position) in enumerate(sorted(members), start=1)
    }
    assert {(r.key, r.file, r.position): r.seq for r in numbered} == expected
    assert len(numbered) == len(rows)


def test_keys_are_counted_apart_only_in_crowded_places(spark, monkeypatch):
    df = spark.range(2000).select(F.concat(F.lit("k"), F.col("id") % 500).alias("key"))
    monkeypatch.setattr(ordinal, "_PLACES", 1)
    assert ordinal.split_hot(df, "key", 4) == (df, None)
    usual, large = ordinal.split_hot(df.unionAll(df.filter("key = 'k7'")), "key", 7)
    assert usual.count() == 1996 and large.count() == 8
    monkeypatch.setattr(ordinal, "_PLACES", 65_536)
    monkeypatch.setattr(ordinal, "oversized", None)
    assert ordinal.split_hot(df, "key", 1000) == (df, None)


def test_chunks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(ordinal, "_MIN_CHUNK", 7)
    df = spark.range(500).select(F.lit("hot").alias("key"), F.col("id").alias("position"))
    numbered = ordinal.number_within(df, "key", ["position"], "seq", 10)
    assert numbered.filter("seq != position + 1").count() == 0
    assert numbered.count() == 500


def test_surrogate_keys_are_dense_and_repeatable(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("bk"))

    def keys(rows):
        keyed = ordinal.surrogate_keys(rows, "key", F.col("bk"), ["bk"], F.lit(100).cast("long"))
        return {r.bk: r.key for r in keyed.collect()}

    first = keys(df)
    assert sorted(first.values()) == list(range(101, 5101))
    assert first == keys(df.repartition(13))


@pytest.mark.parametrize("small", [0, 3, 32])
def test_pair_counts(spark, small):
    random.seed(small)
    rows = []
    for i in range(600):
        order = "hot" if i % 3 == 0 else f"o{random.randrange(60)}"
        product = random.choice([1, 2, 15, 16, 17, 31, 32, 255, 256, 257, 4095, 4096, 70000, 1 << 45])
        rows.append((order, product, f"type{product % 4}"))
    df = spark.createDataFrame(rows, "order_id string, product_key bigint, label string")
    expected = Counter()
    orders = defaultdict(list)
    for order, product, name in rows:
        orders[order].append((product, name))
    for members in orders.values():
        for a, name_a in members:
            for b, name_b in members:
                if a < b:
                    expected[(name_a, name_b)] += 1
    found = pair_counts(df, "label", small).collect()
    assert {(r.label_a, r.label_b): r.pair_count for r in found} == dict(expected)
