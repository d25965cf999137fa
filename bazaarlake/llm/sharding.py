"""Shards by jump consistent hashing: no ring table, and growth moves only what it must."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import let

SHARDS = 16
# Rows of a shard are numbered inside this many buckets, so no task sorts a whole shard.
BUCKETS = 4096

# Fixed values of the jump hash: a 64-bit linear congruential generator, top 31 bits used.
_MULTIPLIER = 2862933555777941757
_MODULUS = 1 << 64
_DROPPED_BITS = 1 << 33
_TOP = 1 << 31


def _whole(number: int, digits: int) -> Column:
    return F.lit(str(number)).cast(f"decimal({digits},0)")


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 to shards-1 of a long key; null counts as 0.

    The key seeds a generator; each draw gives the next shard count at which the key would
    move, and the last one below ``shards`` is its shard. A jump moves at least one shard on, so
    ``shards`` draws suffice. Growing by one shard moves keys only into the new one.
    """

    def state(seed: Column, at: Column, then: Column) -> Column:
        return F.struct(
            seed.cast("decimal(20,0)").alias("seed"),
            at.cast("long").alias("at"),
            then.cast("long").alias("then"),
        )

    def hop(s: Column) -> Column:
        seed = F.pmod(s["seed"] * _whole(_MULTIPLIER, 19) + F.lit(1), _whole(_MODULUS, 20))

        def moved(x: Column) -> Column:
            draw = F.floor(x / _whole(_DROPPED_BITS, 10)).cast("double") + 1
            then = F.floor((s["then"] + 1).cast("double") * (F.lit(float(_TOP)) / draw))
            return state(x, s["then"], then)

        return let(seed.cast("decimal(20,0)"), moved)

    def walk(seed: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(shards)),
            state(seed, F.lit(-1), F.lit(0)),
            lambda s, _: F.when(s["then"] < shards, hop(s)).otherwise(s),
            lambda s: s["at"].cast("int"),
        )

    first = F.pmod(F.coalesce(key.cast("long"), F.lit(0)).cast("decimal(20,0)"), _whole(_MODULUS, 20))
    return let(first.cast("decimal(20,0)"), walk)


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row with its ``shard``, ``grown_shard`` (with one more shard), ``slot`` and ``size``.

    The shard depends on the key and the shard count alone. Slots are gapless from 0 within a
    shard: rows are numbered inside buckets of a hash of key and text and shifted by the sizes of
    the buckets before, so no task holds a shard and only bucket sizes (``BUCKETS`` per shard at
    most) are summed together.

    A null key counts as 0; a null text has size 1 (no bytes, plus 1) and no checksum. Rows that
    repeat a key share its shard and get slots of their own. An empty table gives no rows.
    Columns of ``docs`` with the names of added ones are replaced.
    """
    added = ["size", "text_crc32", "shard", "grown_shard", "slot"]
    placed = (
        docs.drop(*added)
        .withColumn("size", F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1)
        .withColumn("text_crc32", F.crc32(F.col(text).cast("binary")))
        .withColumn("shard", jump_hash(F.col(key), shards))
        .withColumn("grown_shard", jump_hash(F.col(key), shards + 1))
        # The text's own checksum spreads rows that share a key, or have none.
        .withColumn("_bucket", F.pmod(F.xxhash64(F.lit(1), key, "text_crc32", "size"), F.lit(BUCKETS)).cast("int"))
    )
    sizes = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_bucket")
    offsets = sizes.select(
        "shard", "_bucket", (F.sum("_rows").over(before) - F.col("_rows")).alias("_before")
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy(key, "text_crc32", "size")
    return (
        placed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, ["shard", "_bucket"])
        .withColumn("slot", F.col("_before") + F.col("_inside") - 1)
        .drop("_bucket", "_inside", "_before")
    )


def write_shards(assigned: DataFrame, folder: str) -> None:
    """One folder of parquet files per shard."""
    assigned.write.partitionBy("shard").parquet(folder)
