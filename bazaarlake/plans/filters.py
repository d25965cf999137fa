"""What a folder of facts may hold: the range of its order ids, and a Bloom filter of them.

A filter is a number of blocks of 32,768 bits, a power of two that follows the folder's orders. An
id's hash names its block and the bits in it, so a delivery meets a folder block by block, in an
equality join, and its ids are never paired with all blocks. Ranges lie in the published list,
blocks in parquet folders named there.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BITS = 32_768
# Bits an order gets, and bits set for it: a strange id is taken for a member once in a million.
BITS_PER_ORDER, PROBES = 32, 12
# More than a folder's blocks.
_BLOCKS = 1 << 32


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("order_id"), blocks.cast("long"))


def _other() -> Column:
    """A second hash of an id: it names the bits of the id in its block."""
    return F.xxhash64(F.lit(1), "order_id")


def _bits(other: Column) -> Column:
    """The bits of an id in its block: a start and an odd step."""
    start = F.pmod(other, F.lit(BLOCK_BITS))
    step = F.pmod(F.shiftright(other, 20), F.lit(BLOCK_BITS // 2)) * 2 + 1
    return F.array(*[(start + j * step) % BLOCK_BITS for j in range(PROBES)])


def in_first_part() -> Column:
    """One id of 64, by its hash. A folder that holds such an id needs no look at the others."""
    return F.pmod(F.xxhash64(F.lit(2), "order_id"), F.lit(64)) == 0


def _blocks_for(orders: int) -> int:
    blocks = 1
    while blocks * BLOCK_BITS < orders * BITS_PER_ORDER:
        blocks *= 2
    return blocks


def build(spark: SparkSession, ids: DataFrame, target: str) -> dict[str, dict]:
    """Filters of the folders in ``ids`` (``_folder``, ``order_id``), written under ``target``.

    Per folder name: where its blocks are, how many, and the lowest and highest id.
    """
    place = f"{target}/{uuid.uuid4().hex}"
    # Told apart once: their number settles how many blocks they are dealt over.
    ids.select("_folder", "order_id").filter("order_id is not null").distinct().write.parquet(f"{place}-ids")
    held = spark.read.schema("_folder string, order_id string").parquet(f"{place}-ids")
    sizes = (
        held.groupBy("_folder")
        .agg(F.count("*").alias("n"), F.min("order_id").alias("low"), F.max("order_id").alias("high"))
        .collect()  # one row per folder
    )
    if not sizes:
        return {}
    facts = {
        row["_folder"]: {"at": place, "blocks": _blocks_for(row["n"]), "low": row["low"], "high": row["high"]}
        for row in sizes
    }
    # Ids meet by one number for folder and block, before their bits are listed: a block is put
    # together in one place, and no half-filled blocks are shuffled.
    shapes = F.broadcast(_shapes(spark, facts))
    place_of_block = F.col("number") * _BLOCKS + _block(F.col("blocks"))
    dealt = held.join(shapes, "_folder").select(place_of_block.alias("place"), _other().alias("other"))
    built = (
        dealt.repartition("place")
        .select("place", F.explode(_bits(F.col("other"))).alias("bit"))
        .groupBy("place")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    (
        built.join(shapes, F.floor(F.col("place") / _BLOCKS) == F.col("number"))
        .select("_folder", "blocks", (F.col("place") % _BLOCKS).alias("block"), "bits")
        .write.parquet(place)
    )
    return facts


def _shapes(spark: SparkSession, facts: Mapping[str, dict]) -> DataFrame:
    """One row per folder; there are at most a few hundred."""
    rows = [(name, f["blocks"], number) for number, (name, f) in enumerate(facts.items())]
    return spark.createDataFrame(rows, "_folder string, blocks int, number long")


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), bit % 8)), F.lit(2)) == 1


def may_hold(spark: SparkSession, facts: Mapping[str, dict], order_ids: DataFrame) -> set[str]:
    """Names of the folders whose filter lets an id of the delivery through.

    Most folders of a delivery that comes again let one of its first part through already; only
    the others meet all its ids.
    """
    ids = order_ids.select("order_id").filter("order_id is not null")
    span = ids.agg(F.min("order_id"), F.max("order_id")).first()
    if span[0] is None:
        return set()
    near = {name: f for name, f in facts.items() if f["low"] <= span[1] and f["high"] >= span[0]}
    hit = _let_through(spark, near, ids.filter(in_first_part()))
    return hit | _let_through(spark, {name: f for name, f in near.items() if name not in hit}, ids)


def _let_through(spark: SparkSession, facts: Mapping[str, dict], ids: DataFrame) -> set[str]:
    if not facts:
        return set()
    sizes = sorted({f["blocks"] for f in facts.values()})
    asked = ids.distinct().withColumn("blocks", F.explode(F.array(*[F.lit(n) for n in sizes]))).select(
        "blocks", _block(F.col("blocks")).alias("block"), _bits(_other()).alias("probes")
    )
    blocks = spark.read.parquet(*sorted({f["at"] for f in facts.values()}))
    blocks = blocks.join(F.broadcast(_shapes(spark, facts).drop("number")), ["_folder", "blocks"])
    hit = asked.join(blocks, ["blocks", "block"]).filter(
        F.forall("probes", lambda bit: _is_set(F.col("bits"), bit))
    )
    return {row["_folder"] for row in hit.select("_folder").distinct().collect()}


def names_of(folders: Sequence[str], facts: Mapping[str, dict], name) -> dict[str, dict]:
    """The filters of these folders, by folder name."""
    return {name(folder): facts[name(folder)] for folder in folders if name(folder) in facts}
