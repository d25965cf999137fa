"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import SPACE

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_REPEATS = 2
SEED = "mix"
# Rows are ordered by the leading bits of their size, then dealt by two hex digits of a hash.
SIZE_BITS = 6


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than ASCII white space; null has none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), f"^[{SPACE}]+", "")
    pieces = F.split(bare, f"[{SPACE}]+")
    return (F.size(pieces) - F.when(F.element_at(pieces, -1) == "", 1).otherwise(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """``source``, ``source_size`` with its ``target``.

    Sources by code point, null last, take the weights in turn. A target is the source's weight
    times a common level, cut at ``most_repeats`` times the source's size; the level is the one
    at which the targets add up to ``total_share`` of all sizes. That is where handing the
    excess on by weight, again and again, ends. One row per source: it is the only step that
    sees all sources together.
    """
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    everything = Window.partitionBy(F.lit(0))
    weighed = (
        sizes.withColumn("_n", F.row_number().over(listed) - 1)
        .withColumn("_weight", F.get(cycle, F.col("_n") % len(weights)))
        .withColumn("_cap", F.lit(float(most_repeats)) * F.col("source_size"))
        .withColumn("_level", F.col("_cap") / F.col("_weight"))
        .withColumn("_want", F.lit(total_share) * F.sum("source_size").over(everything))
    )
    # With all sources up to this level cut, what the targets would add up to.
    rising = Window.orderBy("_level")
    filled = (
        weighed.withColumn("_caps", F.sum("_cap").over(rising))
        .withColumn("_open", F.sum("_weight").over(everything) - F.sum("_weight").over(rising))
        .withColumn("_cut", F.col("_caps") + F.col("_level") * F.col("_open") <= F.col("_want"))
    )
    cut_sum = F.sum(F.when(F.col("_cut"), F.col("_cap")).otherwise(0.0)).over(everything)
    open_sum = F.sum(F.when(F.col("_cut"), 0.0).otherwise(F.col("_weight"))).over(everything)
    level = (F.col("_want") - cut_sum) / F.when(open_sum > 0, open_sum)
    return filled.select(
        "source",
        "source_size",
        F.when(F.col("_cut"), F.col("_cap"))
        .otherwise(F.least(F.col("_cap"), level * F.col("_weight")))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    size: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_repeats: int = MOST_REPEATS,
    seed: str = SEED,
    key: str = "doc_id",
) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    Within a source every row expects target / source_size copies. Rows lie in order of size,
    their expected copies are summed up from a random offset, and a row is emitted once per
    whole number crossed. Neighbours in that order have nearly equal sizes, so the words taken
    stay near the target. The running sum is rate times rank; ranks come from buckets of
    (source, leading bits of the size, hash digits) and the bucket sizes before, so no task
    holds a source. Offsets and order rest on md5 of the key: reruns agree.

    Null texts have size 0, a null source is a source of its own (last), a null key counts as
    an empty one, repeated rows are separate rows. A source without words has target 0 and no
    copies. An empty table gives no rows. Columns named like added ones are replaced.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    size = word_count(F.col("text")) if size is None else size
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    bits = F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0)
    dealt = (
        docs.withColumn("_size", size)
        .drop(*added)
        .withColumnRenamed("_size", "size")
        .withColumn("_name", name)
        .withColumn("_digest", digest)
        .withColumn("_shift", F.greatest(bits - SIZE_BITS, F.lit(0)))
        .withColumn("_lead", F.expr("shiftright(size, _shift)"))
        .withColumn("_part", F.left("_digest", F.lit(2)))
    )
    bucket = ["_name", "_shift", "_lead", "_part"]
    buckets = dealt.groupBy(*bucket).agg(
        F.count("*").alias("_rows"), F.sum("size").alias("_words"), F.first("source").alias("source")
    )
    sizes = buckets.groupBy("_name").agg(
        F.sum("_words").alias("source_size"), F.first("source").alias("source")
    )
    targets = source_targets(sizes.drop("_name"), weights, total_share, most_repeats)
    targets = targets.withColumn("_name", name).drop("source")
    before = Window.partitionBy("_name").orderBy("_shift", "_lead", "_part")
    placed = (
        buckets.withColumn("_before", F.sum("_rows").over(before) - F.col("_rows"))
        .join(targets, "_name")
        .select(*bucket, "_before", "source_size", "target")
    )
    inside = Window.partitionBy(*bucket).orderBy("size", "_digest", key)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = F.conv(F.left(F.md5(F.concat_ws("|", F.lit(seed), "_name")), F.lit(8)), 16, 10)
    start = offset.cast("double") / F.lit(4294967296.0)
    return (
        dealt.withColumn("_inside", F.row_number().over(inside))
        .join(placed, bucket)
        .withColumn("_rank", F.col("_before") + F.col("_inside"))
        .withColumn("_rate", rate)
        .withColumn(
            "copies",
            F.floor(F.col("_rate") * F.col("_rank") + start)
            - F.floor(F.col("_rate") * (F.col("_rank") - 1) + start),
        )
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop(*bucket, "_digest", "_before", "_inside", "_rank", "_rate")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """Rows repeated as often as ``copies`` says, without the columns ``mix`` added."""
    repeats = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.withColumn("_copy", repeats).drop(
        "_copy", "size", "source_size", "target", "copies", "taken"
    )
