"""Row numbers that hold up when one group has most of the rows, and surrogate keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNKS = 4096
_MIN_CHUNK = 65_536
# Keys are first counted in so many places of their hash.
_PLACES = 65_536


def oversized(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("_rows"))
    return counts.filter(F.col("_rows") > limit).select(key)


def crowded(df: DataFrame, key: str, limit: int) -> bool:
    """Whether any place of the keys' hash holds more than ``limit`` rows; if none does, no key has.

    A task sends one count per place at most, however many keys it reads.
    """
    place = F.pmod(F.xxhash64(key), F.lit(_PLACES)).alias("_place")
    counts = df.groupBy(place).agg(F.count("*").alias("_rows"))
    return not counts.filter(F.col("_rows") > limit).isEmpty()


def split_hot(df: DataFrame, key: str, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys with at most ``limit`` rows, and those of the others, if there are any.

    One pass over that column alone decides whether there may be any: usually there are none, and
    the plan then has neither a join nor a second branch. Keys are counted by themselves only
    where several share a crowded place of the hash.
    """
    if not crowded(df, key, limit):
        return df, None
    hot = oversized(df, key, limit)
    if hot.isEmpty():
        return df, None
    # A shuffle of its own shows adaptive execution how few they are.
    hot = hot.repartition(key)
    return df.join(hot, key, "left_anti"), df.join(hot, key, "left_semi")


def number_within(
    df: DataFrame, key: str, order: Sequence[str], name: str, hot_rows: int
) -> DataFrame:
    """1, 2, 3 ... within each key, by ``order`` (its last column a row position).

    Keys with at most ``hot_rows`` rows are numbered by one window. The few larger ones are
    numbered piecewise: each key is cut into chunks of row positions, every chunk is numbered by
    itself and shifted by the size of the chunks before it.
    """
    usual, large = split_hot(df, key, hot_rows)
    numbered = number_usual(usual, [key], order, name)
    if large is None:
        return numbered
    return numbered.unionByName(number_in_chunks(large, [key], order, name))


def number_usual(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(by_key).cast("long"))


def number_in_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    *outer, position = order
    widths = df.groupBy(*keys).agg(
        F.greatest(F.lit(_MIN_CHUNK), F.floor(F.max(position) / _CHUNKS) + 1).alias("_width")
    )
    chunk = [*keys, *outer, "_chunk"]
    cut = (
        df.join(widths, list(keys))
        .withColumn("_chunk", F.floor(F.col(position) / F.col("_width")))
        .drop("_width")
    )
    sizes = cut.groupBy(*chunk).agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*keys).orderBy(*outer, "_chunk")
    offsets = sizes.select(
        *chunk, (F.sum("_size").over(before) - F.col("_size")).alias("_before")
    )
    inside = Window.partitionBy(*chunk).orderBy(position)
    return (
        cut.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, chunk)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_chunk", "_inside", "_before")
    )


def surrogate_keys(
    new_rows: DataFrame,
    key: str,
    spread: Column,
    order: Sequence[str],
    start: Column,
    digits: int = 3,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Dense keys start+1, start+2, ... for new rows, repeatable for the same input.

    ``spread`` is a text of evenly distributed hex digits (an md5). Its first digits cut the
    rows into 16^digits buckets (4,096 by default); rows are numbered inside a bucket and
    shifted by the sizes of the buckets before it, so only bucket sizes ever meet in one task.
    ``stage`` writes rows and reads them back: sizes are then counted from the numbered rows, and
    ``new_rows`` are made once.
    """
    if not 1 <= digits <= 4:
        raise ValueError("1 to 4 digits: the bucket sizes have to fit one task")
    bucketed = new_rows.withColumn("_bucket", F.left(spread, F.lit(digits)))
    inside = Window.partitionBy("_bucket").orderBy(*order)
    numbered = bucketed.withColumn("_inside", F.row_number().over(inside))
    if stage is not None:
        bucketed = numbered = stage(numbered)
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    # At most 65,536 rows of one count each: one task and a broadcast are safe.
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket")
    offsets = sizes.select(
        "_bucket", (F.sum("_size").over(before) - F.col("_size")).alias("_before")
    )
    return (
        numbered.join(F.broadcast(offsets), "_bucket")
        .withColumn(key, (start + F.col("_before") + F.col("_inside")).cast("long"))
        .drop("_bucket", "_inside", "_before")
    )


def highest_key(table: DataFrame, key: str) -> Column:
    """Largest key so far, 0 for an empty table (the unknown member -1 does not count)."""
    return table.select(F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(0)).cast("long")).scalar()
