"""Left joins where many rows may have no key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FILLERS = 1024


def spread_missing(key: str, by: str) -> Column:
    """The key, or for a missing one a filler that matches nothing and varies with ``by``.

    Rows without a key would otherwise all go to one join task.
    """
    filler = F.concat(F.lit("~"), F.pmod(F.xxhash64(by), F.lit(_FILLERS)).cast("string"))
    return F.coalesce(F.col(key), filler)


def left_lookup(rows: DataFrame, table: DataFrame, key: str, by: str) -> DataFrame:
    """Columns of ``table`` (one row per ``key``) next to ``rows``."""
    keyed = table.withColumnRenamed(key, "_lookup")
    return (
        rows.withColumn("_lookup", spread_missing(key, by))
        .join(keyed, "_lookup", "left")
        .drop("_lookup")
    )
