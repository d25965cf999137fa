"""Versions valid at a moment, for members with few versions and for members with very many.

Rows carry ``_lookup`` (the member) and ``_moment``; versions ``_on``, an effective time, ``_end``
(null while open) and whatever else is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Points in time of one member meet in one task within a chunk of so many seconds (30 days).
CHUNK_SECONDS = 30 * 86_400


def by_interval(rows: DataFrame, versions: DataFrame, effective: str) -> DataFrame:
    """Left join on the member with the interval as residual: rows of a member times its versions."""
    moment = F.col("_moment")
    valid = (moment >= F.col(effective)) & (F.col("_end").isNull() | (moment < F.col("_end")))
    return rows.join(versions, (F.col("_lookup") == F.col("_on")) & valid, "left")


def many_versions(versions: DataFrame, effective: str, few: int) -> DataFrame | None:
    """Members with more than ``few`` versions, none of which begins before the one before ends.

    None when no member has so many.
    """
    lively = versions.filter(F.col("_end").isNull() | (F.col("_end") > F.col(effective)))
    counted = lively.groupBy("_on").agg(F.count("*").alias("_n")).filter(F.col("_n") > few)
    if counted.isEmpty():
        return None
    following = F.lead(effective).over(Window.partitionBy("_on").orderBy(effective, "_end"))
    overlaps = following.isNotNull() & (F.col("_end").isNull() | (F.col("_end") > following))
    return (
        lively.join(counted.select("_on"), "_on", "left_semi")
        .select("_on", overlaps.alias("_overlaps"))
        .groupBy("_on")
        .agg(F.max("_overlaps").alias("_overlaps"))
        .filter(~F.col("_overlaps"))
        .select("_on")
    )


def along_time(rows: DataFrame, versions: DataFrame, effective: str, few: int) -> DataFrame:
    """As ``by_interval``, in work linear in rows and versions however many versions a member has.

    For members with more than ``few`` versions, each distinct (member, moment) of the rows is put
    on the time line among the versions, and the version begun last is carried along it: inside
    chunks of time, and from chunk to chunk by one state each, so that a member is spread over its
    chunks. Rows then take their version by an equality join on (member, moment). Members whose
    versions overlap may have several valid at once and stay with the join on intervals, as do
    members with few versions.
    """
    heavy = many_versions(versions, effective, few)
    if heavy is None:
        return by_interval(rows, versions, effective)
    usual = by_interval(
        rows.join(heavy, F.col("_lookup") == F.col("_on"), "left_anti"),
        versions.join(heavy, "_on", "left_anti"),
        effective,
    )
    large = rows.join(heavy, F.col("_lookup") == F.col("_on"), "left_semi")
    begun = F.col("_end").isNull() | (F.col("_end") > F.col(effective))
    looked_up = _carried(
        large.select(F.col("_lookup").alias("_on"), "_moment").distinct(),
        versions.filter(begun).join(heavy, "_on", "left_semi"),
        effective,
    )
    same = (F.col("_lookup") == F.col("_on")) & F.col("_moment").eqNullSafe(F.col("_time"))
    found = large.join(looked_up, same, "left").drop("_time")
    return usual.unionByName(found)


def _carried(moments: DataFrame, versions: DataFrame, effective: str) -> DataFrame:
    """The version valid at each (member, moment); moments without one are left out."""
    wanted = [c for c in versions.columns if c != "_on"]
    version = F.struct(*wanted)
    points = versions.select(
        "_on", F.col(effective).alias("_time"), F.lit(0).alias("_asks"), version.alias("_version")
    ).unionByName(
        moments.select(
            "_on",
            F.col("_moment").alias("_time"),
            F.lit(1).alias("_asks"),
            F.lit(None).cast(versions.select(version.alias("v")).schema["v"].dataType).alias("_version"),
        )
    )
    points = points.filter(F.col("_time").isNotNull()).withColumn(
        "_chunk", F.floor(F.unix_seconds("_time") / CHUNK_SECONDS)
    )
    # A version that begins at the moment itself counts, so versions come first.
    inside = (
        Window.partitionBy("_on", "_chunk")
        .orderBy("_time", "_asks")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    began = F.when(F.col("_asks") == 0, F.col("_time"))
    states = points.groupBy("_on", "_chunk").agg(F.max_by("_version", began).alias("_left"))
    earlier = Window.partitionBy("_on").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    entered = states.select(
        "_on", "_chunk", F.last("_left", ignorenulls=True).over(earlier).alias("_entered")
    )
    at = (
        points.withColumn("_inside", F.last("_version", ignorenulls=True).over(inside))
        .filter("_asks = 1")
        .join(entered, ["_on", "_chunk"])
        .withColumn("_version", F.coalesce("_inside", "_entered"))
    )
    valid = at.filter(F.col("_version._end").isNull() | (F.col("_time") < F.col("_version._end")))
    return valid.filter("_version is not null").select("_on", "_time", "_version.*")
