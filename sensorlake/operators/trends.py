"""Methane over recent snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake import rules
from sensorlake.functions.display import rounded
from sensorlake.functions.levels import direction, methane_band
from sensorlake.sources.layers import GoldTable, Statistics, rows_of

LONG_LABELS = ("RISING", "FALLING", "STABLE")


def recent(zones: Statistics, horizon: str = "5 minutes", limit: int = 50, as_of: Column | None = None) -> DataFrame:
    """Mean of the zones' mean methane per snapshot, the newest ``limit`` within ``horizon``.

    ``as_of`` defaults to the newest snapshot in the table. For a stored table that comes from the last
    publication, and the batches of the horizon from the days that can hold them, so only their
    partitions are opened; the bound on the time is the whole of a scalar subquery, whose result
    reaches the Parquet scan.
    """
    span = F.expr(f"INTERVAL {horizon}")
    rows = rows_of(zones)
    stored = isinstance(zones, GoldTable)
    newest = zones.head.agg(F.max("newest_time") - span) if stored else rows.agg(F.max("snapshot_time") - span)
    oldest = newest.scalar() if as_of is None else as_of - span
    if stored:
        rows = rows.where(F.col("batch_id") >= zones.snapshots(since=oldest).agg(F.min("batch_id")).scalar())
    return (
        rows.where(F.col("snapshot_time") >= oldest)
        .groupBy("snapshot_time")
        .agg(F.avg("avg_methane_ppm").alias("value"))
        .orderBy(F.desc("snapshot_time"))
        .limit(limit)
    )


def methane_trend(zones: Statistics, horizon: str = "5 minutes", limit: int = 50, as_of: Column | None = None) -> DataFrame:
    """Trend points, oldest first, with a clock label."""
    return (
        recent(zones, horizon, limit, as_of)
        .orderBy("snapshot_time")
        .select(
            "snapshot_time",
            F.date_format("snapshot_time", "HH:mm:ss").alias("clock"),
            rounded(F.col("value"), 2).alias("value"),
        )
    )


def plausible(trend: DataFrame) -> DataFrame:
    """Trend with values outside the sensor's range shown as 0."""
    low, high = rules.PLAUSIBLE_METHANE
    inside = (F.col("value") > low) & (F.col("value") < high)
    return trend.withColumn("value", F.when(inside, F.col("value")).otherwise(0.0))


def long_direction(points: DataFrame) -> DataFrame:
    """RISING, FALLING or STABLE between the oldest and the newest of a few trend points."""
    ends = points.agg(
        rounded(F.max_by("value", "snapshot_time"), 2).alias("newest"),
        rounded(F.min_by("value", "snapshot_time"), 2).alias("oldest"),
    )
    return ends.withColumn("direction", direction(F.col("newest"), F.col("oldest"), LONG_LABELS))


def short_direction(trend: DataFrame) -> DataFrame:
    """Arrow and band of the newest trend point against the one before.

    ``trend`` is already limited to its newest points, which bounds the window.
    """
    newest_first = W.orderBy(F.desc("snapshot_time"))
    points = trend.withColumn("before", F.lead("value").over(newest_first)).orderBy(F.desc("snapshot_time")).limit(1)
    before = F.coalesce("before", F.lit(0.0))
    return points.select(
        F.col("value").alias("latest"),
        before.alias("before"),
        direction(F.col("value"), before, ("↑", "↓", "→")).alias("arrow"),
        methane_band(F.col("value")).alias("band"),
    )
