"""Snapshot statistics: per zone, per governorate, and the alert list.

Both statistics come from one aggregation per (batch, governorate, zone) that keeps sums and
counts. It is partially aggregated before its shuffle, so a zone with a large share of the
readings still sends one row per task, and governorate means are exact means over readings,
not means of zone means. Zone names repeat across governorates, so a zone is always keyed
with its governorate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions.levels import gov_risk_level, zone_risk_level

_AVERAGED = ("methane_ppm", "temperature_c", "smoke_level", "co_ppm", "aqi", "risk_score")
_PEAKS = ("methane_ppm", "aqi", "risk_score")
# Columns of an alert.
_ALERT_COLUMNS = (
    "event_id", "house_id", "governorate", "zone", "latitude", "longitude", "building_type", "alert_status",
    "risk_score", "methane_ppm", "smoke_level", "co_ppm", "temperature_c", "aqi", "is_anomaly",
)

# Columns of a reading that statistics and alerts use.
INPUTS = (*_ALERT_COLUMNS, "event_time", "batch_id")


def region_totals(readings: DataFrame, batch_id: int | None = None, snapshot_time: Column | None = None) -> DataFrame:
    """Sums, counts and peaks per (batch, governorate, zone).

    Without ``batch_id`` the reading's own batch number groups as well, which computes a whole
    history at once. Without ``snapshot_time`` a batch is stamped with its newest event time.
    """
    batch = F.col("batch_id") if batch_id is None else F.lit(batch_id)
    totals = readings.groupBy(batch.cast("bigint").alias("batch_id"), "governorate", "zone").agg(
        *[F.sum(c).alias(f"sum_{c}") for c in _AVERAGED],
        *[F.count(c).alias(f"n_{c}") for c in _AVERAGED],
        *[F.max(c).alias(f"max_{c}") for c in _PEAKS],
        F.count("*").alias("readings"),
        F.count_if(F.col("alert_status") == "CRITICAL").alias("critical_count"),
        F.count_if(F.col("alert_status") == "WARNING").alias("warning_count"),
        F.sum("is_anomaly").alias("anomalies"),
        F.max("event_time").alias("newest"),
    )
    stamp = F.max("newest").over(W.partitionBy("batch_id")) if snapshot_time is None else snapshot_time
    return totals.withColumn("snapshot_time", stamp).drop("newest")


def _mean(sensor: str) -> Column:
    return F.try_divide(f"sum_{sensor}", f"n_{sensor}").alias(f"avg_{sensor}")


def zone_stats(totals: DataFrame) -> DataFrame:
    return totals.select(
        "batch_id",
        "snapshot_time",
        "governorate",
        "zone",
        *[_mean(c) for c in _AVERAGED],
        *[f"max_{c}" for c in _PEAKS],
        F.col("readings").alias("total_readings"),
        "critical_count",
        "warning_count",
        F.col("anomalies").alias("anomaly_count"),
    ).withColumn("zone_risk_level", zone_risk_level())


def gov_stats(totals: DataFrame) -> DataFrame:
    """Statistics per governorate; ``total_houses`` counts readings, as consumers expect."""
    averaged = ("risk_score", "methane_ppm", "aqi", "temperature_c")
    added = [f"{kind}_{c}" for c in averaged for kind in ("sum", "n")]
    merged = totals.groupBy("batch_id", "governorate").agg(
        F.max("snapshot_time").alias("snapshot_time"),
        F.max("max_risk_score").alias("max_risk_score"),
        *[F.sum(c).alias(c) for c in (*added, "readings", "critical_count", "warning_count", "anomalies")],
    )
    return merged.select(
        "batch_id",
        "snapshot_time",
        "governorate",
        *[_mean(c) for c in averaged],
        "max_risk_score",
        F.col("readings").alias("total_houses"),
        "critical_count",
        "warning_count",
        F.col("anomalies").alias("total_anomalies"),
    ).withColumn("gov_risk_level", gov_risk_level())


def active_alerts(readings: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Readings in WARNING or CRITICAL state, with the columns alert consumers use."""
    batch = F.col("batch_id") if batch_id is None else F.lit(batch_id)
    return readings.where(F.col("alert_status").isin("WARNING", "CRITICAL")).select(
        batch.cast("bigint").alias("batch_id"),
        *_ALERT_COLUMNS,
        F.col("event_time").alias("alert_time"),
    )
