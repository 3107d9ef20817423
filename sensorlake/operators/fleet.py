"""Publishing rounds, the house fleet, and its geography."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake import rules
from sensorlake.functions.conditional import first_match
from sensorlake.functions.display import percent


def batch_summary(readings: DataFrame) -> DataFrame:
    """Readings sent per batch, per status with shares, and anomalies."""
    statuses = ("CRITICAL", "WARNING", "NORMAL")
    counted = readings.groupBy("batch_id").agg(
        F.count("*").alias("sent"),
        *[F.count_if(F.col("alert_status") == s).alias(s.lower()) for s in statuses],
        F.sum("is_anomaly").alias("anomalies"),
    )
    return counted.withColumns({f"{s.lower()}_pct": percent(F.col(s.lower()), F.col("sent")) for s in statuses})


def active_anomalies(readings: DataFrame, per_batch: int = 5) -> DataFrame:
    """The first few houses with an active anomaly in each batch, in fleet order."""
    place = F.row_number().over(W.partitionBy("batch_id").orderBy("house_id", "event_id"))
    return (
        readings.where(F.col("is_anomaly") == 1)
        .select("batch_id", "governorate", "zone", "house_id", "event_id", "methane_ppm", place.alias("place"))
        .where(F.col("place") <= per_batch)
    )


def houses(readings: DataFrame) -> DataFrame:
    """One row per house with its fixed attributes.

    ``distinct`` over the attributes is a hash aggregation that shrinks the readings to about
    one row per house in every task; only then is a house seen with changed attributes settled.
    """
    attributes = ["governorate", "zone", "has_gas_connection", "risk_profile"]
    seen = readings.select("house_id", *attributes).distinct()
    settled = seen.groupBy("house_id").agg(F.max(F.struct(*attributes)).alias("house"))
    return settled.select("house_id", "house.*")


def fleet_profile(fleet: DataFrame) -> DataFrame:
    """Size and make-up of the fleet, from one row per house."""
    counted = fleet.agg(
        F.count("*").alias("houses"),
        F.count_distinct("governorate").alias("governorates"),
        F.count_distinct("zone").alias("zones"),
        F.count_if("has_gas_connection").alias("with_gas"),
        F.count_if(F.col("risk_profile") == "high").alias("high_risk"),
    )
    return counted.withColumns({
        "with_gas_pct": percent(F.col("with_gas"), F.col("houses"), 0),
        "high_risk_pct": percent(F.col("high_risk"), F.col("houses"), 0),
    })


def governorates(spark: SparkSession) -> DataFrame:
    """Default governorate dimension: centre and bounds."""
    rows = ", ".join(f"('{name}', {', '.join(f'{x}D' for x in numbers)})" for name, *numbers in rules.GOVERNORATES)
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS g(governorate, centre_lat, centre_lon, lat_min, lat_max, lon_min, lon_max)"
    )


def zone_tier(
    readings: DataFrame,
    high: tuple[str, ...] = rules.HIGH_RISK_ZONES,
    medium: tuple[str, ...] = rules.MEDIUM_RISK_ZONES,
) -> DataFrame:
    """Add the risk tier of the reading's zone."""
    zone = F.col("zone")
    return readings.withColumn("tier", first_match([(zone.isin(*high), "high"), (zone.isin(*medium), "medium")], "low"))


def locate(readings: DataFrame, governorate_dim: DataFrame, zone_dim: DataFrame | None = None) -> DataFrame:
    """Place every reading inside its governorate.

    Position is the reading's own where both coordinates are known, else its zone's (``zone_dim``: governorate, zone, zone_lat,
    zone_lon), else the governorate's centre; it is then clamped to the governorate's bounds
    and rounded to 6 digits. ``outside_bounds`` marks readings that had to be moved. Readings of
    a governorate without bounds keep their position. The joins carry no hint: Spark
    broadcasts a dimension by its measured size and shuffles a larger one.
    """
    placed = readings.join(governorate_dim, "governorate", "left")
    near = [("latitude", "longitude"), ("centre_lat", "centre_lon")]
    if zone_dim is not None:
        placed = placed.join(zone_dim, ["governorate", "zone"], "left")
        near.insert(1, ("zone_lat", "zone_lon"))
    # A position counts only as a pair: half of one and half of another would be a third place.
    pairs = [F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"))) for lat, lon in near]
    position = F.coalesce(*pairs)
    placed = placed.withColumns({"_lat": position["lat"], "_lon": position["lon"]})

    def clamped(axis: str):
        position, low, high = (F.col(c) for c in (f"_{axis}", f"{axis}_min", f"{axis}_max"))
        bounded = F.greatest(low, F.least(position, high))
        return F.when(position.isNotNull(), F.round(bounded, 6))

    moved = [(F.col(f"_{a}") < F.col(f"{a}_min")) | (F.col(f"_{a}") > F.col(f"{a}_max")) for a in ("lat", "lon")]
    return placed.withColumns({
        "clamped_lat": clamped("lat"),
        "clamped_lon": clamped("lon"),
        "outside_bounds": F.coalesce(moved[0] | moved[1], F.lit(False)),
    }).drop("_lat", "_lon")
