"""Registered queries: every operator over the whole driver tables.

Time stamps are returned as text and means rounded, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampNTZType, TimestampType

from sensorlake.functions.display import rounded
from sensorlake.functions.scoring import root_cause
from sensorlake.operators import fleet, gold, report, silver, snapshot, trends, views
from sensorlake.plans import fixture
from sensorlake.plans.warehouse import Warehouse, warehouse
from sensorlake.sources import messages
from sensorlake.sources.layers import Lake, layer_counts, with_time_parts

# Batches are days, so the minutes of the live trend become days.
LONG_HORIZON, SHORT_HORIZON = "7 days", "3 days"
PAST_BATCH = 12
SCAN_RANGE = (datetime(2024, 1, 8, 6), datetime(2024, 1, 12, 18, 30))
HIGH_TIER, MEDIUM_TIER = ("MACHINERY",), ("HOUSEHOLD",)

PAYLOAD = (
    "event_id", "batch_id", "house_id", "governorate", "zone", "latitude", "longitude", "building_type", "year_built",
    "risk_profile", "has_gas_connection", "temperature_c", "humidity_pct", "methane_ppm", "lpg_ppm", "gas_pressure_kpa",
    "co_ppm", "smoke_level", "aqi", "co2_ppm", "pm25_ugm3", "pm10_ugm3", "alert_status", "risk_score", "is_anomaly",
)
SENSORS = (
    "temperature_c", "humidity_pct", "methane_ppm", "lpg_ppm", "co_ppm", "smoke_level", "aqi", "co2_ppm", "pm25_ugm3",
    "pm10_ugm3",
)


def comparable(df: DataFrame) -> DataFrame:
    """Times as text, decimals as doubles, means rounded."""
    shown = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, TimestampType | TimestampNTZType):
            shown[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, DecimalType):
            shown[field.name] = F.col(field.name).cast("double")
        elif field.name.startswith("avg_"):
            shown[field.name] = rounded(F.col(field.name), 4)
    return df.withColumns(shown) if shown else df


def _totals(readings: DataFrame) -> DataFrame:
    return gold.region_totals(readings)


# --- scoring, cleaning, statistics ----------------------------------------------------------


def score_alert_status(w: Warehouse) -> DataFrame:
    return w.readings.select("event_id", "batch_id", "alert_status")


def score_risk(w: Warehouse) -> DataFrame:
    return w.readings.select("event_id", "risk_profile", "risk_score")


def root_causes(w: Warehouse) -> DataFrame:
    return w.readings.where(F.col("alert_status") != "NORMAL").select("event_id", root_cause().alias("cause"))


def active_alerts(w: Warehouse) -> DataFrame:
    return gold.active_alerts(w.readings)


def silver_clean(w: Warehouse) -> DataFrame:
    return silver.clean(w.dirty).select("event_id", "house_id", "event_time", *SENSORS)


def silver_features(w: Warehouse) -> DataFrame:
    features = silver.enrich(silver.clean(w.dirty))
    flags = ("building_age", "gas_leak_flag", "fire_risk_flag", "pollution_flag", "risk_level")
    return with_time_parts(features).select("event_id", *flags, "year", "month", "day", "hour")


def zone_stats(w: Warehouse) -> DataFrame:
    return gold.zone_stats(_totals(w.readings))


def zone_stats_raw(w: Warehouse) -> DataFrame:
    return gold.zone_stats(_totals(w.dirty))


def zone_stats_silver(w: Warehouse) -> DataFrame:
    return gold.zone_stats(_totals(silver.clean(w.dirty)))


def gov_stats(w: Warehouse) -> DataFrame:
    return gold.gov_stats(_totals(w.readings))


def gov_stats_raw(w: Warehouse) -> DataFrame:
    return gold.gov_stats(_totals(w.dirty))


# --- snapshots ------------------------------------------------------------------------------


def kpis(w: Warehouse) -> DataFrame:
    return views.kpis(w.alerts, w.gov, w.total_houses())


def _feed(w: Warehouse) -> DataFrame:
    return views.alert_feed(w.alerts)


def _trend(w: Warehouse) -> DataFrame:
    return trends.methane_trend(w.zones, LONG_HORIZON, 50)


def gold_sql_scan(w: Warehouse) -> DataFrame:
    w.history.register_gold(w.spark)
    return w.spark.sql("""
        SELECT governorate, zone, total_readings, critical_count, zone_risk_level
        FROM zone_stats
        WHERE batch_id = (SELECT max(newest_batch) FROM gold_heads WHERE table_name = 'zone_stats')
    """)


def dedup_alerts(w: Warehouse) -> DataFrame:
    return snapshot.one_per_house(w.alerts.rows, ["batch_id", "house_id"]).select(
        "batch_id", "house_id", "event_id", "alert_status", "risk_score"
    )


def alerts_by_selected_gov(w: Warehouse) -> DataFrame:
    feed = _feed(w)
    return views.drill_down(feed, feed.limit(1).select("governorate").scalar())


def alert_feed_nested(w: Warehouse) -> DataFrame:
    return views.nested_feed(w.alerts).withColumn("sensors", F.to_json("sensors"))


def map_markers_nested(w: Warehouse) -> DataFrame:
    markers = views.nested_markers(w.alerts)
    return markers.withColumns({c: F.to_json(c) for c in ("coordinates", "sensors")})


def methane_direction(w: Warehouse) -> DataFrame:
    five = trends.long_direction(trends.recent(w.zones, SHORT_HORIZON, 5))
    last = trends.short_direction(trends.plausible(_trend(w)))
    facts = five.select(F.struct("newest", "oldest", "direction")).scalar()
    return last.withColumn("five", facts).select("latest", "before", "arrow", "band", "five.*")


def insight_banner(w: Warehouse) -> DataFrame:
    return views.insight_banner(kpis(w), w.gov)


def _report(w: Warehouse, batch_id: int | None = None) -> DataFrame:
    return report.live_snapshot(w.alerts, w.gov, w.zones, w.total_houses(), batch_id, SHORT_HORIZON)


# --- fleet ----------------------------------------------------------------------------------


def geo_clamp(w: Warehouse) -> DataFrame:
    located = fleet.locate(w.places, fixture.governorate_dim(w.spark, w.sf_dir), w.zone_dim)
    return located.select("event_id", "clamped_lat", "clamped_lon", "outside_bounds")


def zone_tier(w: Warehouse) -> DataFrame:
    return fleet.zone_tier(w.places, HIGH_TIER, MEDIUM_TIER).select("event_id", "zone", "tier")


# --- messages, layers, streams --------------------------------------------------------------


def _payload(parsed: DataFrame, *more: str) -> DataFrame:
    return parsed.withColumn("has_gas_connection", F.col("has_gas_connection").cast("string")).select(
        *PAYLOAD, "event_time", "raw_value", *more
    )


def parse_readings(w: Warehouse) -> DataFrame:
    position = {"partition": F.pmod("eid", F.lit(3)).cast("int"), "offset": F.col("eid")}
    sent = fixture.payload(w.readings).withColumns(position)
    return _payload(messages.parse(sent), "kafka_partition", "kafka_offset")


def publish_roundtrip(w: Warehouse) -> DataFrame:
    return _payload(messages.parse(messages.read_files(w.spark, w.published)))


def bronze_partitions(w: Warehouse) -> DataFrame:
    return with_time_parts(fixture.dirty(w.places)).groupBy("year", "month", "day", "hour").agg(F.count("*").alias("row_count"))


def partition_pruned_scan(w: Warehouse) -> DataFrame:
    return w.damaged.hours(w.spark, "bronze", *SCAN_RANGE).select("event_id", "house_id", "event_time", "methane_ppm", "hour")


def rejected_rows(w: Warehouse) -> DataFrame:
    return w.cleaned.read_rejected(w.spark).select("table_name", "event_id", "house_id", "event_time", "reasons", "dropped", "batch_id")


def stream_bronze(w: Warehouse) -> DataFrame:
    return w.streamed.read_bronze(w.spark).select(
        "event_id", "house_id", "event_time", "methane_ppm", "raw_value", "ingest_batch", "year", "month", "day", "hour"
    )


def _silver(w: Warehouse, lake: Lake) -> DataFrame:
    return lake.read_silver(w.spark).select(
        "event_id", "house_id", "event_time", *SENSORS, "building_age", "gas_leak_flag", "risk_level", "ingest_batch"
    )


def stream_restart(w: Warehouse) -> DataFrame:
    """Readings per micro-batch after several restarts; a repeated reading would show."""
    return w.streamed.read_bronze(w.spark).groupBy("ingest_batch").agg(
        F.count("event_id").alias("readings"),
        F.count_distinct("event_id").alias("distinct_readings"),
        F.count("*").alias("row_count"),
    )


def stream_stamps(w: Warehouse) -> DataFrame:
    """Clock readings of every micro-batch: each row has one, and all of a micro-batch the same."""
    layers = (("bronze", w.streamed.read_bronze(w.spark), "ingested_at"), ("silver", w.streamed.read_silver(w.spark), "processed_at"))
    bronze, cleaned = (
        rows.groupBy("ingest_batch").agg(
            F.lit(layer).alias("layer"), F.count("*").alias("row_count"), F.count(stamp).alias("stamped"), F.count_distinct(stamp).alias("stamps")
        )
        for layer, rows, stamp in layers
    )
    return bronze.unionByName(cleaned)


_QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    "score_alert_status": score_alert_status,
    "score_risk": score_risk,
    "root_cause": root_causes,
    "active_alerts": active_alerts,
    "silver_clean": silver_clean,
    "silver_features": silver_features,
    "zone_stats": zone_stats,
    "zone_stats_raw": zone_stats_raw,
    "zone_stats_silver": zone_stats_silver,
    "gov_stats": gov_stats,
    "gov_stats_raw": gov_stats_raw,
    "latest_snapshot": lambda w: snapshot.latest(w.gov),
    "gold_sql_scan": gold_sql_scan,
    "dedup_alerts": dedup_alerts,
    "kpis": kpis,
    "count_critical": lambda w: views.status_count(w.alerts, "CRITICAL"),
    "count_warning": lambda w: views.status_count(w.alerts, "WARNING"),
    "avg_risk_decimal": lambda w: views.average_risk(w.gov),
    "risk_by_gov": lambda w: views.shown_risk(views.risk_by_governorate(w.gov)),
    "gov_ranking": lambda w: views.shown_risk(views.risk_by_governorate(w.gov)).drop("max_risk"),
    "gov_ranking_dedup": lambda w: views.shown_risk(views.deduplicated_ranking(w.alerts, w.gov)),
    "gov_risk_band": lambda w: views.risk_bands(w.gov),
    "top_governorate": lambda w: views.top_governorate(w.gov),
    "map_markers": lambda w: views.map_markers(w.alerts),
    "map_markers_nested": map_markers_nested,
    "map_severity": lambda w: views.map_points(w.alerts),
    "alert_feed": _feed,
    "alert_feed_nested": alert_feed_nested,
    "alerts_by_selected_gov": alerts_by_selected_gov,
    "alerts_table_top20": lambda w: views.alerts_table(w.alerts),
    "top5_critical": lambda w: views.top_incidents(w.alerts, "CRITICAL"),
    "top5_warning": lambda w: views.top_incidents(w.alerts, "WARNING"),
    "trigger_sensor": lambda w: views.trigger_sensors(_feed(w)),
    "methane_trend": _trend,
    "methane_trend_short": lambda w: trends.methane_trend(w.zones, SHORT_HORIZON, 5),
    "methane_trend_clean": lambda w: trends.plausible(_trend(w)),
    "methane_direction": methane_direction,
    "kpi_delta": lambda w: views.kpi_history(w.alerts, w.gov),
    "threat_distribution": lambda w: views.threat_distribution(kpis(w)),
    "insight_banner": insight_banner,
    "live_snapshot": _report,
    "snapshot_at_batch": lambda w: _report(w, PAST_BATCH),
    "batch_summary": lambda w: fleet.batch_summary(w.readings),
    "fleet_profile": lambda w: fleet.fleet_profile(fleet.houses(w.places)),
    "active_anomalies_top5": lambda w: fleet.active_anomalies(w.readings),
    "geo_clamp": geo_clamp,
    "zone_tier": zone_tier,
    "parse_readings": parse_readings,
    "publish_roundtrip": publish_roundtrip,
    "bronze_partitions": bronze_partitions,
    "partition_pruned_scan": partition_pruned_scan,
    "stream_bronze": stream_bronze,
    "stream_silver": lambda w: _silver(w, w.streamed),
    "stream_silver_chained": lambda w: _silver(w, w.chained),
    "stream_gold_zone": lambda w: w.streamed.read_gold(w.spark, "zone_stats"),
    "stream_gold_gov": lambda w: w.streamed.read_gold(w.spark, "gov_stats"),
    "stream_gold_alerts": lambda w: w.streamed.read_gold(w.spark, "active_alerts"),
    "stream_restart": stream_restart,
    "stream_stamps": stream_stamps,
    "layer_counts": lambda w: layer_counts(w.spark, w.streamed),
    "stream_paced": lambda w: layer_counts(w.spark, w.paced),
    "house_alerts": lambda w: w.history.read_houses(w.spark).select(
        "batch_id", "house_id", "event_id", "alert_status", "primary_trigger", *snapshot.FIRSTS
    ),
    "rejected_rows": rejected_rows,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: comparable(query(warehouse(spark, sf_dir)))

    return {name: bound(query) for name, query in _QUERIES.items()}
