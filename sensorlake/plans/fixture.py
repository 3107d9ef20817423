"""Sensor readings derived from the star-schema tables, for Spark and as SQL text.

House = customer, governorate = nation, zone = market segment, batch = day. The sensor
expressions are plain SQL that both engines evaluate alike and are stated once. Scores are
not: Spark computes them with the library's rules, the SQL text states the rules itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import rules
from sensorlake.functions import scoring
from sensorlake.functions.conditional import first_match
from sensorlake.sources import messages

FIRST_DAY = "2024-01-01"

# Reading columns over event (eid, event_time, event_type, value, k), house number h,
# zone, governorate and batch_id.
_READING_SQL = {
    "eid": "eid",
    "event_id": "CAST(eid AS STRING)",
    "event_time": "event_time",
    "batch_id": "batch_id",
    "house_id": "concat('H', lpad(CAST(h AS STRING), 6, '0'))",
    "governorate": "governorate",
    "zone": "zone",
    "latitude": "CASE WHEN h % 50 = 49 THEN NULL ELSE 22e0 + (h % 900) / 1e2 END",
    "longitude": "CASE WHEN h % 50 = 49 THEN NULL ELSE 25e0 + (h % 1000) / 1e2 END",
    "building_type": "CASE WHEN h % 20 < 11 THEN 'apartment' WHEN h % 20 < 14 THEN 'villa' "
    "WHEN h % 20 < 17 THEN 'commercial' WHEN h % 20 = 17 THEN 'factory' ELSE 'governmental' END",
    "year_built": "CAST(1960 + h % 64 AS INT)",
    "risk_profile": "CASE WHEN h % 10 = 0 THEN 'high' WHEN h % 10 < 4 THEN 'medium' ELSE 'low' END",
    "has_gas_connection": "(h % 5 <> 0)",
    "temperature_c": "CASE WHEN event_type = 'signup' THEN 18e0 + k * 3.8e-1 ELSE 18e0 + k * 1.7e-1 END",
    "humidity_pct": "30e0 + k * 4e-1",
    "methane_ppm": "CASE WHEN event_type = 'error' THEN value ELSE value / 2.5e1 END",
    "lpg_ppm": "CASE WHEN event_type = 'error' THEN value * 7e-1 ELSE value / 2.5e1 * 7e-1 END",
    "gas_pressure_kpa": "9e-1 + k * 9e-3",
    "co_ppm": "CASE WHEN event_type = 'purchase' THEN value / 2e1 ELSE k * 2.5e-2 END",
    "smoke_level": "CASE WHEN event_type = 'purchase' THEN value / 8e0 ELSE k / 1.7e1 END",
    "aqi": "CAST(floor(4e1 + k * 5e-1 + CASE WHEN event_type = 'view' THEN value * 3e-1 ELSE 0e0 END) AS INT)",
    "co2_ppm": "CAST(floor(4e2 + k * 2e0 + CASE WHEN event_type = 'click' THEN value * 4e0 ELSE 0e0 END) AS INT)",
    "pm25_ugm3": "5e0 + k * 2.3e-1",
    "pm10_ugm3": "8e0 + k * 4e-1",
    "is_anomaly": "CASE WHEN value > 1.5e2 THEN 1 ELSE 0 END",
}

# Columns that need no sensor value.
_IDENTITY = (
    "eid", "event_id", "event_time", "batch_id", "house_id", "governorate", "zone", "latitude", "longitude", "building_type",
    "year_built", "risk_profile", "has_gas_connection",
)

# Columns damaged after scoring, by event number.
_DAMAGE_SQL = {
    "event_time": "CASE WHEN eid % 61 = 0 THEN NULL ELSE event_time END",
    "house_id": "CASE WHEN eid % 67 = 0 THEN NULL ELSE house_id END",
    "year_built": "CASE WHEN eid % 59 = 0 THEN NULL ELSE year_built END",
    "temperature_c": "CASE WHEN eid % 97 = 0 THEN 999e0 WHEN eid % 53 = 0 THEN NULL "
    "WHEN eid % 37 = 0 THEN 55e0 ELSE temperature_c END",
    "humidity_pct": "CASE WHEN eid % 73 = 0 THEN 130e0 ELSE humidity_pct END",
    "methane_ppm": "CASE WHEN eid % 89 = 0 THEN -5e0 WHEN eid % 47 = 0 THEN NULL "
    "WHEN eid % 43 = 0 THEN 351e0 ELSE methane_ppm END",
    "lpg_ppm": "CASE WHEN eid % 71 = 0 THEN NULL ELSE lpg_ppm END",
    "smoke_level": "CASE WHEN eid % 37 = 0 THEN 60e0 ELSE smoke_level END",
    "aqi": "CASE WHEN eid % 83 = 0 THEN NULL WHEN eid % 79 = 0 THEN 900 ELSE aqi END",
    "risk_score": "CASE WHEN eid % 41 = 0 THEN NULL ELSE risk_score END",
}

# Messages that arrive broken, by event number; the first match applies.
_BROKEN_VALUE = {101: "not json", 107: None}
_BROKEN_TIME = 103


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_number(time: str) -> Column:
    return F.datediff(F.to_date(time), F.lit(FIRST_DAY).cast("date"))


def _sensed(events: DataFrame) -> DataFrame:
    """Events with the number in their JSON and the alert status of their sensors.

    Both come out of generators, which a filter on them cannot pass: the JSON is read once per
    event, and choosing alerts compares a finished column, before any join.
    """
    event = ["event_id", "event_time", "user_id", "event_type", "value"]
    number = F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"))
    counted = events.withColumn("event_time", F.col("ts")).select(*event, F.inline(F.array(number)))
    measured = counted.withColumns({c: F.expr(_READING_SQL[c]) for c in rules.THRESHOLDS})
    status = F.struct(scoring.alert_status().alias("alert_status"))
    return measured.select(*event, "k", F.inline(F.array(status)))


def readings(spark: SparkSession, sf_dir: str, days: tuple[int, int] | None = None, sensors: bool = True, even: bool = False) -> DataFrame:
    """Scored readings; ``days`` limits them to batches ``first <= batch < last``.

    The limit is stated on the event time so that it reaches the Parquet scan. No join is
    hinted: Spark broadcasts customers by their measured size and otherwise shuffles them,
    splitting a user with very many events over tasks. Without ``sensors`` only the columns on
    event and house are made and the JSON is not even scanned. ``even`` spreads the events over all
    tasks before the join: files of few row groups would otherwise leave what follows, and files
    written from it, to a few.
    """
    events = table(spark, sf_dir, "events")
    if days is not None:
        first, last = (F.date_add(F.lit(FIRST_DAY).cast("date"), day).cast("timestamp_ntz") for day in days)
        events = events.where((F.col("ts") >= first) & (F.col("ts") < last))
    if even:
        events = events.hint("rebalance", "event_id")
    if sensors:
        events = _sensed(events)
        names = [*_READING_SQL, "alert_status"]
    else:
        events = events.withColumnRenamed("ts", "event_time")
        names = [c for c in _READING_SQL if c in _IDENTITY]
    joined = (
        events.join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumns({
            "eid": F.col("event_id"),
            "h": F.col("c_custkey"),
            "zone": F.col("c_mktsegment"),
            "governorate": F.col("n_name"),
            "batch_id": day_number("event_time"),
        })
    )
    rows = joined.select(*[F.expr(_READING_SQL.get(c, c)).alias(c) for c in names])
    return rows.withColumn("risk_score", scoring.risk_score()) if sensors else rows


def dirty(scored: DataFrame) -> DataFrame:
    return scored.select(*[F.expr(_DAMAGE_SQL.get(c, c)).alias(c) for c in scored.columns])


def payload(scored: DataFrame) -> DataFrame:
    """Messages of the readings, some of them broken, with their event number."""
    time = F.date_format("event_time", messages.TIME_FORMAT)
    stamped = scored.withColumn("timestamp", F.when(F.col("eid") % _BROKEN_TIME == 0, F.lit("bad")).otherwise(time))
    sent = messages.to_messages(stamped, "eid")
    value = first_match([(F.col("eid") % n == 0, F.lit(text)) for n, text in _BROKEN_VALUE.items()], F.col("value"))
    return sent.withColumn("value", value)


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per house that has readings, without joining every event."""
    active = table(spark, sf_dir, "events").select("user_id").distinct()
    customers = table(spark, sf_dir, "customer")
    joined = (
        customers.join(active, F.col("c_custkey") == F.col("user_id"), "left_semi")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("h"), F.col("c_mktsegment").alias("zone"), F.col("n_name").alias("governorate"))
    )
    columns = ("house_id", "governorate", "zone", "has_gas_connection", "risk_profile")
    return joined.select(*[F.expr(_READING_SQL[c]).alias(c) for c in columns])


def governorate_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds and centre per nation."""
    low = {"lat_min": F.lit(22.0) + F.col("n_nationkey") * 0.2, "lon_min": F.lit(25.0) + F.col("n_nationkey") * 0.2}
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("governorate"), *[c.alias(n) for n, c in low.items()])
    return nations.withColumns({
        "lat_max": F.col("lat_min") + 4.0,
        "lon_max": F.col("lon_min") + 4.0,
        "centre_lat": F.col("lat_min") + 2.0,
        "centre_lon": F.col("lon_min") + 2.0,
    })


def zone_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates per (nation, segment); the MACHINERY segments have none, so their centre is used."""
    customers = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    zones = customers.select("c_nationkey", "c_mktsegment").distinct()
    joined = zones.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    offset = F.length("c_mktsegment") * 0.1
    return joined.select(
        F.col("n_name").alias("governorate"),
        F.col("c_mktsegment").alias("zone"),
        (offset + 22.0).alias("zone_lat"),
        (offset + 25.0).alias("zone_lon"),
    )
