"""Hand-made rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import schemas

CALM = {
    "event_id": "e0", "timestamp": "2024-01-01 00:00:00", "batch_id": 1, "house_id": "H1", "governorate": "Cairo", "zone": "Maadi",
    "latitude": 30.0, "longitude": 31.3, "building_type": "villa", "year_built": 2000, "risk_profile": "medium",
    "has_gas_connection": True, "temperature_c": 20.0, "humidity_pct": 50.0, "methane_ppm": 2.0, "lpg_ppm": 2.0,
    "gas_pressure_kpa": 1.2, "co_ppm": 1.0, "smoke_level": 1.0, "aqi": 60, "co2_ppm": 450, "pm25_ugm3": 10.0, "pm10_ugm3": 20.0,
    "alert_status": "NORMAL", "risk_score": 5.0, "is_anomaly": 0,
}


def readings(spark: SparkSession, *changes: dict) -> DataFrame:
    rows = [{**CALM, "event_id": f"e{i}", **change} for i, change in enumerate(changes)]
    frame = spark.createDataFrame([tuple(row[c] for c in schemas.READING.names) for row in rows], schemas.READING)
    return frame.withColumn("event_time", F.try_to_timestamp("timestamp", F.lit("yyyy-MM-dd HH:mm:ss")))


def values(df: DataFrame, key: str, value: str) -> dict:
    return {row[key]: row[value] for row in df.select(key, value).collect()}
