"""Declared schemas of the message payload and of every stored layer.

Schemas are fixed, never inferred: readers pass them to Spark and writers project onto
them, so a column added upstream cannot leak into a layer. Sensor values are DOUBLE
because 32-bit parsing would turn 12.34 into 12.34000015258789.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "STRING": StringType(),
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "DOUBLE": DoubleType(),
    "BOOLEAN": BooleanType(),
    "TIMESTAMP": TimestampType(),
    "DATE": DateType(),
}


def _schema(columns: str) -> StructType:
    """Schema from ``name TYPE, ...``; unlike Spark's own reader it needs no running session."""
    named = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in named])


# The 26 fields of a message payload, in publishing order.
READING = _schema("""
    event_id STRING, timestamp STRING, batch_id INT, house_id STRING, governorate STRING, zone STRING,
    latitude DOUBLE, longitude DOUBLE, building_type STRING, year_built INT, risk_profile STRING,
    has_gas_connection BOOLEAN, temperature_c DOUBLE, humidity_pct DOUBLE, methane_ppm DOUBLE,
    lpg_ppm DOUBLE, gas_pressure_kpa DOUBLE, co_ppm DOUBLE, smoke_level DOUBLE, aqi INT, co2_ppm INT,
    pm25_ugm3 DOUBLE, pm10_ugm3 DOUBLE, alert_status STRING, risk_score DOUBLE, is_anomaly INT
""")

MESSAGE = _schema("key STRING, value STRING")

TIME_PARTS = ("year", "month", "day", "hour")
# ``part`` is the micro-batch whose rows a directory holds, or -1 for the folded rows of an hour.
LAYER_KEYS = (*TIME_PARTS, "part")

_LAYER_KEY_DDL = "year INT, month INT, day INT, hour INT, part BIGINT"
_PARSED = [*READING.fields, *_schema("kafka_partition INT, kafka_offset BIGINT, event_time TIMESTAMP")]

# ``raw_value`` keeps the payload of a message that did not parse; it is NULL otherwise.
BRONZE = StructType(
    [*_PARSED, *_schema(f"raw_value STRING, ingested_at TIMESTAMP, ingest_batch BIGINT, {_LAYER_KEY_DDL}")]
)

SILVER = StructType([
    *_PARSED,
    *_schema(
        "building_age INT, gas_leak_flag BOOLEAN, fire_risk_flag BOOLEAN, pollution_flag BOOLEAN, "
        f"risk_level STRING, processed_at TIMESTAMP, ingest_batch BIGINT, {_LAYER_KEY_DDL}"
    ),
])

ZONE_STATS = _schema("""
    snapshot_time TIMESTAMP, governorate STRING, zone STRING, avg_methane_ppm DOUBLE, max_methane_ppm DOUBLE,
    avg_temperature_c DOUBLE, avg_smoke_level DOUBLE, avg_co_ppm DOUBLE, avg_aqi DOUBLE, max_aqi INT,
    avg_risk_score DOUBLE, max_risk_score DOUBLE, total_readings BIGINT, critical_count BIGINT,
    warning_count BIGINT, anomaly_count BIGINT, zone_risk_level STRING, batch_id BIGINT
""")

GOV_STATS = _schema("""
    snapshot_time TIMESTAMP, governorate STRING, avg_risk_score DOUBLE, max_risk_score DOUBLE,
    avg_methane_ppm DOUBLE, avg_aqi DOUBLE, avg_temperature_c DOUBLE, total_houses BIGINT,
    critical_count BIGINT, warning_count BIGINT, total_anomalies BIGINT, gov_risk_level STRING, batch_id BIGINT
""")

ACTIVE_ALERTS = _schema("""
    event_id STRING, house_id STRING, governorate STRING, zone STRING, latitude DOUBLE, longitude DOUBLE,
    building_type STRING, alert_status STRING, risk_score DOUBLE, methane_ppm DOUBLE, smoke_level DOUBLE,
    co_ppm DOUBLE, temperature_c DOUBLE, aqi INT, is_anomaly INT, alert_time TIMESTAMP, batch_id BIGINT
""")

# The most severe alerts of each house in a batch, with their cause and what each is first among.
HOUSE_ALERTS = StructType([
    *(f for f in ACTIVE_ALERTS.fields if f.name != "batch_id"),
    *_schema("primary_trigger STRING, first_of_house BOOLEAN, first_of_status BOOLEAN, first_placed BOOLEAN, first_on_latitude BOOLEAN, batch_id BIGINT"),
])

# Rows that break a constraint, with what they break; ``dropped`` ones are in no other table.
REJECTED = _schema("""
    event_id STRING, house_id STRING, governorate STRING, zone STRING, event_time TIMESTAMP, reasons STRING, dropped BOOLEAN,
    content STRING, table_name STRING, batch_id BIGINT
""")

# What a publication says of its tables: their rows and houses per batch, and each table's head.
_LISTED = "table_name STRING, batch_id BIGINT, snapshot_time TIMESTAMP, row_count BIGINT, critical BIGINT, warning BIGINT"
SNAPSHOT = _schema(f"{_LISTED}, newest_batch BIGINT, newest_critical BIGINT, newest_warning BIGINT, newest_time TIMESTAMP, last_batch BIGINT")
LISTED = _schema(f"{_LISTED}, listed_on DATE")
# Where a streaming query's numbers begin.
QUERY = _schema("query_id STRING, first_number BIGINT")

GOLD = {"zone_stats": ZONE_STATS, "gov_stats": GOV_STATS, "active_alerts": ACTIVE_ALERTS}

# The longest texts that the statistics tables take.
TEXT_LENGTHS = {
    "event_id": 50, "house_id": 10, "governorate": 100, "zone": 100, "building_type": 20, "alert_status": 10,
    "zone_risk_level": 10, "gov_risk_level": 10,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: its columns, its order, its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
