"""Cleaned layer: validated sensors and derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake import rules
from sensorlake.functions import scoring


def clean(readings: DataFrame) -> DataFrame:
    """Drop readings without house or time, blank impossible values, fill the gaps."""
    valid = {
        sensor: F.when(F.col(sensor).between(low, high), F.col(sensor))
        for sensor, (low, high) in rules.VALID_RANGES.items()
    }
    valid["methane_ppm"] = F.when(F.col("methane_ppm") >= 0, F.col("methane_ppm"))
    return readings.dropna(subset=["house_id", "event_time"]).withColumns(valid).fillna(rules.DEFAULTS)


def enrich(cleaned: DataFrame, reference_year: int = rules.REFERENCE_YEAR) -> DataFrame:
    return cleaned.withColumns({
        "building_age": F.lit(reference_year) - F.col("year_built"),
        "gas_leak_flag": scoring.gas_leak_flag(),
        "fire_risk_flag": scoring.fire_risk_flag(),
        "pollution_flag": scoring.pollution_flag(),
        "risk_level": scoring.risk_level(),
    })
