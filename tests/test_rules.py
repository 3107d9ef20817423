"""Rules at, just below and just above each threshold, and on missing values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from samples import readings, values
from sensorlake import rules
from sensorlake.functions import display, levels, scoring


@pytest.mark.parametrize("sensor", rules.THRESHOLDS)
def test_alert_status(spark, sensor):
    warning, critical = rules.THRESHOLDS[sensor]
    step = 1 if sensor in ("aqi", "co2_ppm") else 0.01
    kind = int if step == 1 else float
    cases = {
        kind(warning - step): "NORMAL", kind(warning): "WARNING", kind(warning + step): "WARNING",
        kind(critical - step): "WARNING", kind(critical): "CRITICAL", kind(critical + step): "CRITICAL", None: "NORMAL",
    }
    rows = readings(spark, *[{sensor: value} for value in cases]).withColumn("got", scoring.alert_status())
    assert values(rows, sensor, "got") == cases


def test_any_critical_beats_any_warning(spark):
    row = readings(spark, {"methane_ppm": 60.0, "temperature_c": 56.0}).select(scoring.alert_status().alias("s")).first()
    assert row.s == "CRITICAL"


def _expected_risk(row: dict) -> float:
    total = sum(min((row[s] or 0) / rules.THRESHOLDS[s][1], 1.0) * w for s, w in rules.RISK_WEIGHTS.items())
    return round(min(total * rules.PROFILE_FACTORS.get(row["risk_profile"], 1.0), 100.0), 2)


def test_risk_score(spark):
    full = {"methane_ppm": 500.0, "lpg_ppm": 500.0, "smoke_level": 90.0, "co_ppm": 80.0, "aqi": 400, "co2_ppm": 5000, "temperature_c": 60.0}
    cases = [
        {}, full, {**full, "risk_profile": "low"}, {**full, "risk_profile": "high"}, {"risk_profile": "unknown"},
        {"methane_ppm": None}, {"aqi": None, "temperature_c": None}, {"methane_ppm": 75.0, "risk_profile": "high"},
    ]
    rows = readings(spark, *cases).withColumn("got", scoring.risk_score()).collect()
    for row in rows:
        assert row.got == pytest.approx(_expected_risk(row.asDict()), abs=0.01)
    assert rows[1].got == 100.0 and rows[2].got == 85.0 and rows[3].got == 100.0


def test_root_cause_order(spark):
    cases = [
        ({"methane_ppm": 50.0, "temperature_c": 60.0, "smoke_level": 60.0}, "GAS_LEAK"),
        ({"methane_ppm": 49.99, "temperature_c": 42.0, "smoke_level": 60.0}, "HIGH_TEMP"),
        ({"methane_ppm": 49.99, "temperature_c": 41.99, "smoke_level": 20.0}, "SMOKE_SPIKE"),
        ({"methane_ppm": None, "temperature_c": None, "smoke_level": None}, "ELEVATED_RISK"),
    ]
    rows = readings(spark, *[c for c, _ in cases]).withColumn("got", scoring.root_cause())
    assert [r.got for r in rows.orderBy("event_id").collect()] == [cause for _, cause in cases]


def test_flags_are_strict_and_never_null(spark):
    cases = [
        ({"methane_ppm": 350.0, "lpg_ppm": 300.0}, (False, False, False)),
        ({"methane_ppm": 350.01}, (True, False, False)),
        ({"lpg_ppm": 300.01, "methane_ppm": None}, (True, False, False)),
        ({"temperature_c": 50.01, "smoke_level": 50.0}, (False, False, False)),
        ({"temperature_c": 50.01, "smoke_level": 50.01}, (False, True, False)),
        ({"aqi": 150}, (False, False, False)),
        ({"aqi": 151}, (False, False, True)),
        ({"aqi": None, "temperature_c": None, "methane_ppm": None, "lpg_ppm": None}, (False, False, False)),
    ]
    flags = readings(spark, *[c for c, _ in cases]).orderBy("event_id").select(
        scoring.gas_leak_flag(), scoring.fire_risk_flag(), scoring.pollution_flag()
    )
    assert [tuple(r) for r in flags.collect()] == [expected for _, expected in cases]


def test_risk_level(spark):
    cases = {70.0: "CRITICAL", 69.99: "HIGH", 40.0: "HIGH", 39.99: "MEDIUM", 20.0: "MEDIUM", 19.99: "LOW", None: "LOW"}
    rows = readings(spark, *[{"risk_score": x} for x in cases]).withColumn("got", scoring.risk_level())
    assert values(rows, "risk_score", "got") == cases


def test_region_levels(spark):
    frame = spark.createDataFrame(
        [(0, 0, 11.9), (0, 0, 12.0), (0, 0, 15.0), (0, 1, 0.0), (0, 3, 0.0), (1, 0, 0.0), (2, 0, 0.0), (0, 2, None)],
        "critical_count long, warning_count long, avg_risk_score double",
    )
    got = frame.select(levels.zone_risk_level(), levels.gov_risk_level()).collect()
    assert [r[0] for r in got] == ["LOW", "LOW", "MEDIUM", "WARNING", "WARNING", "CRITICAL", "CRITICAL", "WARNING"]
    assert [r[1] for r in got] == ["LOW", "MEDIUM", "MEDIUM", "LOW", "WARNING", "WARNING", "CRITICAL", "LOW"]


def test_bands(spark):
    frame = spark.createDataFrame([(7.99,), (8.0,), (11.99,), (12.0,), (49.99,), (50.0,), (150.0,)], "avg_risk double")
    got = frame.select(levels.risk_band(), levels.methane_band(F.col("avg_risk"))).collect()
    assert [r[0] for r in got] == ["GREEN", "ORANGE", "ORANGE", "RED", "RED", "RED", "RED"]
    assert [r[1] for r in got] == ["NORMAL"] * 5 + ["WARNING", "CRITICAL"]


def test_rounding_is_steady_around_ties(spark):
    frame = spark.createDataFrame([(0.25,), (0.25 - 1e-14,), (-0.25,), (0.2,), (None,)], "x double")
    got = [r[0] for r in frame.select(display.rounded(F.col("x"))).collect()]
    assert got == [0.3, 0.3, -0.3, 0.2, 0.0]
