"""Per-reading rules: alert status, risk score, root cause, cleaned-layer flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorlake import rules
from sensorlake.functions.conditional import any_of, first_match


def alert_status(thresholds: dict[str, tuple[float, float]] = rules.THRESHOLDS) -> Column:
    """CRITICAL if any sensor is at its critical threshold, else WARNING likewise, else NORMAL."""
    return first_match(
        [
            (any_of(F.col(sensor) >= critical for sensor, (_, critical) in thresholds.items()), "CRITICAL"),
            (any_of(F.col(sensor) >= warning for sensor, (warning, _) in thresholds.items()), "WARNING"),
        ],
        "NORMAL",
    )


def risk_score(
    weights: dict[str, float] = rules.RISK_WEIGHTS,
    thresholds: dict[str, tuple[float, float]] = rules.THRESHOLDS,
    profile: str = "risk_profile",
) -> Column:
    """Weighted share of each critical threshold reached, scaled by house profile, 0 to 100.

    A missing sensor adds nothing: ``least`` skips NULL, so it is replaced before.
    """
    points = [
        F.least(F.coalesce(F.col(sensor), F.lit(0.0)) / F.lit(thresholds[sensor][1]), F.lit(1.0)) * F.lit(weight)
        for sensor, weight in weights.items()
    ]
    total = points[0]
    for more in points[1:]:
        total = total + more
    factor = first_match([(F.col(profile) == p, f) for p, f in rules.PROFILE_FACTORS.items()], 1.0)
    return F.round(F.least(total * factor, F.lit(rules.MAX_RISK)), 2)


def root_cause() -> Column:
    """First sensor at its warning threshold, in the order gas, heat, smoke."""
    return first_match(
        [(F.coalesce(F.col(sensor), F.lit(0.0)) >= limit, cause) for sensor, limit, cause in rules.ROOT_CAUSES],
        rules.OTHER_CAUSE,
    )


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def gas_leak_flag() -> Column:
    return _flag((F.col("methane_ppm") > rules.GAS_LEAK_METHANE) | (F.col("lpg_ppm") > rules.GAS_LEAK_LPG))


def fire_risk_flag() -> Column:
    return _flag((F.col("temperature_c") > rules.FIRE_TEMPERATURE) & (F.col("smoke_level") > rules.FIRE_SMOKE))


def pollution_flag() -> Column:
    return _flag(F.col("aqi") > rules.POLLUTION_AQI)


def risk_level() -> Column:
    """Bucket of the reading's risk score; NULL counts as LOW."""
    return first_match([(F.col("risk_score") >= at, level) for at, level in rules.RISK_BUCKETS], "LOW")
