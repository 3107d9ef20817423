"""Levels and bands over aggregated values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorlake import rules
from sensorlake.functions.conditional import first_match


def zone_risk_level() -> Column:
    return first_match(
        [
            (F.col("critical_count") > 0, "CRITICAL"),
            (F.col("warning_count") > 0, "WARNING"),
            (F.col("avg_risk_score") >= rules.ZONE_MEDIUM_RISK, "MEDIUM"),
        ],
        "LOW",
    )


def gov_risk_level() -> Column:
    critical, warning = F.col("critical_count"), F.col("warning_count")
    return first_match(
        [
            (critical >= rules.GOV_CRITICAL_AT, "CRITICAL"),
            ((critical == 1) | (warning >= rules.GOV_WARNING_AT), "WARNING"),
            (F.col("avg_risk_score") >= rules.GOV_MEDIUM_RISK, "MEDIUM"),
        ],
        "LOW",
    )


def severity_rank(status: str = "alert_status") -> Column:
    """Sort key of alert statuses: CRITICAL first."""
    return first_match([(F.col(status) == "CRITICAL", 0)], 1)


def map_severity(status: str = "alert_status") -> Column:
    return first_match([(F.col(status) == name, points) for name, points in rules.MAP_SEVERITY.items()], 0)


def risk_band(avg_risk: str = "avg_risk") -> Column:
    return first_match([(F.col(avg_risk) >= at, band) for at, band in rules.RISK_BANDS], "GREEN")


def methane_band(value: Column) -> Column:
    return first_match([(value >= at, band) for at, band in rules.METHANE_BANDS], "NORMAL")


def direction(newer: Column, older: Column, labels: tuple[str, str, str]) -> Column:
    """Label for rise, fall and no change between two values."""
    up, down, flat = labels
    return first_match([(newer > older, up), (newer < older, down)], flat)
