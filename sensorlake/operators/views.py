"""Serving views over the statistics tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake import rules
from sensorlake.functions.conditional import first_match
from sensorlake.functions.display import as_decimal, percent, rounded, short_number
from sensorlake.functions.levels import map_severity, risk_band, severity_rank
from sensorlake.operators.snapshot import current_counts, firsts, house_counts, latest, newest_batch, with_previous
from sensorlake.sources.layers import GoldTable, Statistics, rows_of

Houses = int | Column


def _houses(total: Houses) -> Column:
    return F.lit(total) if isinstance(total, int) else total


# --- single numbers -------------------------------------------------------------------------


def kpis(alerts: Statistics, gov: Statistics, total_houses: Houses = rules.MONITORED_HOUSES, batch_id: int | None = None) -> DataFrame:
    """One row: newest alert batch, houses per state, mean of the governorates' mean risk."""
    counts = current_counts(alerts, batch_id)
    mean_risk = latest(gov, batch_id).agg(F.avg("avg_risk_score")).scalar()
    batch = newest_batch(alerts) if batch_id is None else F.lit(batch_id)
    return counts.select(
        batch.cast("bigint").alias("batch_id"),
        "critical",
        "warning",
        rounded(mean_risk).alias("avg_risk"),
        _houses(total_houses).cast("bigint").alias("total_houses"),
    )


def status_count(alerts: Statistics, status: str) -> DataFrame:
    """Houses whose worst current alert has the given status."""
    return current_counts(alerts).select(F.col(status.lower()).alias("value"))


def average_risk(gov: Statistics) -> DataFrame:
    return latest(gov).agg(as_decimal(F.avg("avg_risk_score"), 5, 1).alias("value"))


def threat_distribution(kpi: DataFrame) -> DataFrame:
    """Houses per state with their share, normal being the rest of the fleet."""
    at_risk = F.col("critical") + F.col("warning")
    normal = F.greatest(F.col("total_houses") - at_risk, F.lit(0))
    states = [("Normal", normal), ("Warning", F.col("warning")), ("Critical", F.col("critical"))]
    return kpi.select(
        F.inline(F.array(*[F.struct(F.lit(name).alias("state"), houses.alias("houses")) for name, houses in states])),
        percent(at_risk, F.col("total_houses")).alias("at_risk_pct"),
        "total_houses",
    ).select("state", "houses", percent(F.col("houses"), F.col("total_houses")).alias("share_pct"), "at_risk_pct")


def kpi_history(alerts: Statistics, gov: Statistics) -> DataFrame:
    """Houses per state for every batch, with the change against the batch before.

    Batches come from the governorate statistics, so a batch without alerts counts 0. For a stored
    table they were counted when each batch was published, and the list of snapshots has them.
    """
    if isinstance(gov, GoldTable):
        counted = gov.snapshots().select("batch_id", "critical", "warning")
    else:
        batches = gov.select("batch_id").distinct()
        counts = house_counts(rows_of(alerts), ["batch_id"]).withColumnRenamed("batch_id", "counted_batch")
        counted = batches.join(counts, F.col("batch_id").eqNullSafe(F.col("counted_batch")), "left")
    counted = counted.fillna(0, ["critical", "warning"])
    return with_previous(counted, "batch_id", ["critical", "warning"]).select(
        "batch_id",
        "critical",
        "warning",
        (F.col("critical") - F.col("previous_critical")).alias("critical_delta"),
        (F.col("warning") - F.col("previous_warning")).alias("warning_delta"),
    )


# --- governorates ---------------------------------------------------------------------------


def governorate_risk(gov: Statistics, batch_id: int | None = None, *more: Column) -> DataFrame:
    """Risk and counts of each governorate in a snapshot, unrounded and unordered; ``more`` are further aggregates.

    The level is a string maximum; a snapshot holds one row per governorate, so it is that row's.
    """
    return (
        latest(gov, batch_id)
        .groupBy("governorate")
        .agg(
            F.avg("avg_risk_score").alias("avg_risk"),
            F.max("max_risk_score").alias("max_risk"),
            F.sum("critical_count").alias("critical_count"),
            F.sum("warning_count").alias("warning_count"),
            F.coalesce(F.max("gov_risk_level"), F.lit("LOW")).alias("risk_level"),
            *more,
        )
    )


def risk_by_governorate(gov: Statistics, batch_id: int | None = None) -> DataFrame:
    """Governorates by falling mean risk."""
    return governorate_risk(gov, batch_id).orderBy(F.desc("avg_risk"), "governorate")


def shown_risk(ranking: DataFrame) -> DataFrame:
    """Ranking with its risks as displayed."""
    shown = {name: rounded(F.col(name)) for name in ("avg_risk", "max_risk") if name in ranking.columns}
    return ranking.withColumns(shown)


def deduplicated_ranking(alerts: Statistics, gov: Statistics) -> DataFrame:
    """Governorate ranking whose counts are houses, each by its worst alert."""
    houses = (
        firsts(alerts, "first_of_house")
        .groupBy("governorate")
        .agg(
            F.count_if(F.col("alert_status") == "CRITICAL").alias("critical_count"),
            F.count_if(F.col("alert_status") == "WARNING").alias("warning_count"),
        )
    )
    risk = latest(gov).groupBy("governorate").agg(F.avg("avg_risk_score").alias("avg_risk"), F.max("gov_risk_level").alias("risk_level"))
    return (
        risk.join(houses, "governorate", "left")
        .fillna(0, ["critical_count", "warning_count"])
        .orderBy(F.desc("avg_risk"), "governorate")
    )


def risk_bands(gov: Statistics) -> DataFrame:
    return shown_risk(risk_by_governorate(gov)).select("governorate", "avg_risk", risk_band().alias("band"))


def top_governorate(gov: Statistics) -> DataFrame:
    return shown_risk(risk_by_governorate(gov).limit(1)).select("governorate", "avg_risk", "risk_level")


def insight_banner(kpi: DataFrame, gov: Statistics) -> DataFrame:
    """One line on the most urgent thing: critical houses, many warnings, or all calm."""
    top = top_governorate(gov).select(F.struct("governorate", "avg_risk")).scalar()
    elevated = shown_risk(governorate_risk(gov)).agg(F.count_if(F.col("avg_risk") >= rules.ELEVATED_RISK)).scalar()
    facts = kpi.withColumns({"top": top, "elevated": elevated}).select(
        "critical",
        "warning",
        short_number(F.col("avg_risk")).alias("mean_risk"),
        "elevated",
        F.coalesce("top.governorate", F.lit("—")).alias("top_governorate"),
        short_number(F.col("top.avg_risk")).alias("top_risk"),
    )
    plural = first_match([(F.col("elevated") == 1, "")], "s")
    critical, many = F.col("critical") > 0, F.col("warning") > rules.BANNER_WARNINGS
    texts = [
        F.format_string(rules.BANNER_CRITICAL, "critical", "top_governorate", "top_risk"),
        F.format_string(rules.BANNER_WARNING, F.col("warning"), F.col("elevated"), plural, F.col("top_governorate"), F.col("top_risk")),
        F.format_string(rules.BANNER_STABLE, "mean_risk", "top_governorate", "top_risk"),
    ]
    return facts.select(
        first_match([(critical, "CRITICAL"), (many, "WARNING")], "STABLE").alias("state"),
        first_match([(critical, texts[0]), (many, texts[1])], texts[2]).alias("line"),
        "elevated",
    )


# --- alerts ---------------------------------------------------------------------------------


def current_alerts(alerts: Statistics, batch_id: int | None = None) -> DataFrame:
    """One alert per house in the newest batch, with its root cause."""
    return firsts(alerts, "first_of_house", batch_id)


def _shown_sensors() -> list[Column]:
    return [
        rounded(F.col(column)).alias(name)
        for name, column in (("methane", "methane_ppm"), ("temp", "temperature_c"), ("smoke", "smoke_level"), ("co", "co_ppm"))
    ]


def alert_feed(alerts: Statistics) -> DataFrame:
    """Every current alert, most severe first."""
    return (
        current_alerts(alerts)
        .orderBy(severity_rank(), F.desc("risk_score"), "event_id")
        .select(
            "house_id", "governorate", "zone", "alert_status", "primary_trigger", "latitude", "longitude",
            rounded(F.col("risk_score")).alias("risk_score"),
            *_shown_sensors(),
        )
    )


def nested_feed(alerts: Statistics) -> DataFrame:
    """The feed as an application receives it, sensor values grouped in a struct."""
    return alert_feed(alerts).select(
        "house_id", "governorate", "zone", "alert_status", "risk_score", "primary_trigger", "latitude", "longitude",
        F.struct("methane", "temp", "smoke", "co").alias("sensors"),
    )


def map_markers(alerts: Statistics) -> DataFrame:
    """Current alerts that have a position; a house without one never hides another alert."""
    return firsts(alerts, "first_placed").select(
        "longitude", "latitude", "alert_status", "governorate", "zone", "house_id",
        rounded(F.col("risk_score")).alias("risk_score"),
        "primary_trigger",
        *_shown_sensors(),
    )


def nested_markers(alerts: Statistics) -> DataFrame:
    """Markers with ``coordinates`` as [longitude, latitude] and a sensor struct."""
    return map_markers(alerts).select(
        F.array("longitude", "latitude").alias("coordinates"),
        "risk_score", "alert_status", "governorate", "zone", "house_id", "primary_trigger",
        F.struct("methane", "temp", "smoke", "co").alias("sensors"),
    )


def map_points(alerts: Statistics) -> DataFrame:
    """Positions with a numeric severity for a heat map."""
    return firsts(alerts, "first_on_latitude").select(
        "latitude", "longitude", "risk_score", "alert_status", "governorate", "zone",
        map_severity().alias("severity_level"),
    )


def alerts_table(alerts: Statistics, rows: int = 20) -> DataFrame:
    """Most severe current alerts in fixed-point display form."""
    return (
        firsts(alerts, "first_of_house")
        .orderBy(severity_rank(), F.desc("risk_score"), "event_id")
        .limit(rows)
        .select(
            "house_id", "governorate", "zone", "alert_status",
            as_decimal(F.col("risk_score"), 5, 1).alias("risk_score"),
            as_decimal(F.col("methane_ppm"), 7, 1).alias("methane_ppm"),
            as_decimal(F.col("temperature_c"), 5, 1).alias("temperature_c"),
        )
    )


def top_incidents(alerts: Statistics, status: str, rows: int = 5, batch_id: int | None = None) -> DataFrame:
    """Highest-risk houses among the alerts of one status."""
    return (
        firsts(alerts, "first_of_status", batch_id)
        .where(F.col("alert_status") == status)
        .orderBy(F.desc("risk_score"), "event_id")
        .limit(rows)
        .select(
            "house_id", "governorate", "zone", "alert_status", "risk_score", "methane_ppm", "temperature_c", "smoke_level", "co_ppm", "event_id",
            F.col("primary_trigger").alias("cause"),
        )
    )


def drill_down(feed: DataFrame, governorate: str | Column | None) -> DataFrame:
    """Feed of one governorate with its number of events; everything if none is chosen.

    The rows of a governorate are counted in one pass and put in the feed's order again.
    """
    if governorate is None:
        return feed.withColumn("events", feed.agg(F.count("*")).scalar())
    chosen = feed.where(F.col("governorate") == (F.lit(governorate) if isinstance(governorate, str) else governorate))
    counted = chosen.withColumn("events", F.count("*").over(W.partitionBy("governorate")))
    return counted.orderBy(severity_rank(), F.desc("risk_score"), "house_id")


def trigger_sensors(feed: DataFrame) -> DataFrame:
    """The sensor that explains each alert, its value, and the state it is highlighted in."""
    sensor = first_match([(F.col("primary_trigger") == cause, name) for cause, name in rules.CAUSE_SENSOR.items()])
    value = {"methane": "methane", "temperature": "temp", "smoke": "smoke", "co": "co"}
    return feed.withColumn("trigger_sensor", sensor).select(
        "house_id",
        "primary_trigger",
        "trigger_sensor",
        first_match([(F.col("trigger_sensor") == name, F.col(column)) for name, column in value.items()]).alias("trigger_value"),
        F.when(F.col("trigger_sensor").isNotNull(), F.col("alert_status")).alias("highlight"),
    )
