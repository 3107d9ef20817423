"""The live snapshot as ordered lines of text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake import rules
from sensorlake.functions.conditional import first_match
from sensorlake.functions.display import rounded
from sensorlake.functions.levels import direction
from sensorlake.operators import trends, views
from sensorlake.operators.snapshot import current_counts, firsts
from sensorlake.sources.layers import Statistics

_LINES = ("section_no", "line_no", "line")


def _summary() -> list[Column]:
    return [
        F.lit(rules.REPORT_TITLE),
        F.format_string(rules.REPORT_HOUSES, "total_houses"),
        F.format_string(rules.REPORT_CRITICAL, "houses.critical"),
        F.format_string(rules.REPORT_WARNING, "houses.warning"),
        F.format_string(rules.REPORT_RISK, rounded(F.col("mean_risk"))),
        F.format_string(rules.REPORT_NORMAL, F.col("total_houses") - F.col("houses.critical") - F.col("houses.warning")),
    ]


def _governorate(row: Column) -> Column:
    return F.format_string(
        rules.REPORT_GOVERNORATE,
        F.coalesce(row["governorate"], F.lit("None")),
        rounded(row["avg_risk"]),
        row["critical_count"],
        row["warning_count"],
        row["risk_level"],
    )


def _overview(alerts: Statistics, gov: Statistics, total_houses: Column, batch_id: int | None) -> DataFrame:
    """The summary and the ranking, from one look at the governorates, of which there are a few dozen."""
    risk = F.col("avg_risk_score")
    each = views.governorate_risk(gov, batch_id, F.sum(risk).alias("risk_sum"), F.count(risk).alias("risk_count"))
    # Falling risk, unknown last, then by name.
    ranked = F.struct(F.col("avg_risk").isNull(), -F.col("avg_risk"), "governorate", "avg_risk", "critical_count", "warning_count", "risk_level")
    whole = each.agg(F.array_sort(F.collect_list(ranked)).alias("ranking"), F.try_divide(F.sum("risk_sum"), F.sum("risk_count")).alias("mean_risk"))
    houses = current_counts(alerts, batch_id).select(F.struct("critical", "warning")).scalar()
    facts = whole.withColumns({"houses": houses, "total_houses": total_houses.cast("bigint")})
    governorates = F.transform("ranking", _governorate)
    ranking = F.when(F.size("ranking") > 0, F.concat(F.array(F.lit(rules.REPORT_RANKING)), governorates)).otherwise(F.array().cast("array<string>"))

    def numbered(section: int, lines: Column) -> Column:
        return F.transform(lines, lambda line, n: F.struct(F.lit(section).alias("section_no"), n.cast("int").alias("line_no"), line.alias("line")))

    return facts.select(F.inline(F.concat(numbered(1, F.array(*_summary())), numbered(4, ranking))))


def _incidents(alerts: Statistics, batch_id: int | None, rows: int = 5) -> DataFrame:
    """The worst incidents of either status under its title, from one look at the houses.

    Spark limits each task to ``rows`` of a status before the shuffle.
    """
    place = F.row_number().over(W.partitionBy("alert_status").orderBy(F.desc("risk_score"), F.asc("event_id")))
    sections = {"CRITICAL": (2, rules.REPORT_TOP_CRITICAL), "WARNING": (3, rules.REPORT_TOP_WARNING)}
    worst = firsts(alerts, "first_of_status", batch_id).where(F.col("alert_status").isin(*sections)).withColumn("line_no", place).where(F.col("line_no") <= rows)
    measured = [rounded(F.col(c)) for c in ("risk_score", "methane_ppm", "temperature_c", "smoke_level", "co_ppm")]
    named = [F.coalesce(c, F.lit("None")) for c in ("alert_status", "house_id", "governorate", "zone")]
    line = F.format_string(rules.REPORT_INCIDENT, *named, *measured, F.col("primary_trigger"))
    number, title = (first_match([(F.col("alert_status") == s, F.lit(v[i])) for s, v in sections.items()]) for i in (0, 1))
    own = F.struct(number.alias("section_no"), F.col("line_no").alias("line_no"), line.alias("line"))
    first = F.struct(number.alias("section_no"), F.lit(0).alias("line_no"), title.alias("line"))
    return worst.select(F.inline(F.when(F.col("line_no") == 1, F.array(first, own)).otherwise(F.array(own))))


def _trend(points: DataFrame) -> DataFrame:
    """Values newest first and their direction; ``points`` is limited to a handful."""
    shown = points.select("snapshot_time", rounded(F.col("value"), 2).alias("value"))
    newest_first = F.reverse(F.array_sort(F.collect_list(F.struct("snapshot_time", "value"))))
    known = shown.agg(newest_first.alias("points")).where(F.size("points") > 0)
    newest, oldest = (F.element_at("points", place)["value"] for place in (1, -1))
    texts = F.transform("points", lambda point: point["value"].cast("string"))
    line = F.format_string(
        rules.REPORT_TREND_VALUES, F.array_join(texts, ", "), direction(newest, oldest, trends.LONG_LABELS)
    )
    return known.select(F.posexplode(F.array(F.lit(rules.REPORT_TREND), line)).alias("line_no", "line"))


def live_snapshot(
    alerts: Statistics,
    gov: Statistics,
    zones: Statistics,
    total_houses: views.Houses = rules.MONITORED_HOUSES,
    batch_id: int | None = None,
    horizon: str = "1 minute",
) -> DataFrame:
    """Report lines ordered by (section_no, line_no); ``batch_id`` goes back to a past snapshot.

    Each statistics table is read once, and no section holds more than a few dozen rows.
    """
    houses = F.lit(total_houses) if isinstance(total_houses, int) else total_houses
    trend = _trend(trends.recent(zones, horizon, 5)).select(F.lit(5).alias("section_no"), F.col("line_no").cast("int").alias("line_no"), "line")
    sections = [_overview(alerts, gov, houses, batch_id), _incidents(alerts, batch_id), trend]
    return reduce(DataFrame.unionByName, sections).orderBy("section_no", "line_no").select(*_LINES)
