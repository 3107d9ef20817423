"""Snapshots, serving views, trends, report and fleet on small hand-made tables, against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from samples import readings, values
from sensorlake import rules, schemas
from sensorlake.operators import fleet, gold, report, snapshot, trends, views


def _alerts(spark, *rows: tuple):
    """(batch, house, status, risk[, changes])"""
    changes = [
        {"batch_id": b, "house_id": h, "alert_status": s, "risk_score": r, **(extra[0] if extra else {})} for b, h, s, r, *extra in rows
    ]
    return schemas.conform(gold.active_alerts(readings(spark, *changes)), schemas.ACTIVE_ALERTS)


def _gov(spark, *rows: tuple):
    """(batch, governorate, avg risk, critical, warning, level)"""
    frame = spark.createDataFrame(
        rows, "batch_id long, governorate string, avg_risk_score double, critical_count long, warning_count long, gov_risk_level string"
    )
    return frame.withColumn("max_risk_score", F.col("avg_risk_score"))


def _zones(spark, *rows: tuple):
    return spark.createDataFrame(rows, "time string, avg_methane_ppm double").select(
        F.to_timestamp("time").alias("snapshot_time"), "avg_methane_ppm"
    )


def test_critical_beats_higher_risk_and_ties_are_settled(spark):
    alerts = _alerts(spark, (1, "H1", "WARNING", 99.0), (1, "H1", "CRITICAL", 10.0), (1, "H1", "CRITICAL", 10.0), (1, "H2", "WARNING", 5.0))
    assert values(snapshot.one_per_house(alerts), "house_id", "event_id") == {"H1": "e1", "H2": "e3"}


def test_one_per_house_with_a_hot_house(spark):
    rng = random.Random(1)
    rows = [
        (1, "H0" if i % 3 == 0 else f"H{rng.randrange(40)}", rng.choice(["WARNING", "CRITICAL"]), float(rng.randrange(50)))
        for i in range(600)
    ]
    alerts = _alerts(spark, *rows).repartition(8)
    best: dict[str, tuple] = {}
    for i, (_, house, status, risk) in enumerate(rows):
        key = (status != "CRITICAL", -risk, f"e{i}")
        best[house] = min(best.get(house, key), key)
    assert values(snapshot.one_per_house(alerts), "house_id", "event_id") == {h: k[2] for h, k in best.items()}
    counts = snapshot.house_counts(alerts).first()
    assert (counts.critical, counts.warning) == (sum(not k[0] for k in best.values()), sum(k[0] for k in best.values()))


def test_each_table_has_its_own_newest_batch(spark):
    alerts = _alerts(spark, (3, "H1", "CRITICAL", 50.0), (4, "H1", "WARNING", 20.0), (4, "H2", "CRITICAL", 70.0))
    gov = _gov(spark, (4, "Cairo", 99.0, 1, 1, "WARNING"), (5, "Cairo", 10.0, 0, 0, "LOW"), (5, "Giza", 5.5, 0, 0, "LOW"))
    row = views.kpis(alerts, gov).first()
    assert (row.batch_id, row.critical, row.warning, row.avg_risk, row.total_houses) == (4, 1, 1, 7.8, 3000)
    past = views.kpis(alerts, gov, 10, batch_id=3).first()
    assert (past.batch_id, past.critical, past.warning, past.avg_risk, past.total_houses) == (3, 1, 0, 0.0, 10)


def test_empty_history_and_batch_zero(spark):
    alerts = _alerts(spark, (1, "H1", "WARNING", 1.0)).where("false")
    gov = _gov(spark, (0, "Cairo", 4.0, 0, 0, "LOW"))
    row = views.kpis(alerts, gov).first()
    assert (row.batch_id, row.critical, row.warning, row.avg_risk) == (None, 0, 0, 4.0)


def test_previous_crosses_spans_and_gaps(spark):
    batches = [0, 1, 3, 4, 5, 11, 12, 40, 41]
    rows = spark.createDataFrame([(b, b * 10) for b in batches], "batch_id long, n long").repartition(5)
    got = values(snapshot.with_previous(rows, "batch_id", ["n"], span=4), "batch_id", "previous_n")
    assert got == dict(zip(batches, [None, *[b * 10 for b in batches[:-1]]]))


def test_history_counts_batches_without_alerts(spark):
    alerts = _alerts(spark, (1, "H1", "CRITICAL", 1.0), (3, "H1", "WARNING", 1.0), (3, "H2", "WARNING", 1.0))
    gov = _gov(spark, *[(b, "Cairo", 1.0, 0, 0, "LOW") for b in (1, 2, 3)])
    got = [tuple(r) for r in views.kpi_history(alerts, gov).orderBy("batch_id").collect()]
    assert got == [(1, 1, 0, None, None), (2, 0, 0, -1, 0), (3, 0, 2, 0, 2)]


def test_ranking_variants(spark):
    alerts = _alerts(spark, (1, "H1", "WARNING", 1.0), (1, "H1", "CRITICAL", 1.0), (1, "H2", "WARNING", 1.0, {"governorate": "Giza"}))
    gov = _gov(spark, (1, "Cairo", 9.0, 1, 1, "WARNING"), (1, "Giza", 12.04, 0, 1, "MEDIUM"), (1, "Suez", 7.96, 0, 0, "LOW"))
    plain = views.risk_by_governorate(gov).collect()
    assert [(r.governorate, r.critical_count, r.warning_count) for r in plain] == [("Giza", 0, 1), ("Cairo", 1, 1), ("Suez", 0, 0)]
    unique = views.deduplicated_ranking(alerts, gov).collect()
    assert [(r.governorate, r.critical_count, r.warning_count) for r in unique] == [("Giza", 0, 1), ("Cairo", 1, 0), ("Suez", 0, 0)]
    assert values(views.risk_bands(gov), "governorate", "band") == {"Giza": "RED", "Cairo": "ORANGE", "Suez": "ORANGE"}
    assert views.top_governorate(gov).first().governorate == "Giza"


@pytest.mark.parametrize(
    ("critical", "warning", "state", "line"),
    [
        (1, 9, "CRITICAL", "CRITICAL: 1 nodes at risk. Highest cluster: Giza (avg risk 9.5). Immediate response required."),
        (0, 6, "WARNING", "WARNING: 6 nodes elevated. 1 governorate above threshold. Highest: Giza (avg risk 9.5)."),
        (0, 5, "STABLE", "STABLE: All 27 governorates within normal parameters. Avg risk 6/100. Highest: Giza (9.5)."),
    ],
)
def test_banner(spark, critical, warning, state, line):
    kpi = spark.createDataFrame([(critical, warning, 6.0)], "critical long, warning long, avg_risk double")
    gov = _gov(spark, (1, "Giza", 9.5, 0, 0, "LOW"), (1, "Suez", 2.5, 0, 0, "LOW"))
    row = views.insight_banner(kpi, gov).first()
    assert (row.state, row.line) == (state, line)


def test_threat_distribution_never_negative(spark):
    kpi = spark.createDataFrame([(30, 90, 100)], "critical long, warning long, total_houses long")
    got = values(views.threat_distribution(kpi), "state", "houses")
    assert got == {"Normal": 0, "Warning": 90, "Critical": 30}


def test_markers_need_a_position_and_feed_does_not(spark):
    nowhere = {"latitude": None, "longitude": None}
    alerts = _alerts(spark, (1, "H1", "CRITICAL", 9.0, nowhere), (1, "H1", "WARNING", 5.0), (1, "H2", "WARNING", 5.0, nowhere))
    assert values(views.map_markers(alerts), "house_id", "alert_status") == {"H1": "WARNING"}
    assert values(views.alert_feed(alerts), "house_id", "alert_status") == {"H1": "CRITICAL", "H2": "WARNING"}
    marker = views.nested_markers(alerts).first()
    assert marker.coordinates == [31.3, 30.0] and marker.sensors.methane == 2.0
    assert values(views.map_points(alerts), "risk_score", "severity_level") == {5.0: 50}


def test_drill_down(spark):
    feed = views.alert_feed(_alerts(spark, (1, "H1", "CRITICAL", 9.0), (1, "H2", "WARNING", 5.0, {"governorate": "Giza"})))
    assert [(r.house_id, r.events) for r in views.drill_down(feed, "Giza").collect()] == [("H2", 1)]
    assert {r.events for r in views.drill_down(feed, None).collect()} == {2}


def test_trigger_sensor(spark):
    feed = views.alert_feed(_alerts(
        spark, (1, "H1", "CRITICAL", 9.0, {"methane_ppm": 80.0}), (1, "H2", "WARNING", 9.0, {"aqi": 120}), (1, "H3", "WARNING", 9.0, {"smoke_level": 30.0}),
    ))
    got = {r.house_id: (r.trigger_sensor, r.trigger_value, r.highlight) for r in views.trigger_sensors(feed).collect()}
    assert got == {"H1": ("methane", 80.0, "CRITICAL"), "H2": (None, None, None), "H3": ("smoke", 30.0, "WARNING")}


def test_trend_window_limit_and_order(spark):
    zones = _zones(
        spark,
        *[(f"2024-01-01 00:0{m}:00", float(m)) for m in range(9)],
        *[(f"2024-01-01 00:0{m}:00", float(m + 2)) for m in range(9)],
    )
    trend = trends.methane_trend(zones).collect()
    assert [(r.clock, r.value) for r in trend] == [(f"00:0{m}:00", m + 1.0) for m in range(3, 9)]
    short = trends.methane_trend(zones, "1 hour", 2)
    assert [r.value for r in short.collect()] == [8.0, 9.0]
    fixed = trends.methane_trend(zones, "1 minute", as_of=F.lit("2024-01-01 00:09:00").cast("timestamp"))
    assert [r.value for r in fixed.collect()] == [9.0]


@pytest.mark.parametrize(("points", "long", "arrow"), [([1.0, 9.0, 5.0], "RISING", "↓"), ([9.0, 1.0, 5.0], "FALLING", "↑"), ([4.0, 4.0], "STABLE", "→"), ([160.0], "STABLE", "↑")])
def test_directions(spark, points, long, arrow):
    zones = _zones(spark, *[(f"2024-01-01 00:00:0{i}", v) for i, v in enumerate(points)])
    assert trends.long_direction(trends.recent(zones, limit=5)).first().direction == long
    assert trends.short_direction(trends.methane_trend(zones)).first().arrow == arrow


def test_implausible_trend_values(spark):
    zones = _zones(spark, ("2024-01-01 00:00:00", -1.0), ("2024-01-01 00:00:01", 2000.0), ("2024-01-01 00:00:02", 1999.99))
    assert [r.value for r in trends.plausible(trends.methane_trend(zones)).collect()] == [0.0, 0.0, 1999.99]


def test_report_lines(spark):
    alerts = _alerts(spark, *[(2, f"H{i}", "WARNING", float(i), {"temperature_c": 45.0}) for i in range(7)])
    gov = _gov(spark, (2, "Cairo", 8.25, 0, 7, "WARNING"))
    zones = _zones(spark, ("2024-01-01 00:00:00", 2.0), ("2024-01-01 00:00:30", 3.0))
    lines = [r.line for r in report.live_snapshot(alerts, gov, zones, 100).collect()]
    assert lines[:6] == [
        rules.REPORT_TITLE, "Total monitored houses : 100", "Critical threats       : 0", "Warning signals        : 7",
        "Average risk score     : 8.3 / 100", "Normal houses          : 93",
    ]
    assert lines[6] == rules.REPORT_TOP_WARNING and len(lines) == 6 + 6 + 2 + 2
    assert lines[7] == "  [WARNING] H6 | Cairo/Maadi | Risk=6.0 | CH4=2.0ppm | Temp=45.0C | Smoke=1.0 | CO=1.0ppm | Cause=HIGH_TEMP"
    assert lines[13] == "  Cairo: avg_risk=8.3 | critical=0 | warning=7 | level=WARNING"
    assert lines[15] == "  Values: [3.0, 2.0]  |  Direction: RISING"


def test_batch_summary_and_anomalies(spark):
    rows = readings(spark, *[{"house_id": f"H{9 - i}", "is_anomaly": 1, "alert_status": "CRITICAL" if i == 0 else "NORMAL"} for i in range(8)])
    row = fleet.batch_summary(rows).first()
    assert (row.sent, row.critical, row.normal, row.anomalies, row.critical_pct) == (8, 1, 7, 8, 12.5)
    assert values(fleet.active_anomalies(rows), "house_id", "place") == {f"H{house}": house - 1 for house in range(2, 7)}


def test_fleet_counts_a_changed_house_once(spark):
    rows = readings(
        spark, {"house_id": "H1"}, {"house_id": "H1"}, {"house_id": "H1", "risk_profile": "low"},
        {"house_id": "H2", "governorate": "Giza", "has_gas_connection": False, "risk_profile": "high"}, {"house_id": "H3", "zone": "Dokki"},
    )
    row = fleet.fleet_profile(fleet.houses(rows)).first()
    assert (row.houses, row.governorates, row.zones, row.with_gas, row.high_risk, row.with_gas_pct) == (3, 2, 2, 2, 1, 67.0)


def test_locate_defaults(spark):
    rows = readings(
        spark, {"latitude": 29.0, "longitude": 31.3}, {"latitude": None, "longitude": None}, {"latitude": None, "longitude": None, "zone": "Zamalek"},
        {"governorate": "Nowhere", "latitude": 1.0, "longitude": 2.0},
    )
    zones = spark.createDataFrame([("Cairo", "Zamalek", 30.0626, 31.2243)], "governorate string, zone string, zone_lat double, zone_lon double")
    got = {r.event_id: (r.clamped_lat, r.clamped_lon, r.outside_bounds) for r in fleet.locate(rows, fleet.governorates(spark), zones).collect()}
    assert got["e0"] == (29.7, 31.3, True)
    assert got["e1"] == (30.0444, 31.2357, False)
    assert got["e2"] == (30.0626, 31.2243, False)
    assert got["e3"] == (1.0, 2.0, False)
    assert fleet.governorates(spark).count() == rules.GOVERNORATE_COUNT


def test_zone_tiers(spark):
    rows = readings(spark, {"zone": "Shubra"}, {"zone": "Dokki"}, {"zone": "Zamalek"}, {"zone": None})
    assert values(fleet.zone_tier(rows), "event_id", "tier") == {"e0": "high", "e1": "medium", "e2": "low", "e3": "low"}


def test_a_row_without_a_number_stays_and_precedes_none(spark):
    rows = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "batch_id long, n int")
    got = values(snapshot.with_previous(rows, "batch_id", ["n"]), "batch_id", "previous_n")
    assert got == {None: None, 1: None, 2: 2}


def test_history_keeps_a_batch_without_a_number(spark):
    gov = _gov(spark, (None, "Cairo", 1.0, 0, 0, "LOW"), (1, "Cairo", 1.0, 0, 0, "LOW"))
    alerts = _alerts(spark, (1, "H1", "CRITICAL", 9.0))
    assert values(views.kpi_history(alerts, gov), "batch_id", "critical") == {None: 0, 1: 1}


def test_half_a_position_is_none(spark):
    rows = readings(spark, {"latitude": 29.9, "longitude": None, "zone": "Nasr City"}, {"latitude": 30.01, "longitude": 31.21, "zone": "Nasr City"})
    zones = spark.createDataFrame([("Cairo", "Nasr City", 30.05, 31.33)], "governorate string, zone string, zone_lat double, zone_lon double")
    got = fleet.locate(rows, fleet.governorates(spark), zones).collect()
    assert {(r.event_id, r.clamped_lat, r.clamped_lon) for r in got} == {("e0", 30.05, 31.33), ("e1", 30.01, 31.21)}
