"""The list of snapshots: what it opens, what it carries, and views over a stored history against the same views over its rows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from samples import readings, values
from sensorlake.operators import report, snapshot, trends, views
from sensorlake.sources.layers import Lake, _folders
from sensorlake.streaming import layers

FIRST = date(2024, 3, 1)


@pytest.fixture
def lake(tmp_path) -> Lake:
    return Lake(str(tmp_path / "lake"))


def _published(spark, lake, batch, day, rows=1, hour=12, tables=("zone_stats", "active_alerts")):
    time = datetime(day.year, day.month, day.day, hour, tzinfo=timezone.utc)
    listed = spark.createDataFrame(
        [(t, batch, rows if t == "zone_stats" else rows % 2, batch * 10, batch) for t in tables], "table_name string, batch_id long, row_count long, critical long, warning long"
    )
    lake.publish(spark, "gold", listed.withColumn("snapshot_time", F.lit(time.isoformat()).cast("timestamp")), today=day)


@pytest.fixture(scope="module")
def month(spark, tmp_path_factory) -> Lake:
    """60 batches over 30 days; every third day's last batch has no alerts."""
    lake = Lake(str(tmp_path_factory.mktemp("month") / "lake"))
    for batch in range(60):
        _published(spark, lake, batch, FIRST + timedelta(days=batch // 2), rows=2 if batch % 6 == 5 else 1, hour=batch % 2)
    return lake


def _opened(df) -> set[str]:
    return {f.split("/snapshots/gold/")[1].rsplit("/", 1)[0] for f in df.inputFiles() if "/snapshots/gold/" in f}


def test_the_newest_batch_takes_one_file(spark, month):
    table = month.gold_table(spark, "active_alerts")
    assert _opened(table.head) == {"published/listed_on=2024-03-30/listed_as=000000001"}
    row = table.head.agg(F.max("newest_batch"), F.max("newest_critical"), F.max("newest_time").cast("string")).first()
    assert tuple(row) == (58, 580, "2024-03-30 00:00:00")  # batch 59 has no alerts
    assert month.gold_table(spark, "zone_stats").head.first().newest_batch == 59
    assert snapshot.current_counts(table).first().asDict() == {"critical": 580, "warning": 58}
    assert snapshot.current_counts(table, 4).first().asDict() == {"critical": 40, "warning": 4}
    assert snapshot.current_counts(table, 99).first().asDict() == {"critical": 0, "warning": 0}


def test_a_past_day_is_one_file(spark, month):
    listed = month.gold_table(spark, "zone_stats").snapshots()
    days = {(FIRST + timedelta(days=n)).isoformat() for n in range(29)}
    assert _opened(listed) == {f"rolled/listed_on={d}" for d in days} | {f"published/listed_on=2024-03-30/listed_as=00000000{n}" for n in (0, 1)}
    assert len([f for f in listed.inputFiles() if "rolled" in f]) == 29
    assert sorted(r.batch_id for r in listed.collect()) == list(range(60))


def test_a_horizon_opens_the_days_that_can_hold_it(spark, month):
    since = F.lit("2024-03-28 00:30:00+00:00").cast("timestamp")
    listed = month.snapshots(spark, "gold", since)
    assert sorted({r.batch_id for r in listed.collect()}) == [55, 56, 57, 58, 59]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("PartitionFilters: [isnotnull(listed_on" in line for line in scans)


def test_days_never_run_backwards(spark, lake):
    """A clock that is set back, a snapshot of the future, and a table that is listed alone."""
    _published(spark, lake, 0, date(2024, 3, 5))
    _published(spark, lake, 1, date(2024, 3, 2))
    _published(spark, lake, 2, date(2024, 3, 9))
    time = F.lit("2031-01-01 00:00:00+00:00").cast("timestamp")
    ahead = spark.createDataFrame([("zone_stats", 3, 1)], "table_name string, batch_id long, row_count long").withColumn("snapshot_time", time)
    lake.publish(spark, "gold", ahead, today=date(2024, 3, 10))
    _published(spark, lake, 4, date(2024, 3, 11), rows=0)
    heads = {r.table_name: (r.newest_batch, r.last_batch) for r in lake.heads(spark, "gold").collect()}
    assert heads == {"zone_stats": (3, 4), "active_alerts": (2, 4)}
    assert sorted({r.batch_id for r in lake.snapshots(spark, "gold").collect()}) == [0, 1, 2, 3, 4]
    assert [r.batch_id for r in lake.snapshots(spark, "gold", time).collect()] == [3]


def test_an_unfinished_publication_is_not_seen(spark, lake, tmp_path):
    _published(spark, lake, 0, FIRST)
    (tmp_path / "lake/snapshots/gold/published" / f"listed_on={FIRST}" / "listed_as=000000001").mkdir()
    (tmp_path / "lake/snapshots/gold/published" / f"listed_on={FIRST + timedelta(days=1)}").mkdir()
    assert lake.gold_table(spark, "zone_stats").head.first().newest_batch == 0
    _published(spark, lake, 1, FIRST + timedelta(days=1))
    _published(spark, lake, 2, FIRST + timedelta(days=2))
    assert lake.gold_table(spark, "zone_stats").head.first().newest_batch == 2
    assert sorted({r.batch_id for r in lake.snapshots(spark, "gold").collect()}) == [0, 1, 2]


def test_nothing_is_listed_yet(spark, lake):
    assert lake.heads(spark, "gold").collect() == lake.snapshots(spark, "gold").collect() == []


def test_a_repeated_publication_changes_nothing(spark, lake):
    for _ in range(2):
        _published(spark, lake, 3, FIRST)
    assert lake.snapshots(spark, "gold").count() == 2
    assert {r.newest_batch for r in lake.heads(spark, "gold").collect()} == {3}


# --- the state of the houses ----------------------------------------------------------------


def _history(spark, seed: int, batches: int = 4, rows: int = 120):
    draw = random.Random(seed)
    changes = []
    for batch in range(batches):
        for i in range(rows):
            place = draw.choice([{}, {"latitude": None}, {"longitude": None}, {"latitude": None, "longitude": None}])
            changes.append({
                "event_id": f"{batch}-{i:03d}", "batch_id": batch, "house_id": draw.choice(["H0", f"H{draw.randrange(25)}", None]),
                "alert_status": draw.choice(["NORMAL", "WARNING", "CRITICAL"]), "risk_score": float(draw.randrange(8)),
                "methane_ppm": float(draw.randrange(120)), "governorate": draw.choice(["Cairo", "Giza", None]),
                "timestamp": f"2024-01-01 00:0{batch}:00", **place,
            })
    return readings(spark, *changes)


VIEWS = {
    "kpis": lambda a, g, z: views.kpis(a, g),
    "feed": lambda a, g, z: views.alert_feed(a),
    "markers": lambda a, g, z: views.map_markers(a),
    "points": lambda a, g, z: views.map_points(a),
    "table": lambda a, g, z: views.alerts_table(a),
    "critical": lambda a, g, z: views.top_incidents(a, "CRITICAL"),
    "warning": lambda a, g, z: views.top_incidents(a, "WARNING"),
    "past warning": lambda a, g, z: views.top_incidents(a, "WARNING", 3, 1),
    "ranking": lambda a, g, z: views.deduplicated_ranking(a, g),
    "history": lambda a, g, z: views.kpi_history(a, g),
    "trend": lambda a, g, z: trends.methane_trend(z, "2 minutes"),
    "report": lambda a, g, z: report.live_snapshot(a, g, z, 50, horizon="2 minutes"),
    "past report": lambda a, g, z: report.live_snapshot(a, g, z, 50, 1, "2 minutes"),
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("stored") / "lake"))
    layers.write_statistics(_history(spark, 1), lake, None, None)
    return [lake.gold_table(spark, t) for t in ("active_alerts", "gov_stats", "zone_stats")]


@pytest.mark.parametrize("name", VIEWS)
def test_a_view_is_the_same_from_the_kept_state_as_from_all_rows(stored, name):
    kept, computed = (VIEWS[name](*tables) for tables in (stored, [t.rows for t in stored]))
    assert kept.columns == computed.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, computed.collect()))


@pytest.mark.parametrize("name", [n for n in VIEWS if n not in ("trend",)])
def test_a_view_does_not_look_at_all_alerts(stored, name):
    plan = VIEWS[name](*stored)._jdf.queryExecution().executedPlan().toString()
    assert "/gold/active_alerts" not in plan


@pytest.mark.parametrize("name", ["report", "past report"])
def test_a_report_reads_each_table_once(stored, name):
    plan = VIEWS[name](*stored)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "/snapshots/" not in line]
    assert len(scans) == 3
    for table in ("house_alerts", "gov_stats", "zone_stats"):
        assert sum(f"/gold/{table}" in line for line in scans) == 1


def test_a_house_keeps_few_rows_however_many_alerts_it_has(spark):
    changes = [{"event_id": f"e{i}", "house_id": "hot", "alert_status": "WARNING", "risk_score": float(i % 90)} for i in range(3000)]
    alerts = readings(spark, *changes).repartition(8)
    state = snapshot.house_state(alerts)
    assert state.count() == 1
    assert "WindowGroupLimit" in state._jdf.queryExecution().executedPlan().toString()


def test_a_repeated_batch_leaves_the_state_as_it_was(spark, lake):
    rows = _history(spark, 2, batches=1)
    states = []
    for _ in range(2):
        layers.gold_writer(lake, event_clock=True)(rows, 9)
        states.append(sorted(map(str, lake.read_houses(spark).collect())))
    assert states[0] == states[1] and states[0]
    assert views.kpi_history(lake.gold_table(spark, "active_alerts"), lake.gold_table(spark, "gov_stats")).count() == 1


# --- folders of a span ----------------------------------------------------------------------


@pytest.mark.parametrize(
    ("start", "end", "want"),
    [
        (datetime(2024, 1, 1, 5, 30), datetime(2024, 1, 1, 6), ["year=2024/month=1/day=1/hour=5"]),
        (datetime(2024, 1, 1, 23), datetime(2024, 1, 3, 0, 0, 1), ["year=2024/month=1/day=1/hour=23", "year=2024/month=1/day=2", "year=2024/month=1/day=3/hour=0"]),
        (datetime(2023, 12, 31), datetime(2025, 2, 1), ["year=2023/month=12/day=31", "year=2024", "year=2025/month=1"]),
        (datetime(2024, 1, 1), datetime(2024, 1, 1), []),
    ],
)
def test_the_fewest_folders_of_a_span(start, end, want):
    assert _folders(start, end) == want


def test_other_hours_are_not_listed(spark, lake):
    times = ["2024-01-01 10:00:00", "2024-01-01 11:59:59", "2024-01-02 00:00:00", "2024-01-02 07:00:00", "2023-06-01 00:00:00", "bad"]
    rows = readings(spark, *[{"event_id": f"e{i}", "timestamp": t} for i, t in enumerate(times)])
    parsed = rows.withColumns({"kafka_partition": F.lit(0), "kafka_offset": F.lit(0).cast("long"), "raw_value": F.lit(None).cast("string")})
    layers.bronze_writer(lake)(parsed, 0)
    found = lake.hours(spark, "bronze", datetime(2024, 1, 1, 11), datetime(2024, 1, 2, 7))
    assert sorted(values(found, "event_id", "event_id")) == ["e1", "e2"]
    assert {f.split("/bronze/")[1].rsplit("/", 2)[0] for f in found.inputFiles()} == {"year=2024/month=1/day=1/hour=11", "year=2024/month=1/day=2/hour=0"}
    assert lake.hours(spark, "bronze", datetime(2022, 1, 1), datetime(2022, 1, 2)).collect() == []
