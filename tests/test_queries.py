"""Every registered query against its SQL counterpart, and the shape of its plan."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point
import compare
from sensorlake.plans import oracles, queries

QUERIES = queries.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLES.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, duck, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = compare.sql_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


def _plan(spark, sf_dir, name: str) -> str:
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_plan_stays_distributed_and_in_the_jvm(spark, sf_dir, name):
    plan = _plan(spark, sf_dir, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in plan


def test_one_alert_per_house_is_limited_before_the_shuffle(spark, sf_dir):
    assert re.search(r"WindowGroupLimit .*Partial", _plan(spark, sf_dir, "dedup_alerts"))
    assert re.search(r"WindowGroupLimit .*Partial", _plan(spark, sf_dir, "active_anomalies_top5"))


def test_newest_batch_prunes_partitions(spark, sf_dir):
    assert re.search(r"PartitionFilters: \[.*batch_id.*[Ss]ubquery", _plan(spark, sf_dir, "latest_snapshot"))


def test_time_range_prunes_partitions_and_reaches_parquet(spark, sf_dir):
    plan = _plan(spark, sf_dir, "partition_pruned_scan")
    assert re.search(r"PartitionFilters: \[.*year", plan)
    assert "GreaterThanOrEqual(event_time" in plan
    assert "humidity_pct" not in plan


SERVING = (
    "latest_snapshot", "gold_sql_scan", "kpis", "avg_risk_decimal", "risk_by_gov", "gov_ranking_dedup", "top_governorate",
    "map_markers", "map_severity", "alert_feed", "alerts_by_selected_gov", "alerts_table_top20", "top5_critical", "trigger_sensor",
    "methane_trend", "methane_direction", "insight_banner", "live_snapshot", "snapshot_at_batch",
)


@pytest.mark.parametrize("name", SERVING)
def test_serving_opens_the_statistics_of_chosen_batches_only(spark, sf_dir, name):
    # The other scans are those of the table of snapshots and of the houses, of which only the number is used.
    scans = [line for line in _plan(spark, sf_dir, name).splitlines() if re.search(r"FileScan parquet \[[^]]", line) and "table_name#" not in line]
    assert scans
    assert all(re.search(r"PartitionFilters: \[[^\]]*batch_id", line) for line in scans)


@pytest.mark.parametrize("name", ["count_critical", "count_warning", "kpi_delta", "threat_distribution"])
def test_counts_of_houses_come_from_the_list_of_snapshots(spark, sf_dir, name):
    scans = [line for line in _plan(spark, sf_dir, name).splitlines() if re.search(r"FileScan parquet \[[^]]", line)]
    assert scans and all("table_name#" in line for line in scans)


def test_trend_bound_reaches_parquet_whole(spark, sf_dir):
    assert "GreaterThanOrEqual(snapshot_time,ScalarSubquery" in _plan(spark, sf_dir, "methane_trend")


def test_json_is_read_once_per_event(spark, sf_dir):
    assert _plan(spark, sf_dir, "active_alerts").count("get_json_object") == 1


def test_entry(spark):
    assert entry_point.entry(spark).count() == 1
