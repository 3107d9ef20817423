"""Time the headline queries and print one JSON line.

Two one-off steps are timed as they run: writing the statistics history that serving queries
read, and bringing all streaming layers up to date over every reading. Each query is then
built and executed three times; its time is the middle one.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from sensorlake.plans.queries import queries
from sensorlake.plans.warehouse import release, warehouse

HEADLINE = (
    "score_alert_status", "score_risk", "active_alerts", "silver_features", "zone_stats", "gov_stats", "batch_summary",
    "fleet_profile", "active_anomalies_top5", "geo_clamp", "parse_readings", "publish_roundtrip", "bronze_partitions", "dedup_alerts", "kpis", "risk_by_gov",
    "gov_ranking_dedup", "map_markers", "alert_feed", "alerts_table_top20", "top5_critical", "methane_trend", "kpi_delta",
    "threat_distribution", "insight_banner", "live_snapshot", "partition_pruned_scan", "layer_counts",
)
RUNS = 3


def _seconds(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sensorlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    w = warehouse(spark, sf_dir)
    times = {"build_history": _seconds(lambda: w.history), "stream_all_layers": _seconds(lambda: w.streamed)}
    registered = queries()
    for name in HEADLINE:
        run = registered[name]
        times[name] = statistics.median(
            _seconds(lambda: run(spark, sf_dir).write.format("noop").mode("overwrite").save()) for _ in range(RUNS)
        )
    shown = {name: round(seconds, 3) for name, seconds in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": shown, "sf": sf}))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
