"""Streaming layers: equal to batch, restartable, and unchanged by a repeated micro-batch."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from samples import readings, values
from sensorlake.operators import gold
from sensorlake.plans import fixture
from sensorlake.plans.warehouse import Warehouse
from sensorlake.sources import messages
from sensorlake import schemas
from sensorlake.sources.layers import Lake, layer_counts, within
from sensorlake.streaming import layers


def _publish(df, path: str) -> None:
    messages.write_files(messages.to_messages(df), path)


def _run(spark, landing: str, lake: Lake, layer: str, writer) -> None:
    parsed = messages.parse(messages.file_stream(spark, landing))
    layers.start(parsed, layer, writer, lake, available_now=True).awaitTermination()


@pytest.fixture
def lake(tmp_path) -> Lake:
    return Lake(str(tmp_path / "lake"))


def test_layers_over_two_rounds(spark, tmp_path, lake):
    landing = str(tmp_path / "landing")
    first = readings(spark, {"timestamp": "2024-01-01 10:00:00"}, {"timestamp": "2024-01-01 10:30:00", "alert_status": "WARNING"}, {"timestamp": "bad"})
    late = readings(spark, {"event_id": "late", "timestamp": "2024-01-01 09:59:59", "alert_status": "CRITICAL"})
    for rows in (first, late):
        _publish(rows.withColumn("timestamp", F.coalesce("timestamp", F.lit("bad"))), landing)
        layers.catch_up(messages.parse(messages.file_stream(spark, landing)), lake, event_clock=True)
    layers.catch_up(messages.parse(messages.file_stream(spark, landing)), lake, event_clock=True)

    bronze = lake.read_bronze(spark)
    assert values(bronze, "event_id", "hour") == {"e0": 10, "e1": 10, "e2": None, "late": 9}
    assert values(bronze, "event_id", "ingest_batch") == {"e0": 0, "e1": 0, "e2": 0, "late": 1}
    assert set(values(lake.read_silver(spark), "event_id", "risk_level")) == {"e0", "e1", "late"}
    assert values(lake.read_gold(spark, "zone_stats"), "batch_id", "zone_risk_level") == {0: "WARNING", 1: "CRITICAL"}
    assert values(lake.read_gold(spark, "active_alerts"), "event_id", "batch_id") == {"e1": 0, "late": 1}
    counted = {(r.layer, r.batch_id): r.row_count for r in layer_counts(spark, lake).collect()}
    assert counted[("bronze", 0)] == 3 and counted[("silver", 0)] == 2 and counted[("gov_stats", 1)] == 1
    hour = within(bronze, datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 30))
    assert set(values(hour, "event_id", "hour")) == {"e0"}


@pytest.mark.parametrize("keep_batch", [True, False])
def test_a_repeated_micro_batch_changes_nothing(spark, lake, keep_batch):
    batch = readings(spark, *[{"alert_status": s, "zone": z} for s in ("WARNING", "NORMAL") for z in "AB"])
    parsed = batch.withColumns({
        "kafka_partition": F.lit(0), "kafka_offset": F.lit(0).cast("long"), "raw_value": F.lit(None).cast("string"),
    })
    writers = (layers.bronze_writer(lake), layers.silver_writer(lake), layers.gold_writer(lake, keep_batch=keep_batch))
    for _ in range(2):
        for write in writers:
            write(parsed, 5)
    counted = values(layer_counts(spark, lake), "layer", "row_count")
    assert counted == {"bronze": 4, "silver": 4, "zone_stats": 2, "gov_stats": 1, "active_alerts": 2}


def test_an_empty_micro_batch_writes_nothing(spark, lake, tmp_path):
    for write in (layers.bronze_writer(lake), layers.silver_writer(lake), layers.gold_writer(lake)):
        write(readings(spark, {}).where("false"), 0)
    assert not (tmp_path / "lake").exists()


def test_statistics_share_one_clock(spark, lake):
    layers.gold_writer(lake)(readings(spark, {"zone": "A"}, {"zone": "B"}), 0)
    times = {r.snapshot_time for t in ("zone_stats", "gov_stats") for r in lake.read_gold(spark, t).collect()}
    assert len(times) == 1


def test_statistics_from_cleaned_readings(spark, lake):
    rows = readings(spark, {"methane_ppm": -5.0}, {"methane_ppm": 1.0}, {"house_id": None, "methane_ppm": 99.0})
    layers.gold_writer(lake, from_silver=True)(rows, 0)
    assert lake.read_gold(spark, "zone_stats").first().avg_methane_ppm == 0.5


def test_streamed_statistics_equal_batch(spark, sf_dir, tmp_path, lake):
    landing = str(tmp_path / "landing")
    scored = fixture.readings(spark, sf_dir)
    _publish(scored, landing)
    _run(spark, landing, lake, "gold", layers.gold_writer(lake, event_clock=True))
    whole = scored.withColumn("event_time", F.date_trunc("second", "event_time"))
    expected = gold.gov_stats(gold.region_totals(whole, batch_id=0))

    def shown(df):
        columns = ("governorate", "total_houses", "critical_count", "warning_count", "total_anomalies", "max_risk_score", "gov_risk_level")
        return sorted(tuple(r) for r in df.select(*columns, F.round("avg_risk_score", 6), F.col("snapshot_time").cast("string")).collect())

    assert shown(lake.read_gold(spark, "gov_stats")) == shown(expected)


def test_house_order_along_files(spark, sf_dir, tmp_path):
    path = str(tmp_path / "ordered")
    messages.write_files(messages.to_messages(fixture.readings(spark, sf_dir)), path)
    rows = spark.read.parquet(path).select("key", "value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n"))
    times = rows.select("key", F.get_json_object("value", "$.timestamp").alias("t"), "file", "n").orderBy("file", "n").collect()
    last: dict[str, str] = {}
    for row in times:
        assert last.get(row.key, "") <= row.t
        last[row.key] = row.t


def test_consistency_of_consumers(spark, sf_dir):
    from sensorlake.operators import views
    from sensorlake.plans.warehouse import warehouse

    w = warehouse(spark, sf_dir)
    kpi = views.kpis(w.alerts, w.gov, w.total_houses()).first()
    feed = values(views.alert_feed(w.alerts).groupBy("alert_status").count(), "alert_status", "count")
    assert (feed.get("CRITICAL", 0), feed.get("WARNING", 0)) == (kpi.critical, kpi.warning)
    assert views.status_count(w.alerts, "CRITICAL").first().value == kpi.critical
    shares = views.threat_distribution(views.kpis(w.alerts, w.gov, w.total_houses()))
    assert shares.agg(F.sum("houses")).first()[0] == kpi.total_houses
    sent = w.readings.groupBy("batch_id").count()
    zone = w.zones.rows.groupBy("batch_id").agg(F.sum("total_readings").alias("n"))
    gov = w.gov.rows.groupBy("batch_id").agg(F.sum("total_houses").alias("n"))
    assert values(sent, "batch_id", "count") == values(zone, "batch_id", "n") == values(gov, "batch_id", "n")


# --- a new checkpoint, a live run, pacing, narrow parsing, folding ---------------------------


def _sent(spark, landing, **change):
    _publish(readings(spark, {"timestamp": "2024-01-01 10:00:00", "alert_status": "WARNING", **change}), landing)


def _other_checkpoint(lake: Lake, name: str) -> Lake:
    class Moved(Lake):
        def checkpoint(self, layer: str) -> str:
            return f"{self.root}/{name}/{layer}"

    return Moved(lake.root)


def test_a_new_checkpoint_adds_to_the_lake(spark, tmp_path, lake):
    for n in range(2):
        landing = str(tmp_path / f"landing{n}")
        _sent(spark, landing, event_id=f"from{n}")
        own = _other_checkpoint(lake, f"checkpoints{n}")
        for _ in range(2):  # nothing new the second time
            layers.catch_up(messages.file_stream(spark, landing), own, event_clock=True)
    assert values(lake.read_bronze(spark), "event_id", "ingest_batch") == {"from0": 0, "from1": 1}
    assert values(lake.read_silver(spark), "event_id", "ingest_batch") == {"from0": 0, "from1": 1}
    assert values(lake.read_gold(spark, "active_alerts"), "event_id", "batch_id") == {"from0": 0, "from1": 1}
    assert lake.read_gold(spark, "zone_stats").count() == lake.read_gold(spark, "gov_stats").count() == 2
    # A repeated micro-batch of either query keeps its number.
    known = spark.read.parquet(f"{lake.root}/queries/gold").collect()
    assert {lake.first_number(spark, "gold", r.query_id) for r in known} == {0, 1}


def test_run_after_catching_up_reads_on_until_one_query_stops(spark, tmp_path, lake):
    import threading
    import time

    landing = str(tmp_path / "landing")
    _sent(spark, landing, event_id="first")
    layers.catch_up(messages.file_stream(spark, landing), lake)
    ended: list[object] = []

    def live():
        try:
            layers.run(messages.file_stream(spark, landing), lake, intervals=dict.fromkeys(layers.TRIGGERS, "1 second"))
            ended.append("stopped")
        except Exception as error:  # shown by the assertion
            ended.append(error)

    thread = threading.Thread(target=live)
    thread.start()
    own = {layers._name(layer, lake) for layer in layers.TRIGGERS}
    _sent(spark, landing, event_id="second")
    deadline = time.time() + 120

    def arrived():
        tables = (lake.read_bronze(spark), lake.read_silver(spark), lake.read_gold(spark, "active_alerts"))
        return all({"first", "second"} <= set(values(t, "event_id", "event_id")) for t in tables)

    while time.time() < deadline and not ended and not arrived():
        time.sleep(1)
    assert not ended and arrived()
    running = [q for q in spark.streams.active if q.name in own]
    assert {q.name for q in running} == own
    running[0].stop()
    thread.join(60)
    assert ended == ["stopped"]
    assert not [q for q in spark.streams.active if q.name in own]


def test_an_error_in_one_layer_stops_the_others(spark, tmp_path, lake):
    landing = str(tmp_path / "landing")
    _sent(spark, landing)

    def broken(rows, table):
        raise ValueError("no such sink")

    with pytest.raises(Exception, match="no such sink"):
        layers.catch_up(messages.file_stream(spark, landing), lake, sink=broken)
    assert not [q for q in spark.streams.active if q.name.endswith(layers._name("", lake))]


def test_gold_can_go_to_another_sink(spark, tmp_path, lake):
    landing = str(tmp_path / "landing")
    _sent(spark, landing)
    got = {}
    layers.catch_up(messages.file_stream(spark, landing), lake, sink=lambda rows, table: got.update({table: rows.collect()}))
    assert {t: len(rows) for t, rows in got.items()} == {"zone_stats": 1, "gov_stats": 1, "active_alerts": 1}
    counted = {(r.layer, r.batch_id): r.row_count for r in layer_counts(spark, lake).collect()}
    assert counted == {(layer, 0): 1 for layer in ("bronze", "silver", "zone_stats", "gov_stats", "active_alerts")}


def test_a_backlog_is_read_whole_over_several_micro_batches(spark, tmp_path, lake):
    landing = str(tmp_path / "landing")
    for n in range(5):
        _sent(spark, landing, event_id=f"e{n}")
    layers.catch_up(messages.file_stream(spark, landing, max_files_per_trigger=2), lake)
    bronze = lake.read_bronze(spark)
    assert sorted(values(bronze, "event_id", "event_id")) == [f"e{n}" for n in range(5)]
    assert bronze.select("ingest_batch").distinct().count() >= 3
    options = messages.kafka_source_options("b", **messages._paced("maxOffsetsPerTrigger", 7))
    assert options["maxOffsetsPerTrigger"] == "7"


@pytest.mark.parametrize("layer", ["gold", "silver"])
def test_a_layer_parses_its_own_fields(spark, layer):
    sent = spark.createDataFrame([("H1", '{"event_id": "a", "timestamp": "2024-02-03 04:05:06", "co2_ppm": 3}')], "key string, value string")
    sent = sent.withColumns({"partition": F.lit(0), "offset": F.lit(0).cast("long")})
    parsed = messages.parse(sent, layers.FIELDS[layer])
    assert ("co2_ppm" in parsed.columns) == (layer == "silver")
    assert "raw_value" not in parsed.columns
    plan = parsed.select("event_id", "event_time")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert ("co2_ppm" in plan) == (layer == "silver")
    row = parsed.first()
    assert (row.event_id, str(row.event_time)) == ("a", "2024-02-03 04:05:06")


def _as_parsed(rows):
    return rows.withColumns({"kafka_partition": F.lit(0), "kafka_offset": F.lit(0).cast("long"), "raw_value": F.lit(None).cast("string")})


def _folders(lake, hour):
    from pathlib import Path

    return sorted(p.name for p in Path(lake.bronze).glob(f"year=2024/month=1/day=1/hour={hour}/part=*"))


def test_a_closed_hour_is_folded(spark, tmp_path, lake):
    from sensorlake.sources.layers import fold_hour

    write = layers.bronze_writer(lake)

    def batch(number, *times):
        return _as_parsed(readings(spark, *[{"event_id": f"{number}-{i}", "timestamp": t} for i, t in enumerate(times)])), number

    for n in range(4):
        write(*batch(n, "2024-01-01 10:10:00", "2024-01-01 11:10:00", "2024-01-01 12:10:00"))
    before = sorted(lake.read_bronze(spark).select("event_id", "hour", "ingest_batch").collect())
    assert [fold_hour(spark, lake, "bronze", datetime(2024, 1, 1, hour)) for hour in (10, 11)] == [3, 3]
    assert _folders(lake, 10) == _folders(lake, 11) == ["part=-1", "part=3"] and len(_folders(lake, 12)) == 4
    assert sorted(lake.read_bronze(spark).select("event_id", "hour", "ingest_batch").collect()) == before
    write(*batch(3, "2024-01-01 10:10:00", "2024-01-01 11:10:00", "2024-01-01 12:10:00"))  # repeated
    assert sorted(lake.read_bronze(spark).select("event_id", "hour", "ingest_batch").collect()) == before
    write(*batch(4, "2024-01-01 10:59:00"))  # late
    write(*batch(5, "2024-01-01 13:00:00"))
    assert lake.read_bronze(spark).count() == 14
    assert [fold_hour(spark, lake, "bronze", datetime(2024, 1, 1, hour)) for hour in (10, 11)] == [2, 1]
    assert _folders(lake, 10) == _folders(lake, 11) == ["part=-1"]
    assert lake.read_bronze(spark).count() == 14
    assert fold_hour(spark, lake, "bronze", datetime(2024, 1, 1, 10)) == 0
    assert fold_hour(spark, lake, "bronze", datetime(2030, 1, 1, 10)) == 0


def test_an_interrupted_fold_is_made_good(spark, lake):
    from sensorlake.sources.layers import FOLDED, fold_hour, replace_partitions

    write = layers.bronze_writer(lake)
    for n in range(3):
        write(_as_parsed(readings(spark, {"event_id": f"e{n}", "timestamp": "2024-01-01 10:10:00"})), n)
    # As if it had ended between writing the hour and removing its old folders.
    half = lake.read_bronze(spark).where("part < 2").withColumn("part", F.lit(FOLDED)).cache()
    half.count()
    replace_partitions(schemas.conform(half, schemas.BRONZE), lake.bronze, schemas.LAYER_KEYS)
    assert lake.read_bronze(spark).count() == 5
    fold_hour(spark, lake, "bronze", datetime(2024, 1, 1, 10))
    assert sorted(r.event_id for r in lake.read_bronze(spark).collect()) == ["e0", "e1", "e2"]


# --- the cleaned layer after the raw one ------------------------------------------------------


def _cleaned(spark, lake):
    return sorted((r.event_id, r.ingest_batch) for r in lake.read_silver(spark).collect())


def test_a_chained_layer_reads_every_raw_micro_batch_once(spark, tmp_path, lake):
    from sensorlake.sources.layers import fold_hour

    landing = str(tmp_path / "landing")
    want = []
    for n in range(4):
        _sent(spark, landing, event_id=f"e{n}", timestamp=f"2024-01-01 1{n % 2}:00:00")
        layers.catch_up(messages.file_stream(spark, landing), lake, chained=True)
        want.append((f"e{n}", n))
        assert _cleaned(spark, lake) == want
        if n == 2:  # folded hours are not read again
            assert fold_hour(spark, lake, "bronze", datetime(2024, 1, 1, 10)) == 1
    counted = {r.batch_id: r.row_count for r in lake.snapshots(spark, "silver").collect()}
    assert counted == {n: 1 for n in range(4)}


def test_a_raw_micro_batch_that_is_written_again_changes_nothing(spark, tmp_path, lake):
    rows = _as_parsed(readings(spark, *[{"event_id": f"e{i}", "timestamp": f"2024-01-01 1{i % 3}:00:00"} for i in range(6)]))

    def read():
        layers.start(layers.bronze_stream(spark, lake), "silver", layers.chained_silver_writer(lake), lake, available_now=True).awaitTermination()
        return _cleaned(spark, lake)

    layers.bronze_writer(lake)(rows, 0)
    first = read()
    layers.bronze_writer(lake)(rows, 0)  # its files have other names now
    assert first == read() == [(f"e{i}", 0) for i in range(6)]


def test_both_ways_clean_alike(spark, tmp_path, lake):
    landing = str(tmp_path / "landing")
    _publish(readings(spark, {"temperature_c": 99.0}, {"house_id": None}, {"timestamp": "bad"}, {"aqi": None}), landing)
    other = Lake(f"{lake.root}-2")
    layers.catch_up(messages.file_stream(spark, landing), lake)
    layers.catch_up(messages.file_stream(spark, landing), other, chained=True)
    columns = [c for c in schemas.SILVER.names if c != "processed_at"]
    assert sorted(map(str, lake.read_silver(spark).select(*columns).collect())) == sorted(map(str, other.read_silver(spark).select(*columns).collect()))


# --- rejected rows ----------------------------------------------------------------------------


def test_rows_that_break_a_constraint_are_kept_with_the_reason(spark, lake):
    rows = _as_parsed(readings(
        spark, {"temperature_c": 99.0, "aqi": -1}, {"house_id": None}, {"timestamp": "bad", "methane_ppm": -3.0}, {"temperature_c": None}, {"temperature_c": 65.0},
    ))
    for _ in range(2):  # a repeated micro-batch changes nothing
        layers.silver_writer(lake, keep_rejected=True)(rows, 7)
    assert sorted(r.event_id for r in lake.read_silver(spark).collect()) == ["e0", "e3", "e4"]
    kept = {r.event_id: (r.reasons, r.dropped, r.table_name, r.batch_id) for r in lake.read_rejected(spark).collect()}
    assert kept == {
        "e0": ("temperature_c: not in -10 to 65; aqi: not in 0 to 500", False, "silver", 7),
        "e1": ("house_id: missing", True, "silver", 7),
        "e2": ("event_time: missing; methane_ppm: below 0", True, "silver", 7),
    }
    assert '"temperature_c":99.0' in lake.read_rejected(spark).where("event_id = 'e0'").first().content


def test_a_sound_micro_batch_keeps_nothing_aside(spark, lake):
    from pathlib import Path

    layers.silver_writer(lake, keep_rejected=True)(_as_parsed(readings(spark, {})), 0)
    layers.gold_writer(lake)(readings(spark, {"alert_status": "WARNING"}), 0)
    assert not Path(lake.rejected).exists()


def test_texts_that_a_table_cannot_hold_stay_out_of_it(spark, lake):
    rows = readings(spark, {"alert_status": "WARNING", "house_id": "H" * 11}, {"alert_status": "WARNING"}, {"zone": "z" * 101})
    layers.gold_writer(lake)(rows, 0)
    assert [r.event_id for r in lake.read_gold(spark, "active_alerts").collect()] == ["e1"]
    assert [r.zone for r in lake.read_gold(spark, "zone_stats").collect()] == ["Maadi"]
    kept = {(r.table_name, r.reasons) for r in lake.read_rejected(spark).collect()}
    assert kept == {("active_alerts", "house_id: longer than 10"), ("zone_stats", "zone: longer than 100")}
    counted = values(lake.snapshots(spark, "gold"), "table_name", "row_count")
    assert counted == {"zone_stats": 1, "gov_stats": 1, "active_alerts": 1}


# --- a sink that takes a batch once ----------------------------------------------------------


class Recorder:
    """A store with staging tables and a mark per batch; ``fails`` is the step after which it breaks down once."""

    def __init__(self, fails=None):
        self.staged, self.applied, self.marks, self.fails = {}, [], set(), fails

    def _step(self, name):
        if self.fails == name:
            self.fails = None
            raise ConnectionError(name)

    def committed(self, batch_id):
        return batch_id in self.marks

    def stage(self, rows, table, batch_id):
        self.staged[table] = [(table, batch_id, r.batch_id) for r in rows.collect()]
        self._step(f"stage {table}")

    def commit(self, batch_id):
        self._step("commit")
        assert batch_id not in self.marks
        self.marks.add(batch_id)
        self.applied += [row for rows in self.staged.values() for row in rows]
        self._step("after")


@pytest.mark.parametrize("fails", [None, "stage gov_stats", "commit", "after"])
def test_a_repeated_batch_is_applied_once(spark, tmp_path, lake, fails):
    landing = str(tmp_path / "landing")
    sink = Recorder(fails)
    for n in range(2):
        _sent(spark, landing, event_id=f"e{n}")
        for _ in range(2):
            try:
                layers.catch_up(messages.file_stream(spark, landing), lake, sink=sink)
            except Exception as error:  # noqa: BLE001
                assert fails in str(error)
    tables = ("zone_stats", "gov_stats", "active_alerts")
    assert sorted(sink.applied) == sorted((table, n, n) for n in range(2) for table in tables)
    assert sink.marks == {0, 1}


def test_a_whole_history_is_no_batch_of_a_staged_sink(spark, lake):
    with pytest.raises(ValueError, match="one batch"):
        layers.write_statistics(readings(spark, {}), lake, None, None, Recorder())


def test_staged_tables_move_in_one_transaction(spark):
    from sensorlake.sources import jdbc

    ran = []
    columns = {"zone_stats": ["zone", "batch_id"], "gov_stats": ["governorate", "batch_id"]}
    sink = jdbc.StagedTables(spark, "jdbc:x", columns, prefix="gold.", run=lambda statements: ran.append(list(statements)) or [])
    assert sink.committed(4) is False
    sink.commit(4)
    assert ran == [
        ["SELECT batch_id FROM gold.applied_batches WHERE batch_id = 4"],
        [
            "INSERT INTO gold.applied_batches (batch_id) VALUES (4)",
            "INSERT INTO gold.zone_stats (zone, batch_id) SELECT zone, batch_id FROM gold.zone_stats_staged",
            "INSERT INTO gold.gov_stats (governorate, batch_id) SELECT governorate, batch_id FROM gold.gov_stats_staged",
        ],
    ]


# --- numbers ----------------------------------------------------------------------------------


def test_a_micro_batch_that_was_not_listed_keeps_its_number(spark, tmp_path, lake):
    from sensorlake.sources.layers import replace_partitions, with_time_parts

    layers.bronze_writer(lake)(_as_parsed(readings(spark, {"event_id": "a"})), 0)
    rows = with_time_parts(_as_parsed(readings(spark, {"event_id": "b"}))).withColumns({
        "ingest_batch": F.lit(1), "part": F.lit(1), "ingested_at": F.current_timestamp(),
    })
    replace_partitions(schemas.conform(rows, schemas.BRONZE), lake.bronze, schemas.LAYER_KEYS)  # and then it broke down
    assert lake.first_number(spark, "bronze", "another query") == 2
    assert lake.first_number(spark, "bronze", "another query") == 2


def test_hours_and_times_are_utc_in_every_session_zone(spark, lake):
    from datetime import timedelta, timezone

    sent = spark.createDataFrame([("H", '{"event_id": "e", "house_id": "H", "timestamp": "2024-01-01 10:30:00"}')], "key string, value string")
    sent = sent.withColumns({"partition": F.lit(0), "offset": F.lit(0).cast("long")})
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
        layers.bronze_writer(lake)(messages.parse(sent), 0)
        assert lake.read_bronze(spark).first().hour == 10
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        bronze = lake.read_bronze(spark)
        east = timezone(timedelta(hours=3))
        found = within(bronze, datetime(2024, 1, 1, 13, tzinfo=east), datetime(2024, 1, 1, 14, tzinfo=east))
        assert [r.event_id for r in found.collect()] == ["e"]
        assert "PartitionFilters: [isnotnull(" in found._jdf.queryExecution().executedPlan().toString()
        assert [r.event_id for r in within(bronze, datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11)).collect()] == ["e"]
        assert within(bronze, datetime(2024, 1, 1, 11), datetime(2024, 1, 1, 12)).count() == 0
        back = messages.to_messages(bronze.drop("timestamp")).select(F.get_json_object("value", "$.timestamp")).first()[0]
        assert back == "2024-01-01 10:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_messages_are_published_once_per_session(spark, tmp_path):
    from pathlib import Path

    from sensorlake.plans import queries
    from sensorlake.plans.warehouse import release, warehouse

    w = warehouse(spark, "/root/testdata/sf0.001/")
    w.__dict__.pop("published", None)
    made = len(w.folders)
    first, second = (queries.queries()["publish_roundtrip"](spark, "/root/testdata/sf0.001").count() for _ in range(2))
    assert first == second > 0
    assert len(w.folders) == made + 1
    folders = [Path(f.removeprefix("file:")) for f in w.folders]
    assert all(f.exists() for f in folders)
    release(spark)
    assert not any(f.exists() for f in folders)


def test_messages_are_spread_over_files(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.where("ts < '2024-01-06'").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("customer", "nation"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(least, "1k")
    try:
        landing = f"{Warehouse(spark, str(tmp_path)).streamed.root}/landing"
    finally:
        spark.conf.unset(least)
    sent = spark.read.parquet(landing)
    rows = [row["count"] for row in sent.groupBy(F.input_file_name()).count().collect()]
    expected = fixture.payload(fixture.readings(spark, sf_dir, (0, 5))).select("key", "value")
    assert sent.count() == sum(rows) and not sent.exceptAll(expected).count() and not expected.exceptAll(sent).count()
    assert len(rows) >= 4 and max(rows) < sum(rows) / 2


def test_a_paced_micro_batch_reads_its_own_messages_only(spark, tmp_path, lake):
    path = str(tmp_path / "sent")
    rows = [(n, "H1", f'{{"event_id": "e{n}", "house_id": "H1", "timestamp": "2024-02-03 04:05:06"}}') for n in (0, 1, 2, 2, 3, 8, None)]
    stored = spark.createDataFrame(rows, "number long, key string, value string")
    messages.write_paced(stored, path, "number", 2)
    source = messages.paced_stream(spark, path)
    plan = source.sent(spark.range(1).select(F.lit(1).alias("tick")))._jdf.queryExecution().executedPlan().toString()
    assert "tick#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert not any(operator in plan for operator in ("Join", "Exchange"))

    def done() -> bool:
        return all(lake.heads(spark, layer).where("last_batch >= 4").count() for layer in ("bronze", "silver", "gold"))

    every = dict.fromkeys(layers.TRIGGERS, "100 milliseconds")
    layers.run(source, lake, event_clock=True, intervals=every, until=done)
    counted = {r.batch_id: r.row_count for r in layer_counts(spark, lake).where("layer = 'bronze'").collect()}
    assert counted == {0: 2, 1: 3, 4: 1}
    assert lake.read_silver(spark).count() == 6 and not lake.read_bronze(spark).where("event_id IS NULL").count()
