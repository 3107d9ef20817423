"""Three queries over one stream: raw, cleaned and statistics layers.

Each query has its own source read and checkpoint; chained, the cleaned layer reads the files of the raw
one instead. ``foreachBatch`` may repeat a batch after a failure; every write replaces the partitions of
its own micro-batch, so a repeat leaves the tables as they were. A new checkpoint over an existing lake
continues its numbers, so that it adds to the lake.
"""

from __future__ import annotations

import hashlib
import logging
import time
from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlake import schemas
from sensorlake.operators import gold, rejects, silver, snapshot
from sensorlake.sources import messages
from sensorlake.sources.layers import Lake, replace_partitions, with_time_parts
from sensorlake.sources.snapshots import Listed

log = logging.getLogger(__name__)

# Trigger intervals per layer.
TRIGGERS = {"bronze": "10 seconds", "silver": "10 seconds", "gold": "30 seconds"}

# Fields each layer parses, all by default.
FIELDS = {"gold": tuple(c for c in gold.INPUTS if c in schemas.READING.names), "silver": tuple(schemas.READING.names)}

BatchWriter = Callable[[DataFrame, int], None]
#: Writes one statistics table of a micro-batch: its rows and its name.
GoldSink = Callable[[DataFrame, str], None]


class StagedSink(Protocol):
    """A sink that takes a batch whole or not at all, so that a repeated batch is applied once."""

    def committed(self, batch_id: int) -> bool:
        """Whether the batch is in the tables."""

    def stage(self, rows: DataFrame, table: str, batch_id: int) -> None:
        """Put a table's rows aside, in place of what an earlier attempt put there."""

    def commit(self, batch_id: int) -> None:
        """Move the staged rows of all tables into place and mark the batch, in one step."""


def _now() -> Column:
    """One clock reading per micro-batch, the same in every table it writes."""
    return F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")


def _micros() -> int:
    return time.time_ns() // 1000


class _Counter:
    """Counts of rows that Spark takes while it writes them, instead of a second pass."""

    def __init__(self, name: str, **counts: Column):
        self._seen, self._counts = Observation(name), counts

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *[count.alias(name) for name, count in self._counts.items()])

    def __getitem__(self, name: str) -> int:
        # Where Spark finds at run time that there are no rows, it drops the counts as well.
        return self._seen.get[name] if self._seen._jo.getRow().length() else 0


class _Numbers:
    """Numbers of a layer's micro-batches: as counted by the query, continued from earlier queries."""

    def __init__(self, lake: Lake, layer: str):
        self._lake, self._layer = lake, layer
        self._first: dict[str, int] = {}

    def __call__(self, batch: DataFrame, batch_id: int) -> int:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            return batch_id  # a writer called by hand
        if query not in self._first:
            self._first[query] = self._lake.first_number(spark, self._layer, query)
        return self._first[query] + batch_id


def _write_layer(rows: DataFrame, layer: str, lake: Lake, batch_id: int) -> None:
    path, schema = lake.layer(layer)
    counter = _Counter(f"{layer}-{batch_id}", rows=F.count("*"))
    stamped = with_time_parts(rows).withColumns({"ingest_batch": F.lit(batch_id), "part": F.lit(batch_id)})
    replace_partitions(counter.on(schemas.conform(stamped, schema)), path, schemas.LAYER_KEYS)
    log.info("%s batch %d: %d rows", layer, batch_id, counter["rows"])
    lake.publish(rows.sparkSession, layer, [Listed(layer, batch_id, _micros(), counter["rows"])])


def _keep_rejected(rows: DataFrame, constraints: Sequence[rejects.Constraint], table: str, lake: Lake, batch_id: int) -> None:
    found = rejects.rejected(rows, constraints, table, batch_id)
    replace_partitions(found, lake.rejected, ("table_name", "batch_id"))


def bronze_writer(lake: Lake) -> BatchWriter:
    numbers = _Numbers(lake, "bronze")

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            _write_layer(batch.withColumn("ingested_at", _now()), "bronze", lake, numbers(batch, batch_id))

    return write


def _cleaned(batch: DataFrame) -> DataFrame:
    return silver.enrich(silver.clean(batch)).withColumn("processed_at", _now())


def silver_writer(lake: Lake, keep_rejected: bool = False) -> BatchWriter:
    """Writer of cleaned readings; ``keep_rejected`` keeps those that broke a constraint, as they came.

    Broken constraints are counted as the batch is cleaned; only a batch that has some is read again.
    """
    numbers = _Numbers(lake, "silver")
    constraints = rejects.of_readings()

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        number = numbers(batch, batch_id)
        if not keep_rejected:
            _write_layer(_cleaned(batch), "silver", lake, number)
            return
        broken = rejects.reasons(constraints).isNotNull()
        counter = _Counter(f"rejected-{number}", rejected=F.count_if(broken))
        _write_layer(_cleaned(counter.on(batch)), "silver", lake, number)
        if counter["rejected"]:
            _keep_rejected(batch, constraints, "silver", lake, number)

    return write


def chained_silver_writer(lake: Lake) -> BatchWriter:
    """Writer of readings that come from the files of the raw layer.

    Cleaned rows keep the number of the raw micro-batch and replace exactly what came of it, so that a raw
    micro-batch that is written again, and therefore read again, changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = _cleaned(batch.drop(*schemas.TIME_PARTS))
        stamped = with_time_parts(rows).withColumn("part", F.col("ingest_batch"))
        replace_partitions(schemas.conform(stamped, schemas.SILVER), lake.silver, schemas.LAYER_KEYS)
        # A row per raw micro-batch.
        counted = rows.groupBy(F.col("ingest_batch").alias("batch_id")).agg(F.count("*").alias("row_count")).persist()
        try:
            listed = counted.select(F.lit("silver").alias("table_name"), "batch_id", "row_count", _now().alias("snapshot_time"))
            lake.publish(batch.sparkSession, "silver", listed)
        finally:
            counted.unpersist()

    return write


def bronze_stream(spark: SparkSession, lake: Lake) -> DataFrame:
    """The raw layer as a stream of its files, whole micro-batches at a time.

    Only folders of micro-batches are read, so hours that are folded later are not read twice. A raw
    micro-batch appears folder by folder, each of them at once.
    """
    folders = "/".join([*(f"{part}=*" for part in schemas.TIME_PARTS), "part=[0-9]*"])
    return spark.readStream.schema(schemas.BRONZE).option("basePath", lake.bronze).parquet(f"{lake.bronze}/{folders}")


def parquet_sink(lake: Lake) -> GoldSink:
    """Statistics as Parquet, replacing exactly the batches that are written."""
    return lambda rows, table: replace_partitions(rows, lake.gold(table), ("batch_id",))


def write_statistics(
    readings: DataFrame, lake: Lake, batch_id: int | None, snapshot_time: Column | None, sink: GoldSink | StagedSink | None = None,
) -> None:
    """Write the three statistics tables of one batch, or of a whole history of batches.

    The totals are a row per zone and batch; they are kept so that zone and governorate
    statistics share one pass over the readings. With the alerts go the most severe ones of every house,
    which views read. The batch is listed, with its houses in either state, when all is written, so that
    no reader sees a part of it. Rows whose texts a table cannot hold are kept aside with the reason.

    ``sink`` replaces Parquet. A ``StagedSink`` applies a batch once, however often it is repeated; a plain
    one must run the write before it returns, and appends again.
    """
    totals = gold.region_totals(readings, batch_id, snapshot_time).persist()
    try:
        alerts = gold.active_alerts(readings, batch_id)
        tables = {"zone_stats": gold.zone_stats(totals), "gov_stats": gold.gov_stats(totals), "active_alerts": alerts}
        if hasattr(sink, "stage"):
            if batch_id is None:
                raise ValueError("a staged sink takes one batch at a time")
            broken = True  # as far as is known of a batch that an earlier attempt applied
            if not sink.committed(batch_id):
                broken = _write_tables(tables, lake, batch_id, lambda rows, table: sink.stage(rows, table, batch_id))
                sink.commit(batch_id)
        else:
            broken = _write_tables(tables, lake, batch_id, sink or parquet_sink(lake))
        houses = _held(alerts, "active_alerts")
        if sink is None:
            replace_partitions(schemas.conform(snapshot.house_state(houses), schemas.HOUSE_ALERTS), lake.houses, ("batch_id",))
            first = lake.read_houses(readings.sparkSession).where("first_of_house")
            houses = first if batch_id is None else first.where(F.col("batch_id") == batch_id)
        suspects = alerts if broken else None
        listed = _listed_batches(totals, suspects, houses) if batch_id is None else _listed(totals, suspects, houses, batch_id)
        lake.publish(readings.sparkSession, "gold", listed)
    finally:
        totals.unpersist()


def _held(rows: DataFrame, table: str) -> DataFrame:
    """Rows whose texts a statistics table can hold."""
    return rows.where(~rejects.dropped(rejects.of_statistics(table)))


def _write_tables(tables: dict[str, DataFrame], lake: Lake, batch_id: int | None, write: GoldSink) -> bool:
    """Write what the tables can hold; rows they cannot are counted on the way and, if there are any, kept aside.

    Returns whether there are any.
    """
    broken = False
    for name, rows in tables.items():
        constraints = rejects.of_statistics(name)
        counter = _Counter(f"{name}-{batch_id}", rejected=F.count_if(rejects.dropped(constraints)))
        shaped = schemas.conform(rows, schemas.GOLD[name])
        write(_held(counter.on(shaped), name), name)
        if counter["rejected"]:
            broken = True
            _keep_rejected(shaped, constraints, name, lake, -1 if batch_id is None else batch_id)
    return broken


def _row_counts() -> dict[str, Column]:
    """Rows of each statistics table, from the totals, which hold a row per zone and its numbers of alerts."""
    placed = rejects.dropped([c for c in rejects.of_statistics("zone_stats") if c.column in ("governorate", "zone")])
    of_governorate = rejects.dropped([c for c in rejects.of_statistics("gov_stats") if c.column == "governorate"])
    return {
        "zone_stats": F.count_if(~placed),
        "gov_stats": F.count_distinct(F.when(~of_governorate, F.struct("governorate"))),
        "active_alerts": F.sum(F.col("critical_count") + F.col("warning_count")),
    }


def _broken(alerts: DataFrame) -> DataFrame:
    return alerts.where(rejects.dropped(rejects.of_statistics("active_alerts")))


def _listed(totals: DataFrame, alerts: DataFrame | None, houses: DataFrame, batch_id: int) -> list[Listed]:
    """Rows of each statistics table of a batch, and its houses in either state.

    ``alerts`` are given if some of them may have texts that no table can hold.
    """
    counts = _row_counts()
    time_ = F.unix_micros(F.max("snapshot_time").cast("timestamp")).alias("micros")
    facts = totals.agg(time_, *[n.alias(t) for t, n in counts.items()]).first()
    less = {"active_alerts": 0 if alerts is None else _broken(alerts).count()}
    counted = snapshot.house_counts(houses).first()
    return [Listed(t, batch_id, facts["micros"], (facts[t] or 0) - less.get(t, 0), counted["critical"], counted["warning"]) for t in counts]


def _listed_batches(totals: DataFrame, alerts: DataFrame | None, houses: DataFrame) -> DataFrame:
    """As ``_listed``, for all batches of a history."""
    counts = _row_counts()
    batches = totals.groupBy("batch_id").agg(F.max("snapshot_time").alias("snapshot_time"), *[n.alias(t) for t, n in counts.items()])
    if alerts is not None:
        less = _broken(alerts).groupBy(F.col("batch_id").alias("broken_batch")).agg(F.count("*").alias("broken"))
        batches = batches.join(less, F.col("batch_id").eqNullSafe(F.col("broken_batch")), "left")
        batches = batches.withColumn("active_alerts", F.col("active_alerts") - F.coalesce("broken", F.lit(0)))
    counted = snapshot.house_counts(houses, ["batch_id"]).withColumnRenamed("batch_id", "counted_batch")
    batches = batches.join(counted, F.col("batch_id").eqNullSafe(F.col("counted_batch")), "left")
    rows = F.array(*[F.struct(F.lit(t).alias("table_name"), F.col(t).alias("row_count")) for t in counts])
    return batches.fillna(0, ["critical", "warning"]).select("batch_id", "snapshot_time", "critical", "warning", F.inline(rows))


def gold_writer(
    lake: Lake, event_clock: bool = False, from_silver: bool = False, keep_batch: bool = True, sink: GoldSink | StagedSink | None = None,
) -> BatchWriter:
    """Statistics writer; ``batch_id`` of its rows is the micro-batch number.

    Readings are aggregated as parsed unless ``from_silver``. Snapshots carry the clock, or with
    ``event_clock`` the newest event time of the batch. Statistics and alerts are two passes
    over the batch; ``keep_batch`` keeps its columns in memory or on local disk between them,
    which is cheaper than parsing JSON again. Executors that are lost only cost that parsing.
    """
    numbers = _Numbers(lake, "gold")

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        readings = (silver.clean(batch) if from_silver else batch).select(*gold.INPUTS)
        if keep_batch:
            readings = readings.persist()
        try:
            write_statistics(readings, lake, numbers(batch, batch_id), None if event_clock else _now(), sink)
        finally:
            if keep_batch:
                readings.unpersist()

    return write


def _name(layer: str, lake: Lake) -> str:
    """The same for a layer of a lake in every process."""
    return f"{layer}-{hashlib.sha256(lake.root.encode()).hexdigest()[:12]}"


def _replaying(source: messages.Paced, fields: Sequence[str] | None, writer: BatchWriter) -> BatchWriter:
    """Writer of the messages that a micro-batch of ticks sends."""
    return lambda batch, batch_id: writer(messages.parse(source.sent(batch), fields), batch_id)


def start(
    source: DataFrame | messages.Paced, layer: str, writer: BatchWriter, lake: Lake, available_now: bool = False, interval: str | None = None,
) -> StreamingQuery:
    """Start one layer's query on its interval, or let it work off what is there and end.

    ``source`` are parsed readings, or messages, of which only the layer's own fields are parsed.
    """
    if isinstance(source, messages.Paced):
        parsed, writer = source.ticks, _replaying(source, FIELDS.get(layer), writer)
    else:
        parsed = messages.parse(source, FIELDS.get(layer)) if "value" in source.columns else source
    trigger = {"availableNow": True} if available_now else {"processingTime": interval or TRIGGERS[layer]}
    return (
        parsed.writeStream.queryName(_name(layer, lake))
        .foreachBatch(writer)
        .outputMode("append")
        .option("checkpointLocation", lake.checkpoint(layer))
        .trigger(**trigger)
        .start()
    )


def _writers(lake: Lake, event_clock: bool, sink: GoldSink | StagedSink | None, chained: bool) -> dict[str, BatchWriter]:
    cleaned = chained_silver_writer(lake) if chained else silver_writer(lake)
    return {"bronze": bronze_writer(lake), "silver": cleaned, "gold": gold_writer(lake, event_clock, sink=sink)}


def _source(source: DataFrame | messages.Paced, layer: str, lake: Lake, chained: bool) -> DataFrame | messages.Paced:
    if not chained or layer != "silver":
        return source
    return bronze_stream((source.ticks if isinstance(source, messages.Paced) else source).sparkSession, lake)


def _stop(queries: list[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def run(
    source: DataFrame | messages.Paced, lake: Lake, event_clock: bool = False, sink: GoldSink | StagedSink | None = None, intervals: dict[str, str] | None = None,
    chained: bool = False, until: Callable[[], bool] | None = None,
) -> None:
    """Keep all layers running until one of them ends or ``until`` holds, then stop the others.

    If one ends by an error, that is raised. Other queries of the session make no difference. ``chained``
    lets the cleaned layer read the raw layer instead of the source.
    """
    queries: list[StreamingQuery] = []
    try:
        for layer, writer in _writers(lake, event_clock, sink, chained).items():
            queries.append(start(_source(source, layer, lake, chained), layer, writer, lake, interval=(intervals or {}).get(layer)))
        while all(query.isActive for query in queries) and not (until is not None and until()):
            queries[0].awaitTermination(1)
        for query in queries:
            if query.exception() is not None:
                raise query.exception()
    finally:
        _stop(queries)


def catch_up(source: DataFrame, lake: Lake, event_clock: bool = False, sink: GoldSink | StagedSink | None = None, chained: bool = False) -> None:
    """Bring all layers up to date with the source, then return; an error in one stops the others.

    Chained, the cleaned layer begins when the raw one is up to date.
    """
    queries: list[StreamingQuery] = []
    try:
        for layer, writer in sorted(_writers(lake, event_clock, sink, chained).items(), key=lambda x: chained and x[0] == "silver"):
            if chained and layer == "silver":
                for query in queries:
                    query.awaitTermination()
            queries.append(start(_source(source, layer, lake, chained), layer, writer, lake, available_now=True))
        for query in queries:
            query.awaitTermination()
    finally:
        _stop(queries)
