"""Layers that queries of one session share, kept as tables in the session's shared folder.

Serving queries read the statistics tables, as every consumer of a running system does, so a
query costs its newest batch and not a pass over all readings. The tables are written once
per session and input folder, survive the loss of executors, and go with ``release``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.plans import fixture
from sensorlake.sources import messages
from sensorlake.sources.files import delete
from sensorlake.sources.layers import GoldTable, Lake
from sensorlake.sources.shared import shared_folder
from sensorlake.streaming import layers

# Days of readings published before each run of the streaming layers.
ROUND_DAYS = 10
# Micro-batches of the paced run, and its triggers.
PACED_BATCHES = 6
PACED_TRIGGERS = {"bronze": "200 milliseconds", "silver": "200 milliseconds", "gold": "2 seconds"}

_warehouses: dict[tuple[str, str], "Warehouse"] = {}


@dataclass
class Warehouse:
    spark: SparkSession
    sf_dir: str
    folders: list[str] = field(default_factory=list)

    def folder(self) -> str:
        """A new shared folder, removed by ``release``."""
        self.folders.append(shared_folder(self.spark))
        return self.folders[-1]

    @cached_property
    def readings(self) -> DataFrame:
        return fixture.readings(self.spark, self.sf_dir)

    @cached_property
    def places(self) -> DataFrame:
        """Readings without their sensors."""
        return fixture.readings(self.spark, self.sf_dir, sensors=False)

    @cached_property
    def dirty(self) -> DataFrame:
        return fixture.dirty(self.readings)

    @cached_property
    def history(self) -> Lake:
        """Statistics of all batches, computed in one go."""
        lake = Lake(self.folder())
        layers.write_statistics(self.readings, lake, batch_id=None, snapshot_time=None)
        fixture.houses(self.spark, self.sf_dir).write.parquet(f"{lake.root}/houses")
        return lake

    @cached_property
    def alerts(self) -> GoldTable:
        return self.history.gold_table(self.spark, "active_alerts")

    @cached_property
    def gov(self) -> GoldTable:
        return self.history.gold_table(self.spark, "gov_stats")

    @cached_property
    def zones(self) -> GoldTable:
        return self.history.gold_table(self.spark, "zone_stats")

    @cached_property
    def houses(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.history.root}/houses")

    def total_houses(self) -> Column:
        return self.houses.agg(F.count("*")).scalar()

    @cached_property
    def zone_dim(self) -> DataFrame:
        """Zone coordinates as a stored table, whose known size decides how it is joined."""
        path = f"{self.folder()}/zones"
        fixture.zone_dim(self.spark, self.sf_dir).write.parquet(path)
        return self.spark.read.parquet(path)

    def _as_parsed(self, rows: DataFrame) -> DataFrame:
        missing = {"timestamp": "string", "kafka_partition": "int", "kafka_offset": "bigint", "raw_value": "string"}
        return rows.withColumns({name: F.lit(None).cast(kind) for name, kind in missing.items()})

    @cached_property
    def damaged(self) -> Lake:
        """A raw layer over damaged readings, partitioned by hour."""
        lake = Lake(self.folder())
        layers.bronze_writer(lake)(self._as_parsed(self.dirty), 0)
        return lake

    @cached_property
    def cleaned(self) -> Lake:
        """A cleaned layer over damaged readings, with those that broke a constraint kept aside."""
        lake = Lake(self.folder())
        layers.silver_writer(lake, keep_rejected=True)(self._as_parsed(self.dirty), 0)
        return lake

    @cached_property
    def published(self) -> str:
        """Folder of all readings as keyed messages."""
        landing = self.folder()
        messages.write_files(fixture.payload(self.readings), landing)
        return landing

    def rounds(self) -> list[int]:
        """Publishing rounds that hold events; one number per ``ROUND_DAYS`` days."""
        number = F.floor(fixture.day_number("ts") / ROUND_DAYS)
        rows = fixture.table(self.spark, self.sf_dir, "events").select(number.alias("n")).distinct().orderBy("n")
        return [row.n for row in rows.collect()]

    @cached_property
    def streamed(self) -> Lake:
        """Layers kept by the streaming queries.

        All readings are published round by round; after each round the queries are started
        anew from their checkpoints and work off what is new, so a round is one micro-batch. A
        last start finds nothing new.
        """
        lake = Lake(self.folder())
        landing = f"{lake.root}/landing"
        for number in self.rounds():
            self._send(number, landing)
            self._catch_up(landing, lake)
        self._catch_up(landing, lake)
        return lake

    @cached_property
    def chained(self) -> Lake:
        """Layers of which the cleaned one reads the raw one, brought up to date after each round."""
        lake = Lake(self.folder())
        landing = f"{lake.root}/landing"
        for number in self.rounds():
            self._send(number, landing)
            layers.catch_up(messages.file_stream(self.spark, landing), lake, event_clock=True, chained=True)
        return lake

    @cached_property
    def paced(self) -> Lake:
        """Layers fed by a clock that sends a sixth of all readings with every tick; the statistics lag behind the others."""
        lake = Lake(self.folder())
        path = f"{lake.root}/sent"
        sized = self.places.agg(F.count("*").alias("n"), F.max("eid").alias("newest")).first()
        each = max(1, -(-sized.n // PACED_BATCHES))
        # Repeated numbers need fewer ticks.
        final = -1 if sized.newest is None else min(sized.newest // each, PACED_BATCHES - 1)
        messages.write_paced(fixture.payload(fixture.readings(self.spark, self.sf_dir, even=True)), path, "eid", each)
        source = messages.paced_stream(self.spark, path)
        held = ("bronze", "silver", "gold")

        def done() -> bool:
            last = [lake.heads(self.spark, layer).agg(F.max("last_batch")).first()[0] for layer in held]
            return all(final < 0 or (n is not None and n >= final) for n in last)

        layers.run(source, lake, event_clock=True, intervals=PACED_TRIGGERS, until=done)
        return lake

    def _send(self, number: int, landing: str) -> None:
        """Publish the readings of a round, spread evenly over the files."""
        days = (number * ROUND_DAYS, (number + 1) * ROUND_DAYS)
        sent = fixture.payload(fixture.readings(self.spark, self.sf_dir, days, even=True))
        messages.write_files(sent, landing, ordered=False)

    def _catch_up(self, landing: str, lake: Lake) -> None:
        layers.catch_up(messages.file_stream(self.spark, landing), lake, event_clock=True)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    # Tables hold instants; event times carry no zone and are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _warehouses:
        _warehouses[key] = Warehouse(spark, key[1])
    return _warehouses[key]


def release(spark: SparkSession) -> None:
    """Remove the intermediate tables of this session's queries; their results can't be read any more."""
    for key in [k for k in _warehouses if k[0] == spark.sparkContext.applicationId]:
        for folder in _warehouses.pop(key).folders:
            delete(spark, folder)
