"""Messages: keyed JSON readings on Kafka, or the same key/value rows as files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from sensorlake import schemas

TOPIC = "sensor_data_stream"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_ZONED_FORMAT = f"{TIME_FORMAT}XXX"

# Delivery settings of the reading topic.
_SOURCE_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false"}
_SINK_OPTIONS = {
    "kafka.acks": "all",
    "kafka.compression.type": "gzip",
    "kafka.linger.ms": "5",
    "kafka.batch.size": "32768",
    "kafka.retries": "3",
}


def kafka_source_options(servers: str, topic: str = TOPIC, **overrides: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **_SOURCE_OPTIONS, **overrides}


def kafka_sink_options(servers: str, topic: str = TOPIC, **overrides: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **_SINK_OPTIONS, **overrides}


def _paced(name: str, most: int | None) -> dict[str, str]:
    return {} if most is None else {name: str(most)}


def kafka_stream(
    spark: SparkSession, servers: str, topic: str = TOPIC, max_offsets_per_trigger: int | None = None, **overrides: str,
) -> DataFrame:
    """Streaming messages of a topic. Needs Spark's Kafka package on the class path.

    ``max_offsets_per_trigger`` bounds a micro-batch; what is left waits for the next.
    """
    options = kafka_source_options(servers, topic, **_paced("maxOffsetsPerTrigger", max_offsets_per_trigger), **overrides)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset")


def kafka_writer(messages: DataFrame, servers: str, topic: str = TOPIC, **overrides: str) -> DataFrameWriter:
    """Batch writer to a topic; Kafka keeps the order of a key by keeping it on one partition."""
    return messages.select("key", "value").write.format("kafka").options(**kafka_sink_options(servers, topic, **overrides))


def _with_offsets(files: DataFrame) -> DataFrame:
    return files.select("key", "value", F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"))


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Streaming messages from files that appear under ``path``.

    ``max_files_per_trigger`` bounds a micro-batch; what is left waits for the next.
    """
    paced = _paced("maxFilesPerTrigger", max_files_per_trigger)
    return _with_offsets(spark.readStream.schema(schemas.MESSAGE).format(fmt).options(**paced, **options).load(path))


@dataclass(frozen=True)
class Paced:
    """A stream of ticks, and the stored messages (key, value, tick) that each of them sends."""

    ticks: DataFrame
    stored: DataFrame

    def sent(self, batch: DataFrame) -> DataFrame:
        """The messages of a micro-batch of ticks; only their own folders are read."""
        ticks = [row.tick for row in batch.select("tick").collect()]
        return _with_offsets(self.stored.where(F.col("tick").isin(ticks)))


def write_paced(messages: DataFrame, path: str, number: str, each: int) -> None:
    """Store messages by the tick that sends them: ``each`` go with every tick, by their ``number`` from 0."""
    tick = F.floor(F.col(number) / each).cast("long")
    messages.select("key", "value", tick.alias("tick")).write.partitionBy("tick").parquet(path)


def paced_stream(spark: SparkSession, path: str) -> Paced:
    """Messages of ``write_paced`` as a stream that sends those of one tick, counted from 0, per micro-batch.

    A query that is triggered later finds the same micro-batches waiting. What is sent does not depend on the
    clock, and there is no end: micro-batches beyond the last tick are empty.
    """
    ticks = (
        spark.readStream.format("rate-micro-batch")
        .options(rowsPerBatch="1", numPartitions="1", startTimestamp="0", advanceMillisPerBatch="1000")
        .load()
    )
    stored = spark.read.schema(StructType([*schemas.MESSAGE.fields, StructField("tick", LongType())])).parquet(path)
    return Paced(ticks.select(F.col("value").alias("tick")), stored)


def read_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _with_offsets(spark.read.schema(schemas.MESSAGE).format(fmt).load(path))


def to_messages(readings: DataFrame, *keep: str) -> DataFrame:
    """Readings as keyed JSON, with their event time and the columns to ``keep``.

    A payload's text time stamp is the reading's own ``timestamp``, else its event time in UTC.
    """
    stamped = readings
    if "timestamp" not in readings.columns:
        stamped = readings.withColumn("timestamp", _utc_text("event_time", readings))
    value = F.to_json(F.struct(*schemas.READING.names))
    return stamped.select(F.col("house_id").alias("key"), value.alias("value"), "event_time", *keep)


def write_files(messages: DataFrame, path: str, fmt: str = "parquet", ordered: bool = True) -> None:
    """Append messages as files.

    ``ordered`` keeps the readings of a house in time order along the file names. It ranges
    over (key, time) rather than hashing the key, so a house with very many readings is
    spread over several files instead of one task.
    """
    if ordered:
        messages = messages.repartitionByRange("key", "event_time").sortWithinPartitions("key", "event_time")
    messages.select("key", "value").write.mode("append").format(fmt).save(path)


def _utc_text(time: str, readings: DataFrame) -> Column:
    """A time as text in UTC, whatever the session's zone; times without a zone are UTC."""
    if isinstance(readings.schema[time].dataType, TimestampNTZType):
        return F.date_format(time, TIME_FORMAT)
    seconds = F.unix_seconds(time)
    clock = F.pmod(seconds, F.lit(86_400))
    parts = (clock / 3600, clock / 60 % 60, clock % 60)
    day = F.date_from_unix_date(F.floor(seconds / 86_400).cast("int")).cast("string")
    return F.concat(day, F.lit(" "), F.format_string("%02d:%02d:%02d", *[F.floor(p).cast("int") for p in parts]))


def parse(messages: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Messages to typed readings with their Kafka position and event time.

    ``fields`` names the payload fields to parse, all by default; other fields are skipped as the
    payload is read, and without all fields there is no ``raw_value``. The time stamp is read
    as UTC in every session.

    A payload that is not JSON gives NULL fields and is kept in ``raw_value``; a field of the
    wrong type gives NULL for that field; an unreadable time stamp gives a NULL ``event_time``.
    """
    if fields is None:
        payload = StructType([*schemas.READING.fields, StructField("raw_value", StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "raw_value"}
    else:
        payload = StructType([f for f in schemas.READING.fields if f.name in {*fields, "timestamp"}])
        options = {"mode": "PERMISSIVE"}
    # As the output of a generator the payload is parsed once per message: later filters stay
    # above it, where a plain expression would be copied into them and parsed again.
    reading = F.from_json("value", payload, options)
    parsed = messages.select(
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.inline(F.array(reading)),
    )
    utc = F.concat("timestamp", F.lit("+00:00"))
    return parsed.withColumn("event_time", F.try_to_timestamp(utc, F.lit(_ZONED_FORMAT)))
