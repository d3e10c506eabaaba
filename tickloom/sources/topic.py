"""The tick and heartbeat topics, and the JSON records in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.decimals import exact_decimal, required, whole_number
from tickloom.schema import HEARTBEAT_TOPIC, PRICE, RECORD, TICK_TOPIC, TOPIC

# Fixed value: how long a fetch may wait for data.
FETCH_WAIT_MS = 50

_TEXT_FIELDS = "type STRING, symbol STRING, price STRING, quantity STRING, timestamp STRING, trade_id STRING"


def kafka_topics(
    spark: SparkSession,
    bootstrap_servers: str,
    *,
    topics: tuple[str, ...] = (TICK_TOPIC, HEARTBEAT_TOPIC),
    group_id: str = "tickloom",
    max_offsets_per_trigger: int | None = None,
    min_offsets_per_trigger: int | None = None,
    max_trigger_delay: str | None = None,
) -> DataFrame:
    """One stream over both topics from the earliest offset.

    Offsets give the arrival order within a topic partition, so a topic with several partitions
    has to be keyed by symbol. ``max_offsets_per_trigger`` bounds a micro-batch after a backlog.
    With ``min_offsets_per_trigger`` a micro-batch waits until so many records are there, but no
    longer than ``max_trigger_delay``: fewer small batches on a quiet topic.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("groupIdPrefix", group_id)
        .option("kafka.fetch.max.wait.ms", FETCH_WAIT_MS)
        .option("kafka.fetch.min.bytes", 1)
    )
    if max_trigger_delay and not min_offsets_per_trigger:
        raise ValueError("max_trigger_delay bounds the wait for min_offsets_per_trigger")
    bounds = {
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
        "minOffsetsPerTrigger": min_offsets_per_trigger,
        "maxTriggerDelay": max_trigger_delay,
    }
    return reader.options(**{name: value for name, value in bounds.items() if value}).load()


def file_topics(
    spark: SparkSession, path: str, *, file_format: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same stream over topic records that were landed as files."""
    reader = spark.readStream.format(file_format).schema(TOPIC)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def parse_records(topic: DataFrame, arrival: Column | None = None) -> DataFrame:
    """JSON values to typed records, one row each, for a batch or streaming frame.

    ``type`` tells heartbeats from ticks; unknown fields are ignored. A record that is no JSON,
    lacks a field or holds an inexact number fails the query.
    """
    value = required(F.col("value").cast("string"), "a value", "string")
    record = F.from_json(value, _TEXT_FIELDS, {"mode": "FAILFAST"})
    if not topic.isStreaming:
        # A generator keeps filters on parsed fields above it; pushed below, they would parse each
        # value once more. In a stream the watermark already does.
        record = F.explode(F.array(record))
    parsed = topic.select(
        record.alias("r"),
        (F.col("offset") if arrival is None else arrival).cast("long").alias("arrival"),
    )
    heartbeat = F.coalesce(F.col("r.type") == "heartbeat", F.lit(False))

    def tick_only(value: Column, data_type) -> Column:
        return F.when(heartbeat, F.lit(None).cast(data_type)).otherwise(value)

    return parsed.select(
        F.when(heartbeat, F.lit("heartbeat")).otherwise(F.lit("tick")).alias("kind"),
        tick_only(required(F.col("r.symbol"), "symbol", "string"), "string").alias("symbol"),
        tick_only(required(exact_decimal(F.col("r.price")), "price", PRICE), PRICE).alias("price"),
        tick_only(required(exact_decimal(F.col("r.quantity")), "quantity", PRICE), PRICE).alias("quantity"),
        required(whole_number(F.col("r.timestamp")), "timestamp", "long").alias("timestamp"),
        tick_only(required(whole_number(F.col("r.trade_id")), "trade_id", "long"), "long").alias("trade_id"),
        "arrival",
    ).select(*RECORD.fieldNames())


def ticks_only(records: DataFrame) -> DataFrame:
    """Drop heartbeats from a batch frame. Streams keep them: they move the watermark."""
    return records.filter(F.col("kind") == "tick")
