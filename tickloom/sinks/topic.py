"""Publishing ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.schema import TICK_TOPIC


def payload_columns() -> list[Column]:
    """``key`` and ``value`` of a tick. Decimals are JSON strings, so no reader rounds them."""
    value = F.to_json(
        F.struct(
            "symbol",
            F.col("price").cast("string").alias("price"),
            F.col("quantity").cast("string").alias("quantity"),
            "timestamp",
            "trade_id",
        )
    )
    return [F.col("symbol").cast("binary").alias("key"), value.cast("binary").alias("value")]


def tick_payload(ticks: DataFrame) -> DataFrame:
    """Kafka key and value per tick."""
    return ticks.select(*payload_columns())


def publish_ticks(
    ticks: DataFrame, bootstrap_servers: str, checkpoint: str, *, topic: str = TICK_TOPIC
) -> StreamingQuery:
    """Stream ticks into the topic; the key sends each symbol to one topic partition."""
    return (
        tick_payload(ticks)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
