"""Ticks to candles."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.decimals import kept_exactly
from tickloom.functions.timing import bucket_start, month_key
from tickloom.schema import CANDLE, CANDLE_COLUMNS, PRICE, WINDOW_MS


def bucket_ticks(ticks: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """Add the tumbling window [start, end) of each tick."""
    start = bucket_start(F.col("timestamp"), size_ms)
    return ticks.withColumn("start", start).withColumn("end", start + F.lit(size_ms))


def candle_ticks(ticks: DataFrame) -> DataFrame:
    """Rows that can enter a candle: no heartbeats, and nothing before 1970, where every
    window counts as sealed."""
    return ticks.filter(F.col("symbol").isNotNull() & (F.col("timestamp") >= 0))


def order_key(*, first: bool = True) -> Column:
    """(timestamp, arrival) in one number of fixed width, so that candles stay a hash aggregate.

    Of equal timestamps the first arrival is the smallest key, or with ``first=False`` the largest.
    """
    time = F.col("timestamp").cast("decimal(19,0)") * F.lit(Decimal(10**19))
    place = F.col("arrival").cast("decimal(19,0)")
    return (time + place if first else time - place).cast("decimal(38,0)")


def dedup_ticks(ticks: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """Keep the first arrival per (symbol, window, trade id).

    All buffers are fixed-width, so this is a hash aggregate with a map-side partial: copies of
    one trade collapse before the shuffle, however many there are.
    """
    return _first_arrivals(bucket_ticks(ticks, size_ms))


def _first_arrivals(bucketed: DataFrame) -> DataFrame:
    first = [F.min_by(c, "arrival").alias(c) for c in ("price", "quantity", "timestamp")]
    return bucketed.groupBy("symbol", "start", "trade_id").agg(*first, F.min("arrival").alias("arrival"))


def candles(
    ticks: DataFrame,
    size_ms: int = WINDOW_MS,
    *,
    dedup: bool = True,
    layout: str = "spread",
) -> DataFrame:
    """One candle per (symbol, window) that has ticks.

    Open is the price at the smallest timestamp, close at the largest; of ticks that share it,
    the first to arrive counts for both. ``arrival`` is the position in the topic.

    ``dedup=False`` is for input without repeated trade ids: one aggregate with a map-side
    partial, so only partial candles are shuffled.

    ``layout`` says how deduplication shuffles. ``spread`` hashes by trade and stands any skew.
    ``colocated`` hashes by window and so needs no second shuffle; take it when no window is
    too large for a task, as the caller must know.
    """
    valid = candle_ticks(ticks)
    if not dedup:
        trades = bucket_ticks(valid, size_ms)
    elif layout == "spread":
        trades = dedup_ticks(valid, size_ms)
    elif layout == "colocated":
        trades = _first_arrivals(bucket_ticks(valid, size_ms).repartition("symbol", "start"))
    else:
        raise ValueError(f"unknown layout: {layout}")
    return (
        trades.groupBy("symbol", "start")
        .agg(
            F.min_by("price", order_key()).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order_key(first=False)).alias("close"),
            F.sum("quantity").cast(PRICE).alias("volume"),
            F.count("*").alias("trades"),
        )
        .withColumn("end", F.col("start") + F.lit(size_ms))
        .select(*CANDLE_COLUMNS)
    )


def to_candle_schema(df: DataFrame) -> DataFrame:
    """The candle columns by name, in order and typed; others are dropped, a missing one fails.

    A value that its column cannot hold exactly raises instead of being rounded.
    """
    return df.select(
        *[kept_exactly(F.col(f.name), df.schema[f.name].dataType, f.dataType).alias(f.name) for f in CANDLE.fields]
    )


def add_month(df: DataFrame) -> DataFrame:
    """Add the ``month`` partition key of ``start``."""
    return df.withColumn("month", month_key(F.col("start")))
