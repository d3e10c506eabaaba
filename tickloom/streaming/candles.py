"""Streaming candles.

Three pipelines over one record stream (see ``sources.topic``):

``stream_candles``
    Built-in operators only. Trades are deduplicated in state keyed by (symbol, window, trade id)
    and combined per (symbol, window) with a map-side partial, so a hot symbol spreads over all
    tasks. Both states are freed when their window closes.

``stream_candles_filled``
    The same, followed by a per-symbol gap fill that sees one row per window, not per trade.
    The choice for heavy feeds.

``stream_candles_by_symbol``
    One stateful processor per symbol over raw ticks. Lateness is judged by the symbol's own
    sealed windows, so a symbol whose very first ticks are older than the watermark still gets
    its candles; the other two lose those ticks to Spark's late-row filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.decimals import from_units, to_units
from tickloom.operators.candles import order_key
from tickloom.schema import CANDLE_COLUMNS, WATERMARK_DELAY_MS, WINDOW_MS
from tickloom.streaming.processors import FLAT_CANDLE, TAGGED, CandleProcessor, GapFillProcessor


def with_event_time(records: DataFrame, delay_ms: int = WATERMARK_DELAY_MS) -> DataFrame:
    """Event time from ``timestamp``; ticks and heartbeats both move the watermark."""
    return records.withColumn("event_time", F.timestamp_millis("timestamp")).withWatermark(
        "event_time", f"{delay_ms} milliseconds"
    )


def stream_candles(
    records: DataFrame, *, size_ms: int = WINDOW_MS, delay_ms: int = WATERMARK_DELAY_MS
) -> DataFrame:
    """One candle per window with trades, emitted when the window closes."""
    timed = with_event_time(records, delay_ms)
    # The predicate reads event_time so that the optimizer keeps it above the watermark node.
    # A plain kind = 'tick' is pushed below it, and heartbeats stop counting.
    is_tick = F.when(F.col("kind") == "heartbeat", F.lit(False)).otherwise(
        F.col("event_time") >= F.timestamp_millis(F.lit(0).cast("long"))
    )
    first = [
        F.min_by(name, "arrival").alias(name) for name in ("price", "quantity", "timestamp")
    ]
    trades = (
        timed.filter(is_tick)
        .groupBy("symbol", F.window("event_time", f"{size_ms} milliseconds").alias("window"), "trade_id")
        .agg(F.min("arrival").alias("arrival"), *first)
    )
    return (
        trades.groupBy("symbol", "window")
        .agg(
            F.min_by("price", order_key()).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order_key(first=False)).alias("close"),
            F.sum("quantity").cast("decimal(18,8)").alias("volume"),
            F.count("*").alias("trades"),
        )
        .withColumn("start", F.unix_millis("window.start"))
        .withColumn("end", F.unix_millis("window.end"))
        .select(*CANDLE_COLUMNS)
    )


def stream_candles_filled(
    records: DataFrame, *, size_ms: int = WINDOW_MS, delay_ms: int = WATERMARK_DELAY_MS
) -> DataFrame:
    """``stream_candles`` with a flat candle for every empty window after a symbol's first."""
    candles = stream_candles(records, size_ms=size_ms, delay_ms=delay_ms)
    filled = (
        _in_units(candles)
        .groupBy("symbol")
        .transformWithStateInPandas(GapFillProcessor(size_ms), FLAT_CANDLE, "Append", "EventTime")
    )
    return _from_units(filled, size_ms)


def stream_candles_by_symbol(
    records: DataFrame, *, size_ms: int = WINDOW_MS, delay_ms: int = WATERMARK_DELAY_MS
) -> DataFrame:
    """Candles and gap fill from one stateful processor keyed by symbol.

    Heartbeats travel along under a NULL symbol and are skipped by the processor. ``event_time``
    is left behind before the stateful step: with no watermarked column in its input, Spark drops
    no rows itself and the processor alone decides what is late.
    """
    candles = _ticks_by_symbol(records, delay_ms).transformWithStateInPandas(
        CandleProcessor(size_ms), FLAT_CANDLE, "Append", "EventTime"
    )
    return _from_units(candles, size_ms)


def stream_candles_and_late(
    records: DataFrame, *, size_ms: int = WINDOW_MS, delay_ms: int = WATERMARK_DELAY_MS
) -> DataFrame:
    """``stream_candles_by_symbol`` whose rejected ticks leave too, tagged, for ``stream_to_tables``.

    ``candle_rows`` and ``late_rows`` take the two kinds apart.
    """
    return _ticks_by_symbol(records, delay_ms).transformWithStateInPandas(
        CandleProcessor(size_ms, report_late=True), TAGGED, "Append", "EventTime"
    )


def candle_rows(tagged: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """The candles among tagged rows."""
    return _from_units(tagged.filter("tag = 'candle'"), size_ms)


def late_rows(tagged: DataFrame) -> DataFrame:
    """The rejected ticks: where they stood, their window, and the first window still open then."""
    return tagged.filter("tag = 'late'").select("symbol", "trade_id", "timestamp", "arrival", "start", "bound")


def _ticks_by_symbol(records: DataFrame, delay_ms: int):
    return (
        with_event_time(records, delay_ms)
        .select(
            "symbol",
            "timestamp",
            "trade_id",
            "arrival",
            to_units(F.col("price")).alias("price"),
            to_units(F.col("quantity")).alias("quantity"),
        )
        .groupBy("symbol")
    )


def _in_units(candles: DataFrame) -> DataFrame:
    prices = [to_units(F.col(c)).alias(c) for c in ("open", "high", "low", "close", "volume")]
    return candles.select("symbol", "start", *prices, "trades")


def _from_units(flat: DataFrame, size_ms: int) -> DataFrame:
    prices = [from_units(F.col(c)).alias(c) for c in ("open", "high", "low", "close", "volume")]
    end = (F.col("start") + F.lit(size_ms)).alias("end")
    return flat.select("symbol", "start", end, *prices, "trades")
