"""Contiguous candles: flat rows for windows without trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.timing import bucket_start
from tickloom.operators.blocks import with_neighbour
from tickloom.operators.candles import candles
from tickloom.operators.late import accepted_ticks
from tickloom.schema import CANDLE_COLUMNS, PRICE, WATERMARK_DELAY_MS, WINDOW_MS

# Windows per block of a symbol: a week of minutes.
_BLOCK_WINDOWS = 10_080


def final_watermark(records: DataFrame, delay_ms: int = WATERMARK_DELAY_MS) -> Column:
    """Where the watermark ends up after all records, as a scalar subquery."""
    latest = F.max("timestamp") - F.lit(delay_ms + 1)
    return records.agg(latest.alias("watermark")).scalar()


def fill_gaps(df: DataFrame, horizon_ms: Column, size_ms: int = WINDOW_MS) -> DataFrame:
    """Candles up to ``horizon_ms`` without holes after each symbol's first.

    A window is out once its end is at most the horizon. Each candle learns the start of the next
    and expands to cover the windows between, so no spine is built and nothing is joined.
    """
    size = F.lit(size_ms).cast("long")
    stop = bucket_start(horizon_ms, size_ms)
    sealed = df.filter(F.col("start") + size <= horizon_ms)
    linked = with_neighbour(
        sealed,
        "_next",
        "start",
        order="start",
        keys=("symbol",),
        offset=1,
        block=_BLOCK_WINDOWS * size_ms,
    ).withColumn("_last", F.coalesce("_next", stop) - size)

    # Two steps keep each array short, however long the silence is.
    stride = F.lit(_BLOCK_WINDOWS * size_ms).cast("long")
    runs = linked.withColumn("_run", F.explode(F.sequence("start", "_last", stride)))
    run_end = F.least(F.col("_run") + stride - size, F.col("_last"))
    windows = runs.withColumn("_window", F.explode(F.sequence(F.col("_run"), run_end, size)))

    traded = F.col("_window") == F.col("start")

    def traded_or(column: str, otherwise: Column) -> Column:
        return F.when(traded, F.col(column)).otherwise(otherwise).alias(column)

    return windows.select(
        "symbol",
        F.col("_window").alias("start"),
        (F.col("_window") + size).alias("end"),
        *[traded_or(c, F.col("close")) for c in ("open", "high", "low")],
        "close",
        traded_or("volume", F.lit(0).cast(PRICE)),
        traded_or("trades", F.lit(0).cast("long")),
    ).select(*CANDLE_COLUMNS)


def candles_filled(
    records: DataFrame,
    size_ms: int = WINDOW_MS,
    *,
    delay_ms: int = WATERMARK_DELAY_MS,
    horizon_ms: Column | None = None,
    dedup: bool = True,
    layout: str = "spread",
) -> DataFrame:
    """Gap-filled candles over landed records; heartbeats count for the horizon only."""
    horizon = final_watermark(records, delay_ms) if horizon_ms is None else horizon_ms
    return fill_gaps(candles(records, size_ms, dedup=dedup, layout=layout), horizon, size_ms)


def candles_as_streamed(
    records: DataFrame, size_ms: int = WINDOW_MS, *, delay_ms: int = WATERMARK_DELAY_MS
) -> DataFrame:
    """What a live run over the records in order of arrival writes: late ticks are left out."""
    horizon = final_watermark(records, delay_ms)
    return fill_gaps(candles(accepted_ticks(records, size_ms, delay_ms=delay_ms), size_ms), horizon, size_ms)
