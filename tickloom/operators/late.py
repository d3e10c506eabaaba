"""Which ticks a live run rejects as late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.timing import bucket_start
from tickloom.operators.blocks import BLOCK, Earlier, with_earlier
from tickloom.schema import WATERMARK_DELAY_MS, WINDOW_MS


def flag_late(
    records: DataFrame,
    size_ms: int = WINDOW_MS,
    *,
    delay_ms: int = WATERMARK_DELAY_MS,
    block: int | list[float] = BLOCK,
) -> DataFrame:
    """Add ``watermark`` and ``is_late`` to each tick, judged at the moment it arrives.

    The watermark before a record is the largest timestamp of all earlier records less the delay
    and one. A symbol has sealed windows once one of its earlier windows ends at or below it; from
    then on everything up to the watermark's own window is sealed and a tick in there is late.
    """
    start = bucket_start(F.col("timestamp"), size_ms)
    placed = (
        records.withColumn("start", start)
        .withColumn("end", start + F.lit(size_ms))
        # A rejected tick opens no window, and before 1970 all are.
        .withColumn("_end", F.when(start >= 0, F.col("end")))
    )
    seen = with_earlier(
        placed,
        Earlier("_latest", "max", "timestamp"),
        Earlier("_first_end", "min", "_end", ("symbol",)),
        order="arrival",
        block=block,
    )
    watermark = F.col("_latest") - F.lit(delay_ms + 1)
    sealed = F.col("_first_end") <= watermark
    late = (F.col("start") < 0) | (sealed & (F.col("start") < bucket_start(watermark, size_ms)))
    return (
        seen.filter(F.col("symbol").isNotNull())
        .withColumn("watermark", watermark)
        .withColumn("is_late", F.coalesce(late, F.lit(False)))
        .drop("_end", "_first_end", "_latest")
    )


def accepted_ticks(
    records: DataFrame, size_ms: int = WINDOW_MS, *, delay_ms: int = WATERMARK_DELAY_MS
) -> DataFrame:
    """The ticks a live run takes into candles."""
    flagged = flag_late(records, size_ms, delay_ms=delay_ms)
    return flagged.filter(~F.col("is_late")).select(*records.columns)
