"""When a symbol's live feed is complete enough to fetch the rest of its day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.timing import bucket_start
from tickloom.operators.blocks import BLOCK, Earlier, with_earlier
from tickloom.schema import READY_TIMEOUT_S, WINDOW_MS

MINUTE_MS = 60_000


def with_session(ticks: DataFrame, resets: DataFrame, *, block: int | list[float] = BLOCK) -> DataFrame:
    """Add ``session``: how many resets of the symbol came before the tick.

    ``resets`` holds (symbol, arrival), one row per reconnect of the symbol's connection or per
    unsubscribe, positioned in the same order of arrival as the ticks.
    """
    marked = ticks.withColumn("_reset", F.lit(0).cast("long")).unionByName(
        resets.select("symbol", "arrival", F.lit(1).cast("long").alias("_reset")),
        allowMissingColumns=True,
    )
    counted = with_earlier(
        marked, Earlier("session", "sum", "_reset", ("symbol",)), order="arrival", block=block
    )
    return (
        counted.filter(F.col("_reset") == 0)
        .drop("_reset")
        .withColumn("session", F.coalesce("session", F.lit(0).cast("long")))
    )


def readiness_trigger(
    ticks: DataFrame, size_ms: int = WINDOW_MS, *, keys: tuple[str, ...] = ("symbol",)
) -> DataFrame:
    """Per symbol (and session): the first tick two windows past the minute of the first arrival.

    ``until`` is that tick's minute. Ticks shrink to one row per minute before anything else,
    since within a minute only the earliest arrival matters; the first minute of a key is then
    joined back. Both steps combine map-side, so no task sees all minutes of a symbol.
    """
    minutes = (
        ticks.withColumn("minute", bucket_start(F.col("timestamp"), MINUTE_MS))
        .groupBy(*keys, "minute")
        .agg(F.min("arrival").alias("arrival"))
    )
    begin = minutes.groupBy(*keys).agg(F.min_by("minute", "arrival").alias("first_minute"))
    due = minutes.join(begin, list(keys)).filter(F.col("minute") >= F.col("first_minute") + F.lit(2 * size_ms))
    return due.groupBy(*keys, "first_minute").agg(
        F.min_by("minute", "arrival").alias("until"), F.min("arrival").alias("fired_at")
    )


def readiness_report(
    requested: DataFrame, signals: DataFrame, *, timeout_s: int = READY_TIMEOUT_S
) -> DataFrame:
    """Per requested symbol: how long its first signal took and whether it came in time.

    ``requested`` holds (symbol, started_ms), ``signals`` (symbol, ready_ms) in any number.
    """
    first = (
        signals.join(requested, "symbol")
        .filter(F.col("ready_ms") >= F.col("started_ms"))
        .groupBy("symbol")
        .agg(F.min("ready_ms").alias("ready_ms"))
    )
    report = requested.join(first, "symbol", "left").withColumn(
        "elapsed_ms", F.col("ready_ms") - F.col("started_ms")
    )
    in_time = F.coalesce(F.col("elapsed_ms") <= F.lit(timeout_s * 1000), F.lit(False))
    return report.select(
        "symbol",
        "started_ms",
        F.when(in_time, F.col("elapsed_ms")).alias("elapsed_ms"),
        in_time.alias("ready"),
    )


def pending_symbols(
    requested: DataFrame, signals: DataFrame, *, timeout_s: int = READY_TIMEOUT_S
) -> DataFrame:
    """Requested symbols without a signal inside the timeout."""
    return readiness_report(requested, signals, timeout_s=timeout_s).filter("not ready").select("symbol")


def readiness_problem(report: DataFrame) -> DataFrame:
    """One row with ``problem``: the pending symbols in order and the slowest signal that came in
    time, or null where every symbol is ready."""
    late = F.array_sort(F.collect_list(F.when(~F.col("ready"), F.col("symbol"))))
    return report.agg(late.alias("pending"), F.max("elapsed_ms").alias("slowest")).select(
        F.when(
            F.size("pending") > 0,
            F.concat(
                F.lit("not ready: "), F.array_join("pending", ", "),
                F.lit("; slowest ready after ms: "), F.coalesce(F.col("slowest").cast("string"), F.lit("none")),
            ),
        ).alias("problem")
    )


def require_ready(report: DataFrame) -> DataFrame:
    """The report, which fails as soon as it is read if a symbol is not ready; the error is the
    ``readiness_problem``."""
    problem = readiness_problem(report).scalar()
    return report.filter(F.when(problem.isNull(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean")))
