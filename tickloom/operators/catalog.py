"""The symbol catalog: (symbol, state), one row per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Catalog states.
UNAVAILABLE = "unavailable"
AVAILABLE = "available"


def _requested(symbols: DataFrame) -> DataFrame:
    return symbols.select("symbol").distinct().withColumn("_requested", F.lit(True))


def catalog_upsert(catalog: DataFrame, symbols: DataFrame) -> DataFrame:
    """Set requested symbols to unavailable, adding those the catalog lacks. Spelling is kept."""
    merged = catalog.join(_requested(symbols), "symbol", "full")
    state = F.when(F.col("_requested"), F.lit(UNAVAILABLE)).otherwise(F.col("state"))
    return merged.select("symbol", state.alias("state"))


def catalog_mark_available(
    catalog: DataFrame, symbols: DataFrame, gate: Column | None = None
) -> DataFrame:
    """Set requested symbols the catalog has to available; none is added.

    ``gate`` is a scalar condition for the whole run, such as ``onboarding_done``.
    """
    merged = catalog.join(_requested(symbols), "symbol", "left")
    update = F.coalesce(F.col("_requested"), F.lit(False))
    if gate is not None:
        update = update & gate
    return merged.select("symbol", F.when(update, F.lit(AVAILABLE)).otherwise(F.col("state")).alias("state"))


def onboarding_done(readiness: DataFrame, jobs: DataFrame) -> Column:
    """True where every symbol is ready and every backfill job ended without error.

    ``readiness`` has a boolean ``ready`` per symbol, ``jobs`` a boolean ``ok`` per job. A file
    that failed inside a job does not fail the job.
    """
    ready = readiness.agg(F.coalesce(F.bool_and("ready"), F.lit(True)).alias("done")).scalar()
    ended = jobs.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("done")).scalar()
    return ready & ended
