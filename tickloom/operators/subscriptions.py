"""The subscription registry as a fold over its event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.blocks import BLOCK, with_neighbour


def subscription_audit(log: DataFrame, *, block: int | list[float] = BLOCK) -> DataFrame:
    """Flag requests that change nothing.

    ``log`` holds (seq, action, symbol). Subscribing a known symbol and unsubscribing an unknown
    one are no-ops; symbols are upper-cased as the registry does.
    """
    events = log.select("seq", "action", F.upper("symbol").alias("symbol"))
    linked = with_neighbour(
        events, "_before", "action", order="seq", keys=("symbol",), offset=-1, block=block
    )
    known = F.coalesce(F.col("_before") == "subscribe", F.lit(False))
    return linked.select(
        "seq", "action", "symbol", ((F.col("action") == "subscribe") == known).alias("is_noop")
    )


def active_symbols(log: DataFrame) -> DataFrame:
    """Symbols subscribed at the end of the log."""
    last = log.groupBy(F.upper("symbol").alias("symbol")).agg(
        F.max(F.when(F.col("action") == "subscribe", F.col("seq"))).alias("_on"),
        F.max(F.when(F.col("action") == "unsubscribe", F.col("seq"))).alias("_off"),
    )
    is_on = F.col("_on").isNotNull() & (F.col("_off").isNull() | (F.col("_on") > F.col("_off")))
    return last.filter(is_on).select("symbol")
