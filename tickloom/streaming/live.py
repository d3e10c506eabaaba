"""Readiness, the subscription registry and the wait for symbols as streams.

Each keeps a few numbers per symbol as state. Records that belong together reach one operator under
the key of their symbol, so a hot symbol costs its own rows, never another's. Rows of a micro-batch
are put in order of arrival inside the operator; that takes 17 bytes a row, so bound the micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickloom.operators.readiness import MINUTE_MS
from tickloom.schema import READY_TIMEOUT_S, WINDOW_MS

TRIGGERED = "symbol string, session bigint, first_minute bigint, until bigint, fired_at bigint"
AUDITED = "seq bigint, action string, symbol string, is_noop boolean"
WAITED = "run string, symbol string, started_ms bigint, elapsed_ms bigint, ready boolean"


def _in_order(rows: Iterator[pd.DataFrame], *columns: str) -> list[np.ndarray]:
    """Columns of all rows of a key, ordered by the first of them."""
    parts = [[chunk[c].to_numpy() for c in columns] for chunk in rows]
    whole = [np.concatenate(p) for p in zip(*parts, strict=True)]
    order = np.argsort(whole[0], kind="stable")
    return [c[order] for c in whole]


class ReadinessProcessor(StatefulProcessor):
    """Ticks and resets of a symbol in, one row per session in which the trigger fires."""

    def __init__(self, size_ms: int):
        self._size = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("session", "session bigint, first_minute bigint, fired boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (symbol,) = key
        arrival, timestamp, reset = _in_order(rows, "arrival", "timestamp", "reset")
        session, first, fired = self._state.get() if self._state.exists() else (0, None, False)
        minute = timestamp // MINUTE_MS * MINUTE_MS
        out = []
        at = 0
        for cut in [*np.flatnonzero(reset).tolist(), len(reset)]:
            if at < cut and first is None:
                first = int(minute[at])
            if at < cut and not fired:
                due = np.flatnonzero(minute[at:cut] >= first + 2 * self._size)
                if len(due):
                    place = at + due[0]
                    out.append((symbol, session, first, int(minute[place]), int(arrival[place])))
                    fired = True
            if cut < len(reset):
                session, first, fired = session + 1, None, False
            at = cut + 1
        self._state.update((session, first, fired))
        if out:
            yield pd.DataFrame(out, columns=["symbol", "session", "first_minute", "until", "fired_at"])

    def close(self) -> None:
        pass


def stream_readiness(ticks: DataFrame, resets: DataFrame, *, size_ms: int = WINDOW_MS) -> DataFrame:
    """``readiness_trigger`` per (symbol, session) as it happens.

    ``ticks`` has ``symbol, timestamp, arrival``, ``resets`` has ``symbol, arrival``: a row per reconnect
    of the symbol's connection or unsubscribe, positioned among the ticks. A reset forgets the first
    minute, so the trigger can fire again. Records without a symbol, such as heartbeats, are left out.
    """
    marked = ticks.filter("symbol is not null").select("symbol", "arrival", "timestamp", F.lit(False).alias("reset"))
    cleared = resets.select("symbol", "arrival", F.lit(0).cast("long").alias("timestamp"), F.lit(True).alias("reset"))
    return (
        marked.unionByName(cleared)
        .groupBy("symbol")
        .transformWithStateInPandas(ReadinessProcessor(size_ms), TRIGGERED, "Append", "None")
    )


class SubscriptionProcessor(StatefulProcessor):
    """Requests of a symbol in, the same flagged out; state exists while the symbol is subscribed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._since = handle.getValueState("subscribed", "seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (symbol,) = key
        seq, action = _in_order(rows, "seq", "action")
        since = self._since.get()[0] if self._since.exists() else None
        noop = []
        for place, asked in zip(seq.tolist(), action, strict=True):
            noop.append((asked == "subscribe") == (since is not None))
            if not noop[-1]:
                since = place if asked == "subscribe" else None
        if since is None:
            self._since.clear()
        else:
            self._since.update((since,))
        yield pd.DataFrame({"seq": seq, "action": action, "symbol": symbol, "is_noop": noop})

    def close(self) -> None:
        pass


def stream_subscriptions(log: DataFrame) -> DataFrame:
    """``subscription_audit`` of a stream of requests (seq, action, symbol), with the registry as state."""
    requests = log.select("seq", "action", F.upper("symbol").alias("symbol"))
    return requests.groupBy("symbol").transformWithStateInPandas(SubscriptionProcessor(), AUDITED, "Append", "None")


def list_subscriptions(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """``symbol, since`` subscribed after a micro-batch of ``stream_subscriptions``, the last by default.

    Reads the state that the stream left in its checkpoint; the stream may be running.
    """
    reader = spark.read.format("statestore").option("stateVarName", "subscribed")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select(F.col("key.symbol").alias("symbol"), F.col("value.seq").alias("since"))


class WaitProcessor(StatefulProcessor):
    """A request and signals of one (run, symbol) in; out comes whether a signal came in time."""

    def __init__(self, timeout_ms: int):
        self._timeout = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getValueState("waiting", "started bigint, ended boolean")

    def _result(self, key, started: int, elapsed: int | None) -> pd.DataFrame:
        self._waiting.update((started, True))
        run, symbol = key
        out = pd.DataFrame({"run": [run], "symbol": [symbol], "started_ms": [started]})
        out["elapsed_ms"] = pd.array([elapsed], dtype="Int64")
        return out.assign(ready=elapsed is not None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[1] is None:
            for _ in rows:
                pass
            return
        at, request = _in_order(rows, "at", "request")
        started, ended = self._waiting.get() if self._waiting.exists() else (None, False)
        if started is None:
            if not request.any():
                return  # a signal that nobody waits for
            started = int(at[request][0])
            self._waiting.update((started, False))
            self._handle.registerTimer(started + self._timeout)
        signals = at[~request]
        signals = signals[signals >= started]
        if not ended and len(signals):
            elapsed = int(signals[0]) - started
            yield self._result(key, started, elapsed if elapsed <= self._timeout else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        started, ended = self._waiting.get()
        if not ended:
            yield self._result(key, int(started), None)

    def close(self) -> None:
        pass


def stream_waiting(
    records: DataFrame, *, timeout_s: int = READY_TIMEOUT_S, clock: str = "processing", delay_ms: int = 0
) -> DataFrame:
    """One row per requested (run, symbol), as soon as it is ready or its time is up.

    ``records`` has ``run, symbol, at, request``: a request where the flag is set, else a signal, at a
    moment in ms. With the ``processing`` clock the timeout passes by itself, which is what a live run
    needs; with ``event`` it passes with the records, those without a symbol among them, which only
    move the clock. A signal before its request does not count.
    """
    if clock == "event":
        records = records.withColumn("event_time", F.timestamp_millis("at")).withWatermark("event_time", f"{delay_ms} milliseconds")
    mode = {"processing": "ProcessingTime", "event": "EventTime"}[clock]
    return (
        records.select("run", "symbol", "at", "request")
        .groupBy("run", "symbol")
        .transformWithStateInPandas(WaitProcessor(timeout_s * 1000), WAITED, "Append", mode)
    )


def require_all_ready(
    waited: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None, name: str = "readiness"
) -> StreamingQuery:
    """Append the rows of ``stream_waiting`` to ``path``; the first timeout fails the stream.

    The error names the symbols whose time was up in that micro-batch, in order, and the slowest
    signal among those in ``path`` that came in time. Rows are stored first, so nothing is lost.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            spark = batch.sparkSession
            batch.write.mode("append").parquet(path)
            late = [r.symbol for r in batch.filter("not ready").select("symbol").distinct().orderBy("symbol").toLocalIterator()]
            if late:
                slowest = spark.read.schema(WAITED).parquet(path).agg(F.max("elapsed_ms")).first()[0]
                raise TimeoutError(f"not ready: {', '.join(late)}; slowest ready after ms: {'none' if slowest is None else slowest}")
        finally:
            batch.unpersist()

    writer = waited.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(check).trigger(**(trigger or {"processingTime": "1 second"})).start()
