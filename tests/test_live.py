"""Live operators over several micro-batches: readiness, registry, waiting, rejected ticks, summaries."""

import random
import tempfile
import time

import numpy as np
import pytest
from conftest import Replay, heartbeat, record_frame, tick
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickloom import suite
from tickloom.operators import readiness
from tickloom.operators.candles import candles
from tickloom.operators.gapfill import candles_filled
from tickloom.session import streaming_session
from tickloom.sinks import candle_table
from tickloom.sources.topic import file_topics, parse_records
from tickloom.streaming import live
from tickloom.streaming.candles import candle_rows, late_rows, stream_candles_and_late, stream_candles_by_symbol
from tickloom.streaming.processors import IdRanges

MINUTE = 60_000


class Feed:
    """Rows as a stream, one micro-batch per list."""

    def __init__(self, spark, schema, *batches):
        self.spark, self.schema = streaming_session(spark, 2), schema
        self.folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{self.folder}/in/run-{i:03d}")

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in/run-*")

    def finish(self, out):
        writer = out.writeStream.format("parquet").option("path", f"{self.folder}/out").option("checkpointLocation", f"{self.folder}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
        return self.spark.read.schema(out.schema).parquet(f"{self.folder}/out")


def test_id_ranges_are_a_set():
    rng = random.Random(3)
    for spread in (30, 400, 10**12):
        have, ranges = set(), IdRanges()
        for _ in range(40):
            ids = np.unique([rng.randrange(-spread, spread) for _ in range(rng.randrange(12))]).astype("int64")
            assert ranges.holds(ids).tolist() == [int(i) in have for i in ids]
            fresh = ids[~ranges.holds(ids)]
            ranges = ranges.with_new(fresh)
            have |= {int(i) for i in fresh}
        low, high = ranges.bounds[::2], ranges.bounds[1::2]
        assert (low < high).all() and (high[:-1] < low[1:]).all() and int((high - low).sum()) == len(have)


READY = "symbol string, timestamp long, arrival long, reset boolean"


def test_readiness_over_micro_batches_equals_batch(spark):
    rng = random.Random(9)
    rows, clock = [], 0
    for i in range(600):
        clock += rng.choice([500, 9_000, 40_000])
        rows.append((rng.choice("XYZ"), clock - rng.randrange(30_000), i, rng.random() < 0.05))
    shuffled = [rows[i : i + 75] for i in range(0, 600, 75)]
    for part in shuffled:
        rng.shuffle(part)
    feed = Feed(spark, READY, *shuffled)
    records = feed.stream()
    got = feed.finish(live.stream_readiness(records.filter("not reset"), records.filter("reset")))
    frame = spark.createDataFrame(rows, READY)
    sessions = readiness.with_session(frame.filter("not reset").drop("reset"), frame.filter("reset").select("symbol", "arrival"))
    want = readiness.readiness_trigger(sessions, keys=("symbol", "session"))
    key = lambda r: tuple(r[c] for c in ("symbol", "session", "first_minute", "until", "fired_at"))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_readiness_golden(spark):
    feed = Feed(
        spark, READY,
        [("X", 61_000, 1, False), ("X", 0, 3, True), ("Y", 5_000, 2, False)],  # the reset forgets minute 1
        [("X", 121_000, 4, False), ("X", 179_999, 5, False), ("Y", 119_999, 6, False)],
        [("X", 240_000, 7, False), ("X", 300_000, 8, False), ("Z", 0, 9, True)],
    )
    records = feed.stream()
    got = feed.finish(live.stream_readiness(records.filter("not reset"), records.filter("reset"))).collect()
    assert [tuple(r) for r in got] == [("X", 1, 120_000, 240_000, 7)]


LOG = "seq long, action string, symbol string"


def test_registry_after_each_batch(spark):
    batches = [
        [(1, "subscribe", "a"), (2, "subscribe", "b"), (3, "subscribe", "A")],
        [(4, "unsubscribe", "a"), (5, "unsubscribe", "c")],
        [(7, "unsubscribe", "b"), (6, "subscribe", "a"), (8, "subscribe", "b")],
    ]
    feed = Feed(spark, LOG, *batches)
    audit = feed.finish(live.stream_subscriptions(feed.stream()))
    assert {r.seq for r in audit.filter("is_noop").collect()} == {3, 5}
    listed = [{tuple(r) for r in live.list_subscriptions(spark, f"{feed.folder}/checkpoint", i).collect()} for i in range(3)]
    assert listed == [{("A", 1), ("B", 2)}, {("B", 2)}, {("A", 6), ("B", 8)}]
    assert {tuple(r) for r in live.list_subscriptions(spark, f"{feed.folder}/checkpoint").collect()} == listed[-1]


WAIT = "run string, symbol string, at long, request boolean"


def test_waiting_on_the_event_clock(spark):
    feed = Feed(
        spark, WAIT,
        [("r", "IN", 1_000, True), ("r", "LATE", 1_000, True), ("r", "SILENT", 2_000, True), ("r", "EARLY", 5_000, True), ("q", "IN", 1_000, True), ("r", "ASKED-BY-NOBODY", 900, False)],
        [("r", "IN", 11_000, False), ("r", "EARLY", 4_000, False), ("r", "IN", 12_000, False)],
        [("r", "LATE", 11_001, False), ("r", None, 30_000, False)],
        [("r", "SILENT", 30_500, False)],
    )
    got = feed.finish(live.stream_waiting(feed.stream(), timeout_s=10, clock="event")).collect()
    assert sorted((r.run, r.symbol, r.elapsed_ms, r.ready) for r in got) == [
        ("q", "IN", None, False), ("r", "EARLY", None, False), ("r", "IN", 10_000, True), ("r", "LATE", None, False), ("r", "SILENT", None, False),
    ]


def test_a_silent_symbol_fails_the_wait_by_itself(spark):
    now = int(time.time() * 1000)
    feed = Feed(spark, WAIT, [("r", s, now, True) for s in ("B", "A", "C")], [("r", "C", now + 7, False)])
    waiting = live.stream_waiting(feed.stream(), timeout_s=2)
    running = live.require_all_ready(waiting, f"{feed.folder}/out", f"{feed.folder}/checkpoint", trigger={"processingTime": "1 second"})
    with pytest.raises(StreamingQueryException, match="not ready: A, B; slowest ready after ms: 7"):
        running.awaitTermination(90)
    assert {(r.symbol, r.ready) for r in spark.read.schema(live.WAITED).parquet(f"{feed.folder}/out").collect()} == {("A", False), ("B", False), ("C", True)}


def test_rejected_ticks_leave_by_the_second_door(spark, run_dir):
    batches = [
        [tick(1000, 10, 1, 1), tick(1000, 5, 1, 1, "OLD")], [heartbeat(60501)],
        [tick(59000, 99, 1, 2), tick(59000, 99, 1, 2), tick(61000, 20, 1, 3), tick(-5, 1, 1, 4, "NEW")], [heartbeat(120501)],
    ]
    feed = Replay(spark, run_dir, None).feed(*batches)
    records = parse_records(file_topics(feed.spark, f"{run_dir}/topic/*", max_files_per_trigger=1))
    out, late, logged = (f"{run_dir}/{name}" for name in ("candles", "late", "summaries"))
    running = candle_table.stream_to_tables(
        stream_candles_and_late(records), out, late, f"{run_dir}/checkpoint", trigger={"availableNow": True}, summaries=logged
    )
    running.awaitTermination()
    got = candle_table.read_candles(spark, out)
    assert sorted((r.symbol, r.start, int(r.close), r.trades) for r in got.collect()) == [
        ("OLD", 0, 5, 1), ("OLD", 60000, 5, 0), ("X", 0, 10, 1), ("X", 60000, 20, 1),
    ]
    rejected = sorted((r.symbol, r.trade_id, r.timestamp, r.start, r.bound) for r in spark.read.parquet(late).collect())
    assert rejected == [("NEW", 4, -5, -60000, 0), ("X", 2, 59000, 0, 60000), ("X", 2, 59000, 0, 60000)]
    total = candle_table.summary_of(candle_table.read_summaries(spark, logged)).first()
    assert tuple(total) == ("OLD,X", 4, "1970-01-01T00:00:00+00:00", "1970-01-01T00:02:00+00:00")


def test_without_rejected_ticks_their_table_is_empty(spark, run_dir):
    feed = Replay(spark, run_dir, None).feed([tick(1000, 10, 1, 1)], [heartbeat(60501)], [heartbeat(60502)])
    records = parse_records(file_topics(feed.spark, f"{run_dir}/topic/*", max_files_per_trigger=1))
    for _ in range(2):  # a restart leaves the table as it is
        candle_table.stream_to_tables(
            stream_candles_and_late(records), f"{run_dir}/out", f"{run_dir}/late", f"{run_dir}/checkpoint", trigger={"availableNow": True}
        ).awaitTermination()
        late = spark.read.parquet(f"{run_dir}/late")
        assert late.columns == ["symbol", "trade_id", "timestamp", "arrival", "start", "bound", "batch_id"] and late.isEmpty()
    assert candle_table.read_candles(spark, f"{run_dir}/out").count() == 1


def test_landed_runs_have_several_files_and_are_one_micro_batch_each(spark, run_dir, monkeypatch):
    monkeypatch.setattr(suite, "FILE_ROWS", 10)
    place = list(range(200)) + [790] * 5  # uneven: three runs hold rows, of them the last few
    rows = spark.createDataFrame([(p, f"S{p % 7}") for p in place], "place long, symbol string")
    stream = suite._follow(spark, rows, "place", f"{run_dir}/in")
    assert {len(spark.read.schema(rows.schema).parquet(f"{run_dir}/in/run-{i:03d}").inputFiles()) for i in range(8)} == {10}
    batches = {}
    writer = stream.writeStream.foreachBatch(lambda batch, i: batches.update({i: sorted(r.place for r in batch.collect())}))
    writer.option("checkpointLocation", f"{run_dir}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert batches == {i: [p for p in place if p * 8 // 791 == i] for i in range(8)}


def test_hot_symbol_keeps_ranges_not_ids(spark, run_dir):
    """Gapless ids with repeats and disorder: the same candles as in batch, a handful of bounds as state."""
    rng = random.Random(1)
    records = [tick(10_000 + 20 * i, 1 + i % 90, 1, 5_000_000 + i, "HOT") for i in range(3_000)]
    again = [tick(10_000 + 20 * i, 7, 1, 5_000_000 + i, "HOT") for i in rng.sample(range(2_400), 300)]
    order = list(range(600))
    batches = []
    for b in range(5):
        rng.shuffle(order)
        batches.append([records[600 * b + i] for i in order] + again[60 * b : 60 * b + 60] * (b == 4))
    replay = Replay(spark, run_dir, stream_candles_by_symbol).feed(*batches).run()
    state = spark.read.format("statestore").option("stateVarName", "ids").load(f"{run_dir}/checkpoint")
    bounds = [len(r.n.bounds) for r in state.select(F.col("user_map_value").alias("n")).collect()]
    assert 1 <= len(bounds) <= 4 and sum(bounds) <= 8
    replay.feed([heartbeat(200_000)], [heartbeat(200_001)]).run()
    flat = [r for batch in [*batches, [heartbeat(200_000)]] for r in batch]
    want = candles_filled(record_frame(spark, flat), horizon_ms=F.lit(199_500).cast("long")).collect()
    assert replay.rows() == sorted(tuple(str(v) if hasattr(v, "as_tuple") else v for v in row) for row in want)
    assert spark.read.format("statestore").option("stateVarName", "ids").load(f"{run_dir}/checkpoint").count() == 0


def test_append_returns_its_summary(spark, run_dir):
    made = candles(record_frame(spark, [tick(1000, 10, 1, 1), tick(61_000, 10, 1, 2, "Y"), tick(62_000, 10, 1, 3, "Y")]))
    got = candle_table.append_candles(made, f"{run_dir}/t")
    want = candle_table.write_summary(made).first()
    assert tuple(got[c] for c in ("symbols", "count", "start", "end")) == tuple(want) and got["write_ms"] >= 0
    assert candle_table.append_candles(made.limit(0), f"{run_dir}/t") is None
    assert candle_table.read_candles(spark, f"{run_dir}/t").count() == 2


def test_tagged_rows_come_apart(spark):
    columns = "tag string, symbol string, start bigint, open bigint, high bigint, low bigint, close bigint, volume bigint, trades bigint, trade_id bigint, timestamp bigint, arrival bigint, bound bigint"
    rows = [("candle", "X", 0, 10**8, 10**8, 10**8, 10**8, 10**8, 1, 0, 0, 0, 0), ("late", "X", 0, 0, 0, 0, 0, 0, 0, 4, 5, 6, 60_000)]
    tagged = spark.createDataFrame(rows, columns)
    assert [(r.end, int(r.open), r.trades) for r in candle_rows(tagged).collect()] == [(60_000, 1, 1)]
    assert [tuple(r) for r in late_rows(tagged).collect()] == [("X", 4, 5, 6, 0, 60_000)]


def test_a_batch_that_failed_after_its_write_counts_once(spark, run_dir, monkeypatch):
    feed = Replay(spark, run_dir, None).feed([tick(1000, 10, 1, 1)], [heartbeat(60501)], [tick(61000, 20, 1, 2)], [heartbeat(120501)])
    log, calls = candle_table.log_summary, []

    def fails_once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise OSError("lost before the checkpoint")
        log(*args)

    monkeypatch.setattr(candle_table, "log_summary", fails_once)

    def run(named, out):
        records = parse_records(file_topics(feed.spark, f"{run_dir}/topic/*", max_files_per_trigger=1))
        running = candle_table.stream_to_table(
            stream_candles_by_symbol(records), f"{run_dir}/{out}", f"{run_dir}/check-{out}", trigger={"availableNow": True}, summaries=f"{run_dir}/s-{out}", named=named
        )
        running.awaitTermination()

    for named, out, starts in ((True, "named", [0, 60000]), (False, "plain", [0, 0, 60000])):
        calls.clear()
        with pytest.raises(StreamingQueryException):
            run(named, out)
        run(named, out)
        found = candle_table.read_candles(spark, f"{run_dir}/{out}")
        assert sorted(r.start for r in found.collect()) == starts and found.filter("month = 197001 and symbol = 'X'").count() == len(starts)


def test_spans_come_from_footers(spark, run_dir):
    records = [tick(1000, 10, 1, 1), tick(61_000, 10, 1, 2, "Y"), tick(200_000, 10, 1, 3, "Y"), tick(3_000_000_000, 10, 1, 4, "Y")]
    made = candles(record_frame(spark, records))
    candle_table.append_candles(made, f"{run_dir}/t")
    spans = candle_table.candle_spans(spark, f"{run_dir}/t")
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(start), MAX(start)]" in plan, plan
    want = made.groupBy("symbol").agg(F.count("*"), F.min("start"), F.max("start")).collect()
    assert sorted(map(tuple, spans.collect())) == sorted(map(tuple, want))
