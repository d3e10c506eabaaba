"""The backfill job end to end, and shapes of plans the pipelines rely on."""

import os
import zipfile
from types import SimpleNamespace

import pytest
from conftest import record_frame, tick
from pyspark.sql import functions as F

from tickloom.jobs.backfill import run_backfill
from tickloom.operators.candles import candles
from tickloom.operators.late import flag_late
from tickloom.sinks.candle_table import read_candles
from tickloom.sources import adapters as A
from tickloom.sources.topic import kafka_topics
from tickloom.streaming.candles import stream_candles

HEADER = "open_time,open,high,low,close,volume,close_time,count"


def archive(base, interval, symbol, date, starts):
    folder = f"{base}/{interval}/klines/{symbol}/1m"
    os.makedirs(folder, exist_ok=True)
    rows = [f"{s},1,2,0.5,1.5,3,{s + 59999},4" for s in starts]
    with zipfile.ZipFile(f"{folder}/{symbol}-1m-{date}.zip", "w") as z:
        z.writestr("data.csv", "\n".join([HEADER, *rows]))


def test_backfill_job(spark, run_dir):
    base, table = f"{run_dir}/archives", f"{run_dir}/table"
    january = 1704067200000
    archive(base, "monthly", "AAA", "2024-01", range(january, january + 600_000, 60_000))
    archive(base, "daily", "AAA", "2024-02-01", [january + 31 * 86_400_000])
    archive(base, "daily", "AAA", "2024-02-03", [0])  # not in the plan
    archive(base, "daily", "BBB", "2024-02-01", [0])  # not asked for
    ranges = spark.sql("SELECT 'AAA' AS symbol, DATE'2024-01-01' AS start_date, DATE'2024-02-03' AS end_date")
    report = run_backfill(spark, ranges, base, table)
    assert {(r.date, r.status, r.rows) for r in report.collect()} == {
        ("2024-01", "ok", 10), ("2024-02-01", "ok", 1), ("2024-02-02", "missing", 0)
    }
    stored = read_candles(spark, table)
    assert {(r.symbol, r.month, r["count"]) for r in stored.groupBy("symbol", "month").count().collect()} == {
        ("AAA", 202401, 10), ("AAA", 202402, 1)
    }


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_filter_stays_above_the_watermark(spark):
    records = spark.readStream.format("rate").load().select(
        F.lit("tick").alias("kind"), F.lit("A").alias("symbol"), F.lit(1).cast("decimal(18,8)").alias("price"),
        F.lit(1).cast("decimal(18,8)").alias("quantity"), F.col("value").alias("timestamp"),
        F.col("value").alias("trade_id"), F.col("value").alias("arrival"),
    ).withColumn("kind", F.when(F.col("timestamp") % 2 == 0, "heartbeat").otherwise("tick"))
    analyzed = stream_candles(records)._jdf.queryExecution().analyzed()
    plan = spark._jsparkSession.sessionState().optimizer().execute(analyzed).toString().split("\n")
    depth = {name: next(i for i, line in enumerate(plan) if name in line) for name in ("EventTimeWatermark", "Filter")}
    assert depth["Filter"] < depth["EventTimeWatermark"]


def test_candle_scan_reads_only_what_it_needs(spark):
    events = A.table(spark, "/root/testdata/sf0.001", "events")
    plan = physical(candles(A.ticks_from_events(events), dedup=False))
    assert "user_id" not in plan.split("ReadSchema")[1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_colocated_layout_shuffles_once(spark):
    frame = record_frame(spark, [tick(1, 1, 1, 1)])
    assert physical(candles(frame, layout="colocated")).count("Exchange hashpartitioning") == 1
    assert physical(candles(frame)).count("Exchange hashpartitioning") == 2


def test_late_flags_scan_their_source_twice(spark, run_dir):
    ticks = [tick(1000 * i, 10, 1, i, symbol="AB"[i % 2]) for i in range(50)]
    record_frame(spark, ticks).write.parquet(f"{run_dir}/records")
    flagged = flag_late(spark.read.parquet(f"{run_dir}/records"), block=8)
    assert flagged.count() == 50
    flagged.collect()
    plan = flagged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 2 and "ReusedExchange" in plan


class Reader:
    """Takes the options of a stream reader."""

    def __init__(self):
        self.given = {}

    def format(self, name):
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def options(self, **given):
        self.given |= given
        return self

    def load(self):
        return self.given


def test_micro_batches_are_bounded_both_ways():
    session = SimpleNamespace(readStream=Reader())
    given = kafka_topics(session, "h:1", max_offsets_per_trigger=9, min_offsets_per_trigger=100, max_trigger_delay="50ms")
    bounds = {k: given[k] for k in ("maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay")}
    assert bounds == {"maxOffsetsPerTrigger": 9, "minOffsetsPerTrigger": 100, "maxTriggerDelay": "50ms"}
    plain = kafka_topics(SimpleNamespace(readStream=Reader()), "h:1")
    assert not [name for name in plain if name.endswith("Trigger") or name == "maxTriggerDelay"]
    with pytest.raises(ValueError, match="min_offsets"):
        kafka_topics(SimpleNamespace(readStream=Reader()), "h:1", max_trigger_delay="50ms")
