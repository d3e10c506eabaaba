"""Golden cases on the streaming pipelines: window 60 s, delay 0.5 s."""

import random

import pytest
from conftest import Replay, heartbeat, record_frame, tick
from pyspark.sql import functions as F

from tickloom.operators.gapfill import candles_filled
from tickloom.streaming.candles import stream_candles, stream_candles_by_symbol, stream_candles_filled

FILLED = [stream_candles_by_symbol, stream_candles_filled]


def replay(spark, run_dir, pipeline, *batches):
    return Replay(spark, run_dir, pipeline).feed(*batches).run()


@pytest.mark.parametrize("pipeline", [*FILLED, stream_candles])
def test_one_window_with_ties_disorder_and_duplicates(spark, run_dir, pipeline):
    first = [
        tick(1000, 10, 1, 1, "BASIC"), tick(2000, 12, 2, 2, "BASIC"), tick(59999, 11, 1, 3, "BASIC"),
        tick(1000, 10, 1, 1, "TIES"), tick(1000, 9, 1, 2, "TIES"),
        tick(30000, 11, 1, 1, "DISORDER"), tick(1000, 10, 1, 2, "DISORDER"), tick(20000, 15, 1, 3, "DISORDER"),
        tick(1000, 10, 1, 1, "DUPLICATE"), tick(2000, 99, 1, 1, "DUPLICATE"),
    ]
    second = [tick(61000, 20, 1, 1, "DUPLICATE"), tick(5000, 11, 1, 3, "TIES"), tick(5000, 12, 1, 4, "TIES"), tick(3000, 98, 1, 1, "DUPLICATE")]
    r = replay(spark, run_dir, pipeline, first, second, [heartbeat(60501)], [heartbeat(120501)])
    assert r.short("BASIC")[0] == (0, 10, 12, 10, 11, 4, 3)
    assert r.short("TIES")[0] == (0, 10, 12, 9, 11, 4, 4)
    assert r.short("DISORDER")[0] == (0, 10, 15, 10, 11, 3, 3)
    assert r.short("DUPLICATE") == [(0, 10, 10, 10, 10, 1, 1), (60000, 20, 20, 20, 20, 1, 1)]


@pytest.mark.parametrize("pipeline", FILLED)
def test_gap_fill_late_tick_and_two_open_windows(spark, run_dir, pipeline):
    r = replay(
        spark, run_dir, pipeline,
        [tick(1000, 10, 1, 1, "GAP"), tick(1000, 10, 1, 1, "LATE"), tick(59000, 10, 1, 1, "TWO"),
         tick(60100, 20, 1, 2, "TWO"), tick(59500, 11, 1, 3, "TWO")],
        [heartbeat(60501)],
        [heartbeat(60502)],
        [tick(59000, 99, 1, 2, "LATE")],
        [heartbeat(120501)],
        [heartbeat(240501)],
    )
    assert r.short("GAP") == [(0, 10, 10, 10, 10, 1, 1)] + [(s, 10, 10, 10, 10, 0, 0) for s in (60000, 120000, 180000)]
    assert r.short("LATE")[:2] == [(0, 10, 10, 10, 10, 1, 1), (60000, 10, 10, 10, 10, 0, 0)]
    assert r.short("TWO")[:2] == [(0, 10, 11, 10, 11, 2, 2), (60000, 20, 20, 20, 20, 1, 1)]
    ends = {(row[1], row[2]) for row in r.rows()}
    assert all(end == start + 60000 for start, end in ends)


def test_first_tick_older_than_the_watermark(spark, run_dir):
    batches = ([tick(250000, 7, 1, 1, "OTHER")], [heartbeat(250000)], [tick(1000, 5, 1, 1)], [heartbeat(300501)])
    r = replay(spark, run_dir, stream_candles_by_symbol, *batches)
    assert r.short() == [(0, 5, 5, 5, 5, 1, 1)] + [(s, 5, 5, 5, 5, 0, 0) for s in range(60000, 300000, 60000)]


def test_tick_right_after_the_sealing_heartbeat_is_late(spark, run_dir):
    batches = ([tick(1000, 10, 1, 1)], [heartbeat(60501)], [tick(59000, 99, 1, 2)], [heartbeat(120501)])
    r = replay(spark, run_dir, stream_candles_by_symbol, *batches)
    assert r.short() == [(0, 10, 10, 10, 10, 1, 1), (60000, 10, 10, 10, 10, 0, 0)]


@pytest.mark.parametrize("pipeline", FILLED)
def test_no_ticks_no_rows(spark, run_dir, pipeline):
    r = replay(spark, run_dir, pipeline, [heartbeat(600000)], [heartbeat(700000)])
    assert r.rows() == []


@pytest.mark.parametrize("pipeline", FILLED)
def test_stream_equals_batch(spark, run_dir, pipeline):
    """Disorder inside the delay, several micro-batches, a closing heartbeat."""
    rng = random.Random(5)
    records, clock = [], 10_000
    for _ in range(300):
        clock += rng.choice([200, 4_000, 9_000])
        records.append(
            tick(clock - rng.randrange(400), rng.randrange(1, 999) / 100, rng.randrange(1, 9), rng.randrange(60), rng.choice("XYZ"))
        )
    records += [heartbeat(clock + 400_000)]
    r = replay(spark, run_dir, pipeline, records[:100], records[100:200], records[200:])
    horizon = F.lit(clock + 400_000 - 500).cast("long")
    batch = candles_filled(record_frame(spark, records), horizon_ms=horizon).collect()
    expected = sorted(tuple(str(v) if hasattr(v, "as_tuple") else v for v in row) for row in batch)
    assert r.rows() == expected
