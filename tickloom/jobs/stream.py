"""Topics to the candle table, until stopped.

``spark-submit --packages <kafka connector> -m tickloom.jobs.stream --bootstrap-servers HOST:PORT
--table DIR --checkpoint DIR``
"""

from __future__ import annotations

import argparse

from tickloom.schema import WATERMARK_DELAY_MS, WINDOW_MS
from tickloom.session import build_session, streaming_session
from tickloom.sinks.candle_table import stream_to_table, stream_to_tables
from tickloom.sources.topic import kafka_topics, parse_records
from tickloom.streaming.candles import (
    stream_candles,
    stream_candles_and_late,
    stream_candles_by_symbol,
    stream_candles_filled,
)

PIPELINES = {
    "by-symbol": stream_candles_by_symbol,
    "filled": stream_candles_filled,
    "plain": stream_candles,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Stream ticks into the candle table")
    parser.add_argument("--bootstrap-servers", required=True)
    parser.add_argument("--table", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--pipeline", choices=PIPELINES, default="filled")
    parser.add_argument("--window-ms", type=int, default=WINDOW_MS)
    parser.add_argument("--delay-ms", type=int, default=WATERMARK_DELAY_MS)
    parser.add_argument("--trigger", default="1 second", help="time between micro-batches")
    parser.add_argument("--max-offsets", type=int, default=5_000_000, help="bound on records per micro-batch")
    parser.add_argument("--min-offsets", type=int, help="records that a micro-batch waits for")
    parser.add_argument("--max-delay", help="longest wait for them, such as 50ms")
    parser.add_argument("--late-table", help="folder for rejected ticks; the pipeline is by-symbol then")
    parser.add_argument("--summaries", help="folder for one row per write: symbols, count, range, duration")
    parser.add_argument("--state-partitions", type=int, help="fixed at the first start of a checkpoint")
    args = parser.parse_args(argv)

    spark = streaming_session(build_session("tick-stream"), args.state_partitions)
    topic = kafka_topics(
        spark,
        args.bootstrap_servers,
        max_offsets_per_trigger=args.max_offsets,
        min_offsets_per_trigger=args.min_offsets,
        max_trigger_delay=args.max_delay,
    )
    records, window = parse_records(topic), {"size_ms": args.window_ms, "delay_ms": args.delay_ms}
    sink = {"file_format": args.format, "trigger": {"processingTime": args.trigger}, "summaries": args.summaries}
    if args.late_table:
        tagged = stream_candles_and_late(records, **window)
        running = stream_to_tables(tagged, args.table, args.late_table, args.checkpoint, size_ms=args.window_ms, **sink)
    else:
        running = stream_to_table(PIPELINES[args.pipeline](records, **window), args.table, args.checkpoint, **sink)
    running.awaitTermination()


if __name__ == "__main__":
    main()
