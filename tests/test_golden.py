"""Golden cases on the batch operators: window 60 s, delay 0.5 s."""

import datetime as dt
import json
import os
import random
import zipfile
from decimal import Decimal

import pytest
from conftest import heartbeat, record_frame, tick, topic_frame
from pyspark.sql import functions as F

from tickloom.functions.decimals import exact_decimal, from_units, to_units
from tickloom.functions.timing import bucket_start, iso_utc, month_key
from tickloom.operators import catalog, readiness, subscriptions
from tickloom.operators.blocks import Earlier, even_cuts, with_earlier, with_neighbour
from tickloom.operators.candles import candles, to_candle_schema
from tickloom.operators.gapfill import candles_as_streamed, candles_filled, fill_gaps
from tickloom.operators.late import flag_late
from tickloom.plans import backfill
from tickloom.schema import CANDLE, CANDLE_COLUMNS
from tickloom.sinks import candle_table
from tickloom.sinks.topic import tick_payload
from tickloom.sources import feed, klines, same_day
from tickloom.sources.topic import parse_records, ticks_only

MINUTE = 60_000


@pytest.fixture(autouse=True, scope="module")
def fixed_plans(spark):
    """Small cases run faster without code generation and runtime re-planning, and joins stay
    sort-merge joins. ``test_oracle`` covers the defaults."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.codegen.wholeStage": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def short(frame, symbol="X"):
    rows = [r for r in frame.collect() if r.symbol == symbol]
    return sorted((r.start, *(float(v) for v in (r.open, r.high, r.low, r.close, r.volume)), r.trades) for r in rows)


GOLDEN = {
    "basic": ([tick(1000, 10, 1, 1), tick(2000, 12, 2, 2), tick(59999, 11, 1, 3), heartbeat(60501)],
              [(0, 10, 12, 10, 11, 4, 3)]),
    "ties": ([tick(1000, 10, 1, 1), tick(1000, 9, 1, 2), tick(5000, 11, 1, 3), tick(5000, 12, 1, 4), heartbeat(60501)],
             [(0, 10, 12, 9, 11, 4, 4)]),
    "disorder": ([tick(30000, 11, 1, 1), tick(1000, 10, 1, 2), tick(20000, 15, 1, 3), heartbeat(60501)],
                 [(0, 10, 15, 10, 11, 3, 3)]),
    "duplicate": ([tick(1000, 10, 1, 1), tick(2000, 99, 1, 1), tick(61000, 20, 1, 1), heartbeat(120501)],
                  [(0, 10, 10, 10, 10, 1, 1), (60000, 20, 20, 20, 20, 1, 1)]),
    "gap": ([tick(1000, 10, 1, 1), heartbeat(240501)],
            [(0, 10, 10, 10, 10, 1, 1)] + [(s, 10, 10, 10, 10, 0, 0) for s in (60000, 120000, 180000)]),
    "late": ([tick(1000, 10, 1, 1), heartbeat(60501), tick(59000, 99, 1, 2), heartbeat(120501)],
             [(0, 10, 10, 10, 10, 1, 1), (60000, 10, 10, 10, 10, 0, 0)]),
    "old first tick": ([heartbeat(250000), tick(1000, 5, 1, 1), heartbeat(300501)],
                       [(0, 5, 5, 5, 5, 1, 1)] + [(s, 5, 5, 5, 5, 0, 0) for s in (60000, 120000, 180000, 240000)]),
    "two open": ([tick(59000, 10, 1, 1), tick(60100, 20, 1, 2), tick(59500, 11, 1, 3), heartbeat(120501)],
                 [(0, 10, 11, 10, 11, 2, 2), (60000, 20, 20, 20, 20, 1, 1)]),
    "no ticks": ([heartbeat(600000)], []),
    "before 1970": ([tick(-1, 9, 1, 1), tick(1000, 10, 1, 2), heartbeat(60501)], [(0, 10, 10, 10, 10, 1, 1)]),
}


@pytest.mark.parametrize("case", GOLDEN)
def test_live_run_in_batch(spark, case):
    records, expected = GOLDEN[case]
    assert short(candles_as_streamed(record_frame(spark, records))) == expected


def test_window_not_reached_by_the_watermark_stays_open(spark):
    assert short(candles_as_streamed(record_frame(spark, [tick(1000, 10, 1, 1), heartbeat(60500)]))) == []


def test_floor_month_and_iso(spark):
    frame = spark.createDataFrame([(-1,), (1704067140000,), (1704067200000,), (180123,)], "ms long")
    got = frame.select(
        bucket_start(F.col("ms"), MINUTE), month_key(F.col("ms")), iso_utc(F.col("ms"))
    ).collect()
    assert [r[0] for r in got] == [-60000, 1704067140000, 1704067200000, 180000]
    assert [r[1] for r in got][1:3] == [202312, 202401]
    assert got[0][1] == 197001  # cut toward zero before the calendar
    for row, ms in zip(got[1:], (1704067140000, 1704067200000, 180123), strict=True):
        assert row[2] == dt.datetime.fromtimestamp(ms / 1000, tz=dt.UTC).isoformat()


def test_calendar_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.range(1).select(
            month_key(F.lit(1704067200000)), iso_utc(F.lit(1704067200000))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (202401, "2024-01-01T00:00:00+00:00")


@pytest.mark.parametrize("text,ok", [
    ("42000.10", True), ("1.123456789", False), ("1.1234567800000", True), ("1e-7", True), ("1e-9", False),
    ("9999999999.99999999", True), ("10000000000", False), ("abc", False), ("-0.5", True),
    ("0.0000000000000000000000001", False),
])
def test_exact_decimal(spark, text, ok):
    frame = spark.createDataFrame([(text,)], "t string").select(exact_decimal(F.col("t")).alias("v"))
    if ok:
        assert frame.first().v == Decimal(text)
    else:
        with pytest.raises(Exception, match="not a decimal"):
            frame.collect()


def test_units_round_trip(spark):
    values = [(Decimal("-0.00000001"),), (Decimal("9999999999.99999999"),), (Decimal("0"),)]
    frame = spark.createDataFrame(values, "v decimal(18,8)")
    assert all(r[0] == r[1] for r in frame.select("v", from_units(to_units(F.col("v")))).collect())


def test_records_are_parsed_by_type(spark):
    records = [tick(1, "42000.10", "0.015", 7, "BTC") | {"extra": 1}, heartbeat(5), {"symbol": "A", "price": 1.5, "quantity": 2, "timestamp": "9", "trade_id": 1}]
    got = [tuple(r) for r in parse_records(topic_frame(spark, records)).collect()]
    assert got == [
        ("tick", "BTC", Decimal("42000.10"), Decimal("0.015"), 1, 7, 0),
        ("heartbeat", None, None, None, 5, None, 1),
        ("tick", "A", Decimal("1.5"), Decimal(2), 9, 1, 2),
    ]
    assert ticks_only(parse_records(topic_frame(spark, records))).count() == 2


@pytest.mark.parametrize("bad", [
    "{not json", {"symbol": "A", "price": "1", "quantity": "1", "timestamp": 1}, tick("x", 1, 1, 1), tick(1, "1.123456789", 1, 1),
    {"type": "heartbeat"},
])
def test_bad_record_fails(spark, bad):
    with pytest.raises(Exception):  # noqa: B017
        parse_records(topic_frame(spark, [bad])).collect()


def test_feed_messages(spark):
    raw = [
        '{"stream":"btcusdt@trade","data":{"e":"trade","s":"BTCUSDT","p":"42000.10","q":"0.015","T":1704067201000,"t":1}}',
        '{"result":null,"id":1}',
    ]
    got = feed.normalize_trades(spark.createDataFrame([(r,) for r in raw], "raw string")).collect()
    assert [tuple(r) for r in got] == [("BTCUSDT", "BTCUSDT", Decimal("42000.10"), Decimal("0.015"), 1704067201000, 1)]


def test_payload_keeps_decimals_as_text_and_reads_back(spark):
    ticks = record_frame(spark, [tick(5, "1.50000000", "2", 3, "ABC")])
    row = tick_payload(ticks).first()
    assert bytes(row.key) == b"ABC"
    assert json.loads(bytes(row.value)) == tick(5, "1.50000000", "2.00000000", 3, "ABC")


def test_kline_json(spark):
    page = '[[1704067200000,"42000.1","42010","41990.5","42005","1.25",1704067259999,"x",17,"x","x","x"]]'
    frame = klines.klines_json(spark.createDataFrame([("B", page), ("C", "[]")], "symbol string, payload string"))
    assert frame.schema.fieldNames() == CANDLE_COLUMNS
    assert [tuple(str(v) for v in r) for r in frame.collect()] == [
        ("B", "1704067200000", "1704067259999", "42000.10000000", "42010.00000000", "41990.50000000", "42005.00000000", "1.25000000", "17")
    ]


HEADER = "close_time,open_time,open,high,low,close,volume,quote,count"


def test_kline_csv_by_name(spark, run_dir):
    import os

    for symbol in ("AAA", "007"):
        folder = f"{run_dir}/daily/klines/{symbol}/1m"
        os.makedirs(folder)
        with open(f"{folder}/{symbol}-1m-2024-01-01.csv", "w") as f:
            f.write(f"{HEADER}\n59999,0,1,3,0.5,2,7.5,xx,4\n")
    got = {tuple(str(v) for v in r) for r in klines.klines_csv(spark, f"{run_dir}/daily/klines/*/1m/*.csv").collect()}
    values = ("0", "59999", "1.00000000", "3.00000000", "0.50000000", "2.00000000", "7.50000000", "4")
    assert got == {("AAA", *values), ("007", *values)}


def test_archives_and_file_report(spark, run_dir):
    import os

    def archive(path, text):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("first.csv", text)
            z.writestr("second.csv", "ignored")

    base = f"{run_dir}/data"
    ranges = spark.createDataFrame([("AAA", dt.date(2024, 1, 1), dt.date(2024, 1, 5))], "symbol string, start_date date, end_date date")
    plan = backfill.download_plan(ranges, f"file:{base}")
    day = f"{base}/daily/klines/AAA/1m/AAA-1m-2024-01-0"
    rows = [f"{i * MINUTE + 59999},{i * MINUTE},1,3,0.5,2,7.5,xx,4" for i in range(10)]
    archive(f"{day}1.zip", "\n".join([HEADER, *rows]))
    archive(f"{day}3.zip", f"{HEADER}\n59999,0,1.123456789,3,0.5,2,7.5,xx,4")
    archive(f"{day}4.zip", HEADER + "\n")
    scanned = klines.read_archives(klines.archive_files(spark, base))
    assert short(klines.archive_candles(scanned), "AAA") == [(i * MINUTE, 1, 3, 0.5, 2, 7.5, 4) for i in range(10)]
    report = backfill.backfill_file_report(plan, klines.archive_outcomes(scanned))
    got = {r.date[-1]: (r.status, r.rows) for r in report.collect()}
    assert got == {"1": ("ok", 10), "2": ("missing", 0), "3": ("failed", 0), "4": ("ok", 0)}
    total = backfill.backfill_totals(report).first()
    assert (total.candles, total.daily_files, total.missing_files, total.failed_files) == (10, 4, 1, 1)


@pytest.mark.parametrize("start,end,monthly,daily", [
    ("2024-01-15", "2024-04-03", ["2024-02", "2024-03"], [f"2024-01-{d}" for d in range(15, 32)] + ["2024-04-01", "2024-04-02"]),
    ("2024-01-01", "2024-02-01", ["2024-01"], []),
    ("2024-01-01", "2024-01-31", [], [f"2024-01-{d:02}" for d in range(1, 31)]),
    ("2024-01-15", "2024-01-20", [], [f"2024-01-{d}" for d in range(15, 20)]),
    ("2024-01-01", "2024-01-01", [], []),
    ("2024-01-02", "2024-01-01", [], []),
    ("2023-12-31", "2024-03-01", ["2024-01", "2024-02"], ["2023-12-31"]),
])
def test_download_plan(spark, start, end, monthly, daily):
    ranges = spark.createDataFrame(
        [("A", dt.date.fromisoformat(start), dt.date.fromisoformat(end))], "symbol string, start_date date, end_date date"
    )
    rows = backfill.download_plan(ranges, "http://host/data/").collect()
    assert [r.date for r in rows if r.interval == "monthly"] == monthly
    assert [r.date for r in rows if r.interval == "daily"] == daily
    assert all(r.path == f"http://host/data/{r.interval}/klines/A/1m/A-1m-{r.date}.zip" for r in rows)


def test_readiness_uses_the_first_arrival(spark):
    later = record_frame(spark, [tick(t, 1, 1, i) for i, t in enumerate((30000, 90000, 125000, 185000))])
    assert [(r.until, r.fired_at) for r in readiness.readiness_trigger(later).collect()] == [(120000, 2)]
    disorder = record_frame(spark, [tick(t, 1, 1, i) for i, t in enumerate((65000, 30000, 125000, 180500))])
    assert [(r.until, r.fired_at) for r in readiness.readiness_trigger(disorder).collect()] == [(180000, 3)]


def test_readiness_starts_over_after_a_reset(spark):
    ticks = record_frame(spark, [tick(t * MINUTE, 1, 1, t) for t in range(8)])
    ticks = ticks.withColumn("arrival", F.col("arrival") * 10)
    resets = spark.createDataFrame([("X", 35)], "symbol string, arrival long")
    rows = readiness.readiness_trigger(readiness.with_session(ticks, resets, block=4), keys=("symbol", "session"))
    assert sorted((r.session, r.until) for r in rows.collect()) == [(0, 2 * MINUTE), (1, 6 * MINUTE)]


def _klines(spark, minutes):
    rows = [("A", m * MINUTE, m * MINUTE + 59999, *[Decimal(1)] * 5, 1) for m in minutes]
    return spark.createDataFrame(rows, CANDLE)


@pytest.mark.parametrize("minutes,until,inclusive,pages", [
    (range(1440), 1200, True, [1000, 201]),
    (range(1440), 1200, False, [1000, 200]),
    (range(1440), 0, True, []),
    (range(1440), 1000, True, [1000]),  # the second page would start at ``until`` and is not asked for
    ([m for m in range(1440) if m != 500], 1001, True, [1000]),
    ([m for m in range(1440) if m != 500], 1002, True, [1000, 2]),
    ([*range(1000), 1005], 1005, True, [1000, 1]),
])
def test_same_day_pages(spark, minutes, until, inclusive, pages):
    requests = spark.createDataFrame([("A", until * MINUTE), ("B", 5 * MINUTE)], "symbol string, until long")
    got = same_day.same_day_pages(_klines(spark, minutes), requests, inclusive=inclusive).orderBy("page").collect()
    assert [r.rows for r in got] == pages
    assert same_day.same_day_candles(_klines(spark, minutes), requests, inclusive=inclusive).count() == sum(pages)
    if len(pages) == 2:
        assert (got[0].requested_from, got[1].requested_from) == (0, got[0].last_end + 1)


def test_catalog(spark):
    held = spark.createDataFrame([("A", "available")], "symbol string, state string")
    asked = spark.createDataFrame([("A",), ("B",), ("B",)], "symbol string")
    upserted = catalog.catalog_upsert(held, asked)
    assert sorted(map(tuple, upserted.collect())) == [("A", "unavailable"), ("B", "unavailable")]
    marks = spark.createDataFrame([("B",), ("C",)], "symbol string")
    marked = catalog.catalog_mark_available(upserted, marks)
    assert sorted(map(tuple, marked.collect())) == [("A", "unavailable"), ("B", "available")]


@pytest.mark.parametrize("ready,ok,state", [(True, True, "available"), (False, True, "unavailable"), (True, False, "unavailable")])
def test_catalog_waits_for_all(spark, ready, ok, state):
    held = spark.createDataFrame([("A", "unavailable")], "symbol string, state string")
    gate = catalog.onboarding_done(
        spark.createDataFrame([("A", True), ("B", ready)], "symbol string, ready boolean"),
        spark.createDataFrame([(True,), (ok,)], "ok boolean"),
    )
    assert catalog.catalog_mark_available(held, held, gate).first().state == state


def test_onboarding_ranges(spark):
    symbols = spark.createDataFrame([("A",)], "symbol string")
    end = F.lit("2024-02-01").cast("date")
    got = backfill.onboarding_ranges(symbols, _klines(spark, [3000, 1500]), end).first()
    assert got.start_date == dt.date(1970, 1, 2)
    with pytest.raises(Exception, match="no data found for Z"):
        backfill.onboarding_ranges(spark.createDataFrame([("Z",)], "symbol string"), _klines(spark, [1]), end).collect()


def test_readiness_report(spark):
    asked = spark.createDataFrame([("A", 1000), ("B", 1000), ("C", 1000)], "symbol string, started_ms long")
    signals = spark.createDataFrame([("A", 3_601_000), ("A", 500), ("B", 3_601_001)], "symbol string, ready_ms long")
    got = {r.symbol: (r.elapsed_ms, r.ready) for r in readiness.readiness_report(asked, signals).collect()}
    assert got == {"A": (3_600_000, True), "B": (None, False), "C": (None, False)}
    assert sorted(r.symbol for r in readiness.pending_symbols(asked, signals).collect()) == ["B", "C"]


def test_subscriptions(spark):
    log = spark.createDataFrame(
        [(1, "subscribe", "a"), (2, "subscribe", "A"), (3, "unsubscribe", "B"), (4, "subscribe", "B"), (5, "unsubscribe", "A")],
        "seq long, action string, symbol string",
    )
    audit = subscriptions.subscription_audit(log, block=2)
    assert [r.seq for r in audit.orderBy("seq").collect() if r.is_noop] == [2, 3]
    assert [r.symbol for r in subscriptions.active_symbols(log).collect()] == ["B"]


def test_table_round_trip(spark, run_dir):
    path = f"{run_dir}/table"
    rows = _klines(spark, [0, 1, 44640]).withColumn("symbol", F.lit("0070"))
    candle_table.append_candles(rows.select(*reversed(CANDLE_COLUMNS), F.lit(1).alias("other")), path)
    candle_table.append_candles(rows, path)
    stored = candle_table.read_candles(spark, path)
    assert stored.count() == 6
    assert {(r.symbol, r.month) for r in stored.collect()} == {("0070", 197001), ("0070", 197002)}
    january = candle_table.between(stored, 0, 31 * 86_400_000)
    assert january.count() == 4
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_appending_nothing_writes_no_data(spark, run_dir):
    import glob

    path = f"{run_dir}/table"
    candle_table.append_candles(_klines(spark, [0]).filter("start < 0"), path)
    assert glob.glob(f"{path}/**/*.parquet", recursive=True) == []


def test_catalog_table(spark, run_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS market LOCATION '{run_dir}/market'")
    name = "market.candles"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for _ in range(2):
        candle_table.create_candle_table(spark, name)
        candle_table.insert_candles(_klines(spark, [0, 1]), name)
    assert spark.table(name).count() == 4
    spark.sql(f"DROP TABLE {name}")


def test_missing_candle_column_fails(spark):
    with pytest.raises(Exception, match="trades"):
        to_candle_schema(_klines(spark, [0]).drop("trades"))


def test_write_summary(spark):
    row = candle_table.write_summary(_klines(spark, [0, 2])).first()
    assert tuple(row) == ("A", 2, "1970-01-01T00:00:00+00:00", "1970-01-01T00:03:00+00:00")


# --- properties on random ticks


def random_records(seed, n=400, symbols=("A", "B", "C"), span=1_200_000, ties=False):
    rng = random.Random(seed)
    records, clock = [], 0
    for i in range(n):
        clock += rng.randrange(2 * span // n)
        ts = max(0, clock - rng.choice([0, 0, 0, 300, 5_000, 90_000]))
        if ties:
            ts -= ts % 10_000
        records.append(tick(ts, rng.randrange(1, 10_000) / 100, rng.randrange(1, 50), rng.randrange(n // 2), rng.choice(symbols)))
    return records


def live_model(records, size=MINUTE, delay=500):
    """Record by record, the way the rules read: late test, duplicate test, seal on watermark."""
    latest, sealed, windows, out, late = None, {}, {}, [], []

    def seal(watermark):
        for symbol in {s for s, _ in windows}:
            starts = [w for s, w in windows if s == symbol]
            cursor = sealed.get(symbol, (min(starts), None))[0]
            close = sealed.get(symbol, (None, None))[1]
            while cursor + size <= watermark:
                seen = windows.pop((symbol, cursor), None)
                if seen:
                    by_time = sorted(seen, key=lambda r: r[0])
                    top = max(r[0] for r in seen)
                    close = next(r[1] for r in seen if r[0] == top)
                    prices = [r[1] for r in seen]
                    out.append((symbol, cursor, by_time[0][1], max(prices), min(prices), close, sum(r[2] for r in seen), len(seen)))
                else:
                    out.append((symbol, cursor, close, close, close, close, Decimal(0), 0))
                cursor += size
                sealed[symbol] = (cursor, close)
                windows.setdefault((symbol, cursor), [])

    for i, r in enumerate(records):
        if latest is not None:
            seal(latest - delay - 1)
        if "symbol" in r:
            start = r["timestamp"] // size * size
            if start < sealed.get(r["symbol"], (0,))[0]:
                late.append(i)
            else:
                seen = windows.setdefault((r["symbol"], start), [])
                if r["trade_id"] not in {x[3] for x in seen}:
                    seen.append((r["timestamp"], Decimal(r["price"]), Decimal(r["quantity"]), r["trade_id"]))
        latest = r["timestamp"] if latest is None else max(latest, r["timestamp"])
    seal(latest - delay - 1)
    return sorted(out), late


@pytest.mark.parametrize("seed,ties", [(1, False), (2, True), (3, False)])
def test_batch_equals_the_record_by_record_model(spark, seed, ties):
    records = random_records(seed, ties=ties)
    expected, late = live_model(records)
    frame = record_frame(spark, records).repartition(5)
    got = sorted(
        (r.symbol, r.start, r.open, r.high, r.low, r.close, r.volume, r.trades)
        for r in candles_as_streamed(frame).collect()
    )
    assert got == expected
    flagged = flag_late(frame, block=16).filter("is_late").collect()
    assert sorted(r.arrival for r in flagged) == late and late


@pytest.mark.parametrize("seed", [11, 12])
def test_candle_properties(spark, seed):
    frame = record_frame(spark, random_records(seed))
    plain = candles(frame).collect()
    assert plain and all(r.low <= min(r.open, r.close) and max(r.open, r.close) <= r.high for r in plain)
    colocated = candles(frame.repartition(3), layout="colocated").collect()
    assert sorted(map(tuple, colocated)) == sorted(map(tuple, plain))
    filled = candles_filled(frame, horizon_ms=F.lit(10 * 1_200_000).cast("long")).collect()
    assert sum(r.volume for r in filled) == sum(r.volume for r in plain)
    assert sum(r.trades for r in filled) == sum(r.trades for r in plain)
    for symbol in "ABC":
        starts = sorted(r.start for r in filled if r.symbol == symbol)
        assert starts == list(range(starts[0], 10 * 1_200_000, MINUTE))


def test_silence_longer_than_a_block(spark):
    rows = _klines(spark, [0, 25_000])
    filled = fill_gaps(rows, F.lit(30_000 * MINUTE).cast("long"))
    assert filled.count() == 30_000
    assert filled.filter("trades = 0").count() == 29_998


def test_values_that_do_not_fit_raise(spark):
    row = "SELECT 'A' AS symbol, 0L AS start, 1L AS end, {} AS open, 1 AS high, 1 AS low, 1 AS close, {} AS volume, 1 AS trades"
    good = to_candle_schema(spark.sql(row.format("1.50000000000BD", "'2e-8'"))).first()
    assert (good.open, good.volume) == (Decimal("1.5"), Decimal("2e-8"))
    for bad in ("1.123456789BD", "0.000000001BD", "12345678901.5BD", "'1e-9'", "'1e-21'", "'1.0000000000000000000001e-3'"):
        with pytest.raises(Exception, match="does not fit|not a decimal"):
            to_candle_schema(spark.sql(row.format(bad, "1"))).collect()


def test_exponents_by_their_digits(spark):
    texts = ["0e-30", "100e-10", "1.20E2", "12300e-10"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(exact_decimal(F.col("t")).alias("v")).collect()
    assert [r.v for r in got] == [Decimal(t) for t in ("0", "1e-8", "120", "1.23e-6")]


def test_kline_without_a_price_raises(spark):
    pages = spark.createDataFrame([("A", '[[0,null,"1","1","1","1",59999,"0",3]]')], "symbol string, payload string")
    with pytest.raises(Exception, match="lacks open"):
        klines.klines_json(pages).collect()


def test_bad_archive_row_fails_its_file(spark, run_dir):
    header = "open_time,open,high,low,close,volume,close_time,count\n"
    bodies = {
        "A": header + "0,1,1,1,1,1,59999,1\n,1,1,1,1,1,59999,1\n",
        "B": header + "0,1.123456789,1,1,1,1,59999,1\n",
        "C": "count,close_time,volume,close,low,high,open,open_time\n4,59999,1,1,1,1,2,0\n",
        "D": header,
    }
    for name, body in bodies.items():
        folder = f"{run_dir}/daily/klines/{name}/1m"
        os.makedirs(folder)
        with zipfile.ZipFile(f"{folder}/{name}-1m-1970-01-01.zip", "w") as z:
            z.writestr("x.csv", body)
    scanned = klines.read_archives(klines.archive_files(spark, run_dir))
    outcomes = {r.path.split("/")[-1][0]: (r.rows, r.error) for r in klines.archive_outcomes(scanned).collect()}
    assert outcomes == {"A": (0, "unusable row 2"), "B": (0, "unusable row 1"), "C": (1, None), "D": (0, None)}
    assert [(r.symbol, int(r.open), r.trades) for r in klines.archive_candles(scanned).collect()] == [("C", 2, 4)]


def test_candles_are_hash_aggregates(spark):
    plan = candles(record_frame(spark, [tick(1, 1, 1, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_not_ready_fails_with_the_names(spark):
    asked = spark.createDataFrame([("B", 0), ("A", 0), ("C", 0)], "symbol string, started_ms long")
    signals = spark.createDataFrame([("C", 5)], "symbol string, ready_ms long")
    report = readiness.readiness_report(asked, signals, timeout_s=1)
    with pytest.raises(Exception, match="not ready: A, B; slowest ready after ms: 5"):
        readiness.require_ready(report).collect()
    ready = readiness.readiness_report(asked.filter("symbol = 'C'"), signals, timeout_s=1)
    assert readiness.require_ready(ready).count() == 1


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_blocked_windows_match_plain_ones(spark, levels):
    rng = random.Random(levels)
    rows = [(i, rng.choice("AAB"), rng.randrange(100) if rng.random() < 0.8 else None) for i in range(300)]
    frame = spark.createDataFrame(rows, "n long, k string, v long").repartition(4)
    for kind, fold in (("max", max), ("min", min), ("sum", lambda a, b: a + b)):
        got = with_earlier(frame, Earlier("e", kind, "v", ("k",)), order="n", block=4, levels=levels)
        state, expected = {}, {}
        for n, k, v in rows:
            expected[n] = state.get(k)
            if v is not None:
                state[k] = v if state.get(k) is None else fold(state[k], v)
        assert {r.n: r.e for r in got.collect()} == expected
    for offset in (1, -1):
        got = with_neighbour(frame, "e", "n", order="n", keys=("k",), offset=offset, block=4)
        by_key = {k: [r[0] for r in rows if r[1] == k] for k in "AB"}
        expected = {}
        for ns in by_key.values():
            for i, n in enumerate(ns):
                j = i + offset
                expected[n] = ns[j] if 0 <= j < len(ns) else None
        assert {r.n: r.e for r in got.collect()} == expected


@pytest.mark.parametrize("levels", [1, 2])
def test_cuts_keep_blocks_even_where_positions_have_gaps(spark, levels):
    rng = random.Random(5)
    # half of the rows close together, the others far apart and beyond what a double tells apart
    places = sorted(rng.sample(range(1000), 300) + [rng.randrange(1 << 40, 1 << 62) for _ in range(300)])
    rows = [(n, rng.choice("AAB"), rng.randrange(100)) for n in places]
    frame = spark.createDataFrame(rows, "n long, k string, v long").repartition(4)
    cuts = even_cuts(frame, "n", rows=20)
    sizes = [sum(a <= n < b for n in places) for a, b in zip([-1, *cuts], [*cuts, 1 << 63], strict=True)]
    assert len(cuts) == 30 and max(sizes) <= 40
    specs = Earlier("all", "max", "v"), Earlier("own", "sum", "v", ("k",))
    got = with_earlier(frame, *specs, order="n", block=cuts, levels=levels).collect()
    expected, top, sums = {}, None, {}
    for n, k, v in rows:
        expected[n] = (top, sums.get(k))
        top, sums[k] = v if top is None else max(top, v), sums.get(k, 0) + v
    assert {r.n: (r.all, r.own) for r in got} == expected
    plain = with_neighbour(frame, "e", "n", order="n", keys=("k",), offset=1, block=1 << 30)
    assert sorted(with_neighbour(frame, "e", "n", order="n", keys=("k",), offset=1, block=cuts).collect()) == sorted(plain.collect())
    assert even_cuts(frame.limit(0), "n") == [] and with_earlier(frame, *specs, order="n", block=[]).count() == 600
