"""Every operator as a query over the benchmark tables: name to (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import streams
from tickloom.functions.timing import bucket_start, date_ms, iso_utc, utc_date
from tickloom.operators import candles as C
from tickloom.operators import catalog, late, readiness, subscriptions
from tickloom.operators.gapfill import candles_as_streamed, candles_filled
from tickloom.plans import backfill
from tickloom.schema import DAY_MS, WATERMARK_DELAY_MS, WINDOW_MS
from tickloom.session import streaming_session, use_utc, work_dir
from tickloom.sinks import candle_table
from tickloom.sinks.topic import tick_payload
from tickloom.sources import adapters as A
from tickloom.sources import feed, klines, same_day, topic
from tickloom.streaming import candles as S
from tickloom.streaming import live

HOUR_MS = 3_600_000
ARCHIVE_BASE = "archive"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # a session on one machine, as in tests, may lack a shared folder; a cluster must name one
        if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
            spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _events(spark, sf_dir):
    return A.table(spark, sf_dir, "events")


def _ticks(spark, sf_dir):
    return A.ticks_from_events(_events(spark, sf_dir))


def _user_ticks(spark, sf_dir):
    return A.ticks_from_events(_events(spark, sf_dir), A.user_symbol())


def _klines(spark, sf_dir, size_ms=HOUR_MS):
    return A.inclusive_end(C.candles(_ticks(spark, sf_dir), size_ms))


# --- records and payloads


@query
def parse_records(spark, sf_dir):
    """Ticks and heartbeats decoded from JSON; views stand in for heartbeats."""
    ticks = A.ticks_from_events(_events(spark, sf_dir).filter("event_type <> 'view'"))
    views = A.ticks_from_events(_events(spark, sf_dir).filter("event_type = 'view'"))
    beats = A.heartbeat_topic(views, F.col("arrival"))
    records = topic.parse_records(A.topic_from_ticks(ticks).unionByName(beats))
    return records.select(
        "kind",
        F.coalesce("symbol", F.lit("")).alias("symbol"),
        F.coalesce("price", F.lit(0).cast("decimal(18,8)")).alias("price"),
        F.coalesce("quantity", F.lit(0).cast("decimal(18,8)")).alias("quantity"),
        "timestamp",
        F.coalesce("trade_id", F.lit(-1).cast("long")).alias("trade_id"),
        "arrival",
    )


@query
def normalize_trades(spark, sf_dir):
    acks = A.acknowledgements(A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")))
    messages = A.feed_messages(_ticks(spark, sf_dir)).unionByName(acks)
    return feed.normalize_trades(messages)


@query
def tick_payload_json(spark, sf_dir):
    payload = tick_payload(_ticks(spark, sf_dir))
    return payload.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


# --- kline scans


@query
def klines_json_to_candles(spark, sf_dir):
    return klines.klines_json(A.kline_payloads(_klines(spark, sf_dir)))


@query
def klines_csv_to_candles(spark, sf_dir):
    """Two writers with different column orders and an unknown column."""
    folder = work_dir(spark, "csv")
    rows = A.archive_rows(_klines(spark, sf_dir))
    even = F.pmod(F.xxhash64("symbol"), F.lit(2)) == 0
    other = rows.select(F.lit("x").alias("ignore"), *reversed(rows.columns))
    for part in (rows.filter(even), other.filter(~even)):
        part.write.mode("append").option("header", True).partitionBy("symbol").csv(folder)
    # partitionBy names the folders symbol=X; the glob keeps Spark from reading that as a column.
    return klines.klines_csv(spark, f"{folder}/symbol=*", symbol_pattern=r"/symbol=([^/]+)/")


@query
def klines_zip_to_candles(spark, sf_dir):
    return klines.klines_zip(A.zipped_archives(_klines(spark, sf_dir), ARCHIVE_BASE))


@query
def backfill_file_report(spark, sf_dir):
    """Planned days around a symbol's events have no file; the archives of one symbol are cut short, and
    those of another hold a row whose count is no number."""
    hours = A.archive_rows(_klines(spark, sf_dir))
    odd = (F.col("symbol") == "CLICK") & (F.hour(F.timestamp_millis("open_time")) == 7)
    hours = hours.withColumn("count", F.when(odd, F.lit("many")).otherwise(F.col("count").cast("string")))
    landed = A.zipped_rows(hours, ARCHIVE_BASE)
    broken = F.col("path").contains("/ERROR/")
    files = landed.withColumn("content", F.when(broken, F.expr("substring(content, 1, 20)")).otherwise(F.col("content")))
    outcomes = klines.archive_outcomes(klines.read_archives(files))
    return backfill.backfill_file_report(_plan_around(spark, sf_dir), outcomes)


def _plan_around(spark, sf_dir):
    """From two days before each symbol's first event, up to its last day, exclusive."""
    day = utc_date(F.col("timestamp"))
    ranges = _ticks(spark, sf_dir).groupBy("symbol").agg(F.date_sub(F.min(day), 2).alias("start_date"), F.max(day).alias("end_date"))
    return backfill.download_plan(ranges, ARCHIVE_BASE)


@query
def backfill_job_totals(spark, sf_dir):
    outcomes = klines.archive_outcomes(klines.read_archives(A.zipped_archives(_klines(spark, sf_dir), ARCHIVE_BASE)))
    return backfill.backfill_totals(backfill.backfill_file_report(_plan_around(spark, sf_dir), outcomes))


def _same_day_inputs(spark, sf_dir):
    """Minute klines without holes, and a request per symbol and day up to its last tick."""
    ticks = _ticks(spark, sf_dir)
    minutes = A.inclusive_end(candles_filled(ticks))
    last = ticks.groupBy("symbol", bucket_start(F.col("timestamp"), DAY_MS).alias("day")).agg(
        F.max("timestamp").alias("last")
    )
    return minutes, last.select("symbol", bucket_start(F.col("last"), WINDOW_MS).alias("until"))


@query
def same_day_candles(spark, sf_dir):
    return same_day.same_day_candles(*_same_day_inputs(spark, sf_dir))


@query
def same_day_pages(spark, sf_dir):
    return same_day.same_day_pages(*_same_day_inputs(spark, sf_dir))


# --- candles


@query
def bucket_ticks(spark, sf_dir):
    return C.bucket_ticks(_ticks(spark, sf_dir))


@query
def candles(spark, sf_dir):
    return C.candles(_ticks(spark, sf_dir))


@query
def candles_colocated(spark, sf_dir):
    return C.candles(_ticks(spark, sf_dir), layout="colocated")


@query
def candles_unique_ids(spark, sf_dir):
    """Event ids never repeat, so deduplication can be left out."""
    return C.candles(_ticks(spark, sf_dir), dedup=False)


@query
def candles_ties(spark, sf_dir):
    """Timestamps cut to ten minutes, so that many ticks share one."""
    tied = bucket_start(F.col("timestamp"), 600_000)
    return C.candles(_ticks(spark, sf_dir).withColumn("timestamp", tied), HOUR_MS)


def _repeated_ids(spark, sf_dir):
    events = _events(spark, sf_dir).withColumn("_user", F.col("user_id"))
    return A.ticks_from_events(events).join(
        events.select(F.col("event_id").alias("arrival"), "_user"), "arrival"
    ).withColumn("trade_id", F.col("_user")).drop("_user")


@query
def dedup_ticks(spark, sf_dir):
    """User ids as trade ids, so that they repeat within a day."""
    return C.dedup_ticks(_repeated_ids(spark, sf_dir), DAY_MS)


@query
def candles_dedup(spark, sf_dir):
    return C.candles(_repeated_ids(spark, sf_dir), DAY_MS)


@query
def to_candle_schema(spark, sf_dir):
    wide = C.candles(_ticks(spark, sf_dir)).withColumn("note", F.lit("x")).withColumn("trades", F.col("trades").cast("int"))
    return C.to_candle_schema(wide)


@query
def add_month(spark, sf_dir):
    return C.add_month(C.candles(_ticks(spark, sf_dir)))


@query
def candles_gapfilled(spark, sf_dir):
    return candles_filled(_ticks(spark, sf_dir))


def _shuffled_arrivals(spark, sf_dir):
    """Each run of 50 events arrives in reverse."""
    position = F.col("arrival")
    return _ticks(spark, sf_dir).withColumn("arrival", position - F.pmod(position, F.lit(50)) + 49 - F.pmod(position, F.lit(50)))


@query
def late_ticks(spark, sf_dir):
    flagged = late.flag_late(_shuffled_arrivals(spark, sf_dir))
    return flagged.select("symbol", "trade_id", "timestamp", "arrival", "start", "is_late")


@query
def live_candles(spark, sf_dir):
    """What a live run writes for the shuffled arrivals."""
    return candles_as_streamed(_shuffled_arrivals(spark, sf_dir))


# --- readiness, subscriptions, catalog


@query
def readiness_trigger(spark, sf_dir):
    return readiness.readiness_trigger(_user_ticks(spark, sf_dir))


@query
def readiness_by_session(spark, sf_dir):
    """A user's errors stand in for reconnects."""
    events = _events(spark, sf_dir)
    ticks = A.ticks_from_events(events.filter("event_type <> 'error'"), A.user_symbol())
    resets = events.filter("event_type = 'error'").select(
        A.user_symbol().alias("symbol"), F.col("event_id").alias("arrival")
    )
    sessions = readiness.with_session(ticks, resets)
    return readiness.readiness_trigger(sessions, keys=("symbol", "session"))


def _readiness_inputs(spark, sf_dir):
    """A user is requested at the first event; every event but an error is a signal, the first event aside."""
    events = _events(spark, sf_dir).select(
        A.user_symbol().alias("symbol"),
        "event_type",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
    )
    requested = events.groupBy("symbol").agg(F.min("ms").alias("started_ms"))
    later = events.join(requested, "symbol").filter("ms > started_ms and event_type <> 'error'")
    return requested, later.select("symbol", F.col("ms").alias("ready_ms"))


#: Fifteen hours: some users take longer.
READY_WITHIN_S = 54_000


@query
def readiness_report(spark, sf_dir):
    report = readiness.readiness_report(*_readiness_inputs(spark, sf_dir), timeout_s=READY_WITHIN_S)
    return report.withColumn("elapsed_ms", F.coalesce("elapsed_ms", F.lit(-1).cast("long")))


@query
def pending_symbols(spark, sf_dir):
    return readiness.pending_symbols(*_readiness_inputs(spark, sf_dir), timeout_s=READY_WITHIN_S)


def _subscription_log(spark, sf_dir):
    """Every event is a request: signups and purchases subscribe the user, all others unsubscribe."""
    action = F.when(F.col("event_type").isin("signup", "purchase"), "subscribe").otherwise("unsubscribe")
    return _events(spark, sf_dir).select(F.col("event_id").alias("seq"), action.alias("action"), F.lower(A.user_symbol()).alias("symbol"))


@query
def subscription_audit(spark, sf_dir):
    return subscriptions.subscription_audit(_subscription_log(spark, sf_dir))


@query
def active_symbols(spark, sf_dir):
    return subscriptions.active_symbols(_subscription_log(spark, sf_dir))


def _catalog_inputs(spark, sf_dir):
    """Customers are the catalog; those with orders, and all suppliers, are the requests."""
    held = A.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"),
        F.when(F.col("c_acctbal") > 0, catalog.AVAILABLE).otherwise(catalog.UNAVAILABLE).alias("state"),
    )
    asked = A.table(spark, sf_dir, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"))
    fresh = A.table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"))
    return held, asked.unionByName(fresh)


@query
def catalog_upsert(spark, sf_dir):
    return catalog.catalog_upsert(*_catalog_inputs(spark, sf_dir))


@query
def catalog_mark_available(spark, sf_dir):
    return catalog.catalog_mark_available(*_catalog_inputs(spark, sf_dir))


@query
def catalog_gated(spark, sf_dir):
    """Runs that wait for all users: for as long as it takes, with a timeout, and with a job that failed."""
    inputs = _readiness_inputs(spark, sf_dir)
    patient, strict = (readiness.readiness_report(*inputs, timeout_s=s) for s in (10**9, READY_WITHIN_S))
    orders = A.table(spark, sf_dir, "orders")
    ended, failing = (orders.select((F.col("o_totalprice") > bound).alias("ok")) for bound in (0, 10_000))
    gates = {
        "done": catalog.onboarding_done(patient, ended),
        "timeout": catalog.onboarding_done(strict, ended),
        "failed job": catalog.onboarding_done(patient, failing),
    }
    inputs = _catalog_inputs(spark, sf_dir)
    parts = [catalog.catalog_mark_available(*inputs, gate).withColumn("gate", F.lit(name)) for name, gate in gates.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def stream_names(spark, sf_dir):
    symbol = F.upper("c_name")
    stream = streams.stream_name(symbol)
    return A.table(spark, sf_dir, "customer").select(
        symbol.alias("symbol"),
        stream.alias("stream"),
        streams.stream_symbol(stream).alias("routing_symbol"),
        streams.short_id(F.col("c_name")).alias("short_id"),
    )


@query
def subscribe_messages(spark, sf_dir):
    """Words of a part name as the symbols of one request."""
    symbols = F.split("p_name", " ")
    return A.table(spark, sf_dir, "part").select(
        "p_partkey",
        streams.subscribe_message(symbols).alias("subscribed"),
        streams.unsubscribe_message(symbols).alias("unsubscribed"),
    )


# --- ranges


@query
def onboarding_ranges(spark, sf_dir):
    traded = C.candles(_user_ticks(spark, sf_dir), HOUR_MS)
    ranges = backfill.onboarding_ranges(traded.select("symbol"), traded, F.lit("2024-02-01").cast("date"))
    return ranges.select(
        "symbol", F.col("start_date").cast("string").alias("start_date"), F.col("end_date").cast("string").alias("end_date")
    )


@query
def download_plan(spark, sf_dir):
    """From a customer's first order to the last one, exclusive."""
    ranges = (
        A.table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").cast("date").alias("start_date"), F.max("o_orderdate").cast("date").alias("end_date"))
        .withColumn("symbol", F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
    )
    return backfill.download_plan(ranges, ARCHIVE_BASE)


@query
def date_functions(spark, sf_dir):
    """Milliseconds to calendar text and back."""
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
    return A.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        iso_utc(ms).alias("iso"),
        utc_date(ms).cast("string").alias("day"),
        date_ms(utc_date(ms)).alias("midnight"),
    )


# --- sinks


@query
def append_candles(spark, sf_dir):
    folder = work_dir(spark, "candles")
    candle_table.append_candles(C.candles(_ticks(spark, sf_dir)), folder)
    return candle_table.read_candles(spark, folder)


@query
def write_summary(spark, sf_dir):
    return candle_table.write_summary(C.candles(_ticks(spark, sf_dir)))


@query
def write_summary_by_symbol(spark, sf_dir):
    return candle_table.write_summary_by_symbol(C.candles(_ticks(spark, sf_dir)))


@query
def candles_all_sources(spark, sf_dir):
    hourly = _klines(spark, sf_dir)
    return candle_table.union_sources(
        stream=C.candles(_ticks(spark, sf_dir), HOUR_MS),
        rest=klines.klines_json(A.kline_payloads(hourly)),
        archive=klines.klines_zip(A.zipped_archives(hourly, ARCHIVE_BASE)),
    )


@query
def candle_spans(spark, sf_dir):
    """Range of each symbol in the stored table, read from file footers."""
    folder = work_dir(spark, "spans")
    candle_table.append_candles(C.candles(_ticks(spark, sf_dir)), folder)
    return candle_table.candle_spans(spark, folder)


@query
def append_candles_named(spark, sf_dir):
    """Two appends of halves of the table, the first of them repeated."""
    folder = work_dir(spark, "named")
    made = C.candles(_ticks(spark, sf_dir))
    early = F.pmod(F.col("start"), F.lit(2 * HOUR_MS)) < HOUR_MS
    for name, part in (("a", made.filter(early)), ("b", made.filter(~early)), ("a", made.filter(early))):
        candle_table.append_candles(part, folder, commit=name)
    return candle_table.read_candles(spark, folder)


@query
def append_nothing(spark, sf_dir):
    """An empty append to a table that holds candles, and the summary it returns: none."""
    folder = work_dir(spark, "nothing")
    made = C.candles(_ticks(spark, sf_dir))
    candle_table.append_candles(made, folder)
    summary = candle_table.append_candles(made.filter("trades < 0"), folder)
    held = candle_table.read_candles(spark, folder)
    return held.agg(F.count("*").alias("held"), F.sum("trades").alias("trades")).withColumn("wrote", F.lit(summary is not None))


@query
def insert_into_created_table(spark, sf_dir):
    """A catalog table made on first use, created again without effect, then filled."""
    name = f"candles_{uuid.uuid4().hex[:12]}"
    folder = work_dir(spark, "catalog")
    for _ in range(2):
        candle_table.create_candle_table(spark, name, location=folder)
    candle_table.insert_candles(C.candles(_ticks(spark, sf_dir), HOUR_MS), name)
    return spark.table(name)


# --- streams


def _land(df: DataFrame, folder: str) -> None:
    df.write.parquet(folder)


def _closing_heartbeat(ticks: DataFrame, size_ms: int) -> DataFrame:
    """One heartbeat just late enough to close the last window that has a tick."""
    end = bucket_start(F.max("timestamp"), size_ms) + F.lit(size_ms + WATERMARK_DELAY_MS + 1)
    beat = ticks.agg(end.alias("timestamp"), (F.max("arrival") + 1).alias("offset"))
    return A.heartbeat_topic(beat, F.col("offset"))


def _replay(spark, folder: str, pipeline, out: str, size_ms: int) -> None:
    """Run a pipeline over the landed topic until it is used up, through the shared-table sink."""
    session = streaming_session(spark)
    records = topic.parse_records(topic.file_topics(session, f"{folder}/topic/*"))
    running = candle_table.stream_to_table(
        pipeline(records, size_ms=size_ms), out, f"{folder}/checkpoint", trigger={"availableNow": True}
    )
    running.awaitTermination()


def _streamed(spark, sf_dir, pipeline, size_ms: int) -> DataFrame:
    folder = work_dir(spark, "stream")
    ticks = _ticks(spark, sf_dir)
    _land(A.topic_from_ticks(ticks), f"{folder}/topic/ticks")
    _land(_closing_heartbeat(ticks, size_ms), f"{folder}/topic/heartbeats")
    _replay(spark, folder, pipeline, f"{folder}/out", size_ms)
    return candle_table.read_candles(spark, f"{folder}/out")


@query
def source_ticks(spark, sf_dir):
    """The topic as a stream, decoded and landed as files."""
    folder = work_dir(spark, "source")
    _land(A.topic_from_ticks(_ticks(spark, sf_dir)), f"{folder}/topic/ticks")
    records = topic.parse_records(topic.file_topics(spark, f"{folder}/topic/*"))
    running = (
        records.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(records.schema).parquet(f"{folder}/out")


@query
def stream_candles(spark, sf_dir):
    return _streamed(spark, sf_dir, S.stream_candles, WINDOW_MS).drop("month")


@query
def stream_candles_gapfilled(spark, sf_dir):
    return _streamed(spark, sf_dir, S.stream_candles_by_symbol, HOUR_MS).drop("month")


@query
def stream_candles_gapfilled_skewed(spark, sf_dir):
    """The gap fill for hot symbols: trades meet per window first."""
    return _streamed(spark, sf_dir, S.stream_candles_filled, HOUR_MS).drop("month")


@query
def stream_candle_sink(spark, sf_dir):
    return _streamed(spark, sf_dir, S.stream_candles, HOUR_MS)


def _two_runs(spark, sf_dir, first: DataFrame, second: DataFrame) -> tuple[str, str]:
    """Feed ``first``, stop, then resume from the checkpoint with ``second``."""
    folder = work_dir(spark, "restart")
    for i, part in enumerate((first, second)):
        _land(part, f"{folder}/topic/part-{i}")
        _replay(spark, folder, S.stream_candles_by_symbol, f"{folder}/out-{i}", HOUR_MS)
    return f"{folder}/out-0", f"{folder}/out-1"


@query
def restart_resumes(spark, sf_dir):
    """Two runs with a restart between them write what one run writes."""
    ticks = _ticks(spark, sf_dir)
    middle = ticks.agg((F.max("arrival") / 2).cast("long").alias("middle")).scalar()
    records = A.topic_from_ticks(ticks)
    before, after = _two_runs(
        spark,
        sf_dir,
        records.filter(F.col("offset") <= middle),
        records.filter(F.col("offset") > middle).unionByName(_closing_heartbeat(ticks, HOUR_MS)),
    )
    both = candle_table.read_candles(spark, before).unionByName(candle_table.read_candles(spark, after))
    return both.drop("month")


@query
def heartbeat_advances(spark, sf_dir):
    """The candles that only a heartbeat could close: no tick follows them."""
    ticks = _ticks(spark, sf_dir)
    _, after = _two_runs(spark, sf_dir, A.topic_from_ticks(ticks), _closing_heartbeat(ticks, HOUR_MS))
    return candle_table.read_candles(spark, after).drop("month")


# --- streams over many micro-batches

#: Micro-batches of a replay: one run of positions each.
BATCHES = 8
#: Rows that a landed file holds, about.
FILE_ROWS = 250_000


def _land_runs(df: DataFrame, place: str, folder: str) -> int:
    """Each run of positions as files of its own, in order; returns how many files make a run.

    The rows are computed once, split by run and written by as many tasks as a run has files. A run
    with fewer rows than the largest gets empty files, so that this many files are one micro-batch.
    """
    spark, staged = df.sparkSession, work_dir(df.sparkSession, "runs")
    length = df.agg((F.max(place) + 1).alias("length")).first()["length"]
    runs = df.withColumn("_run", F.floor(F.col(place) * BATCHES / F.lit(length)).cast("int"))
    runs.write.partitionBy("_run").parquet(staged)
    held = spark.read.schema(runs.schema).parquet(staged)
    counts = {r["_run"]: r["count"] for r in held.groupBy("_run").count().collect()}
    needed = [max(1, math.ceil(counts.get(i, 0) / FILE_ROWS)) for i in range(BATCHES)]
    for i, files in enumerate(needed):
        part, to = held.filter(F.col("_run") == i).drop("_run"), f"{folder}/run-{i:03d}"
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.parquet(to)
        for _ in range(max(needed) - len(spark.read.schema(df.schema).parquet(to).inputFiles())):
            df.limit(0).coalesce(1).write.mode("append").parquet(to)
    return max(needed)


def _replaying(spark) -> SparkSession:
    """A session for many short micro-batches: state in no more parts than there are cores."""
    return streaming_session(spark, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def _follow(spark, df: DataFrame, place: str, folder: str) -> DataFrame:
    """A stream over ``df``, landed in runs of positions, one per micro-batch."""
    files = _land_runs(df, place, folder)
    return _replaying(spark).readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/run-*")


def _finish(stream: DataFrame, folder: str) -> None:
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()


@query
def stream_readiness(spark, sf_dir):
    """``readiness_by_session`` live: ticks and resets share the order of arrival and the files."""
    events = _events(spark, sf_dir)
    is_reset = F.col("event_type") == "error"
    marked = A.ticks_from_events(events, A.user_symbol()).select("symbol", "timestamp", "arrival")
    marked = marked.join(events.select(F.col("event_id").alias("arrival"), is_reset.alias("reset")), "arrival")
    folder = work_dir(spark, "readiness")
    records = _follow(spark, marked, "arrival", f"{folder}/in")
    fired = live.stream_readiness(records.filter("not reset"), records.filter("reset"))
    _finish(fired, folder)
    return spark.read.schema(live.TRIGGERED).parquet(f"{folder}/out")


@query
def stream_subscriptions(spark, sf_dir):
    """``subscription_audit`` live, and what the registry lists after each micro-batch."""
    log = _subscription_log(spark, sf_dir)
    folder = work_dir(spark, "registry")
    _finish(live.stream_subscriptions(_follow(spark, log, "seq", f"{folder}/in")), folder)
    audit = spark.read.schema(live.AUDITED).parquet(f"{folder}/out")
    parts = [audit.select(F.lit(-1).alias("batch"), "seq", "action", "symbol", "is_noop")]
    for i in range(BATCHES):
        listed = live.list_subscriptions(spark, f"{folder}/checkpoint", i)
        parts.append(listed.select(F.lit(i).alias("batch"), F.col("since").alias("seq"), F.lit("listed").alias("action"), "symbol", F.lit(False).alias("is_noop")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def stream_waiting(spark, sf_dir):
    """``readiness_report`` live on the event clock; a last record without a symbol moves it past all deadlines."""
    requested, signals = _readiness_inputs(spark, sf_dir)
    asked = requested.select("symbol", F.col("started_ms").alias("at"), F.lit(True).alias("request"))
    came = signals.select("symbol", F.col("ready_ms").alias("at"), F.lit(False).alias("request"))
    both = asked.unionByName(came)
    past = both.agg(F.lit(None).cast("string").alias("symbol"), (F.max("at") + READY_WITHIN_S * 1000 + 1).alias("at"), F.lit(False).alias("request"))
    start = both.agg(F.min("at").alias("start")).first()["start"] or 0
    records = both.unionByName(past).select(F.lit("all").alias("run"), "symbol", "at", "request", (F.col("at") - start).alias("place"))
    folder = work_dir(spark, "waiting")
    landed = _follow(spark, records, "place", f"{folder}/in")
    _finish(live.stream_waiting(landed, timeout_s=READY_WITHIN_S, clock="event"), folder)
    out = spark.read.schema(live.WAITED).parquet(f"{folder}/out")
    return out.select("symbol", "started_ms", F.coalesce("elapsed_ms", F.lit(-1).cast("long")).alias("elapsed_ms"), "ready")


@query
def readiness_problem(spark, sf_dir):
    """The error of a run that waits for all users."""
    report = readiness.readiness_report(*_readiness_inputs(spark, sf_dir), timeout_s=READY_WITHIN_S)
    return readiness.readiness_problem(report)


def _reversed_runs(ticks: DataFrame) -> DataFrame:
    """Every 1,000 events arrive in reverse, so that some come after their window was sealed."""
    place = F.col("arrival")
    return ticks.withColumn("arrival", place + 999 - 2 * F.pmod(place, F.lit(1_000)))


def _tagged_run(spark, sf_dir) -> str:
    """Ticks in eight micro-batches through the candles with their rejected ticks, in two tables."""
    folder = work_dir(spark, "tagged")
    ticks = _reversed_runs(_ticks(spark, sf_dir))
    files = _land_runs(A.topic_from_ticks(ticks), "offset", f"{folder}/topic")
    closing = _closing_heartbeat(ticks, HOUR_MS)
    closing.coalesce(1).write.parquet(f"{folder}/topic/run-{BATCHES:03d}")
    records = topic.parse_records(topic.file_topics(_replaying(spark), f"{folder}/topic/run-*", max_files_per_trigger=files))
    running = candle_table.stream_to_tables(
        S.stream_candles_and_late(records, size_ms=HOUR_MS), f"{folder}/out", f"{folder}/late", f"{folder}/checkpoint",
        size_ms=HOUR_MS, trigger={"availableNow": True}, summaries=f"{folder}/summaries",
    )
    running.awaitTermination()
    return folder


@query
def stream_late_ticks(spark, sf_dir):
    """Ticks that a live run rejected, with the first window that was still open."""
    return spark.read.parquet(f"{_tagged_run(spark, sf_dir)}/late")


@query
def stream_candles_beside_late(spark, sf_dir):
    """The candles of the same run: none of the rejected ticks counts."""
    return candle_table.read_candles(spark, f"{_tagged_run(spark, sf_dir)}/out").drop("month")


@query
def stream_write_summary(spark, sf_dir):
    """``write_summary`` of a stream, from the rows its commits logged."""
    folder = work_dir(spark, "summaries")
    ticks = _ticks(spark, sf_dir)
    files = _land_runs(A.topic_from_ticks(ticks), "offset", f"{folder}/topic")
    _closing_heartbeat(ticks, WINDOW_MS).coalesce(1).write.parquet(f"{folder}/topic/run-{BATCHES:03d}")
    records = topic.parse_records(topic.file_topics(_replaying(spark), f"{folder}/topic/run-*", max_files_per_trigger=files))
    running = candle_table.stream_to_table(
        S.stream_candles(records), f"{folder}/out", f"{folder}/checkpoint", trigger={"availableNow": True}, summaries=f"{folder}/summaries"
    )
    running.awaitTermination()
    return candle_table.summary_of(candle_table.read_summaries(spark, f"{folder}/summaries"))
