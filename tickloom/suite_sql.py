"""The same queries in SQL, for comparison on another engine."""

from __future__ import annotations

HOUR_MS = 3_600_000
DAY_MS = 86_400_000
MINUTE_MS = 60_000
DELAY_MS = 500


def _ticks(symbol: str = "upper(event_type)", where: str = "true") -> str:
    return f"""ticks AS (
      SELECT {symbol} AS symbol, CAST(value AS DECIMAL(18,8)) AS price,
             CAST(props->>'$.k' AS DECIMAL(18,8)) AS quantity,
             epoch_us(ts) // 1000 AS "timestamp", event_id AS trade_id, event_id AS arrival,
             user_id, event_type
      FROM events WHERE {where})"""


USER = "'U' || user_id"


def _candles(size: int, source: str = "ticks", name: str = "candles") -> str:
    return f"""{name} AS (
      SELECT symbol, start, start + {size} AS "end",
             first(price ORDER BY "timestamp", arrival) AS open, max(price) AS high, min(price) AS low,
             first(price ORDER BY "timestamp" DESC, arrival) AS close,
             CAST(sum(quantity) AS DECIMAL(18,8)) AS volume, count(*) AS trades
      FROM (SELECT *, "timestamp" // {size} * {size} AS start FROM {source}
            QUALIFY row_number() OVER (PARTITION BY symbol, start, trade_id ORDER BY arrival) = 1)
      GROUP BY symbol, start)"""


def _filled(size: int, horizon: str) -> str:
    """Contiguous candles from ``candles``, up to ``horizon``."""
    return f"""horizon AS (SELECT ({horizon}) // {size} * {size} AS stop),
    sealed AS (SELECT c.* FROM candles c, horizon WHERE "end" <= stop),
    spine AS (
      SELECT symbol, unnest(range(min(start), any_value(stop), {size})) AS start
      FROM sealed, horizon GROUP BY symbol),
    filled AS (
      SELECT symbol, start, start + {size} AS "end",
             coalesce(open, carried) AS open, coalesce(high, carried) AS high,
             coalesce(low, carried) AS low, carried AS close,
             CAST(coalesce(volume, 0) AS DECIMAL(18,8)) AS volume, coalesce(trades, 0) AS trades
      FROM (SELECT symbol, start, open, high, low, volume, trades,
                   last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY start) AS carried
            FROM spine LEFT JOIN sealed USING (symbol, start)))"""


WATERMARK = f'SELECT max("timestamp") - {DELAY_MS} - 1 FROM ticks'


def _after_last_window(size: int) -> str:
    return f'SELECT max("timestamp") // {size} * {size} + {size} FROM ticks'


COLUMNS = 'symbol, start, "end", open, high, low, close, volume, trades'
MONTH = (
    "CAST(year(make_timestamp(start * 1000)) * 100 + month(make_timestamp(start * 1000)) AS INTEGER) AS month"
)
KLINES = f'SELECT symbol, start, "end" - 1 AS "end", open, high, low, close, volume, trades FROM candles'


def _iso(ms: str) -> str:
    whole = f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%dT%H:%M:%S')"
    part = f"CASE WHEN ({ms}) % 1000 = 0 THEN '' ELSE printf('.%03d000', ({ms}) % 1000) END"
    return f"{whole} || {part} || '+00:00'"


_MINUTES = f"WITH {_ticks()}, {_candles(MINUTE_MS)}"
_HOURS = f"WITH {_ticks()}, {_candles(HOUR_MS)}"

_SAME_DAY = f"""WITH {_ticks()}, {_candles(MINUTE_MS)}, {_filled(MINUTE_MS, WATERMARK)},
    requests AS (
      SELECT symbol, "timestamp" // {DAY_MS} * {DAY_MS} AS day,
             max("timestamp") // {MINUTE_MS} * {MINUTE_MS} AS until
      FROM ticks GROUP BY ALL),
    ranked AS (
      SELECT until, day, f.* REPLACE (f."end" - 1 AS "end"),
             row_number() OVER w - 1 AS n, lag(f."end") OVER w AS resume
      FROM filled f JOIN requests r
        ON f.symbol = r.symbol AND f.start BETWEEN day AND until AND day < until
      WINDOW w AS (PARTITION BY f.symbol, until ORDER BY start)),
    paged AS (
      SELECT *, n // 1000 + 1 AS page FROM ranked
      WHERE NOT (n % 1000 = 0 AND n > 0 AND resume >= until))"""

_REPEATED = f"WITH {_ticks()}, repeated AS (SELECT * REPLACE (user_id AS trade_id) FROM ticks)"

_SHUFFLED = """shuffled AS (
      SELECT * REPLACE (arrival - arrival % 50 + 49 - arrival % 50 AS arrival) FROM ticks)"""
_LATE = f"""flagged AS (
      SELECT *, coalesce(first_end <= watermark AND start < watermark // {MINUTE_MS} * {MINUTE_MS}, false) AS is_late
      FROM (SELECT *, min(start + {MINUTE_MS}) OVER (PARTITION BY symbol ORDER BY arrival
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS first_end,
                   max("timestamp") OVER (ORDER BY arrival
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY_MS} - 1 AS watermark
            FROM (SELECT *, "timestamp" // {MINUTE_MS} * {MINUTE_MS} AS start FROM shuffled)))"""


def _trigger(source: str, keys: str) -> str:
    return f"""minutes AS (
      SELECT *, "timestamp" // {MINUTE_MS} * {MINUTE_MS} AS minute FROM {source}),
    firsts AS (
      SELECT *, first_value(minute) OVER (PARTITION BY {keys} ORDER BY arrival) AS first_minute FROM minutes)
    SELECT {keys}, first_minute, minute AS until, arrival AS fired_at FROM firsts
    WHERE minute >= first_minute + {2 * MINUTE_MS}
    QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY arrival) = 1"""


_READINESS = f"""WITH {_ticks(USER)},
    requested AS (SELECT symbol, min("timestamp") AS started_ms FROM ticks GROUP BY symbol),
    signals AS (
      SELECT symbol, min("timestamp") AS ready_ms FROM ticks JOIN requested USING (symbol)
      WHERE event_type <> 'error' AND "timestamp" > started_ms GROUP BY symbol),
    report AS (
      SELECT symbol, started_ms,
             CASE WHEN ready_ms - started_ms <= 54000000 THEN ready_ms - started_ms ELSE -1 END AS elapsed_ms,
             coalesce(ready_ms - started_ms <= 54000000, false) AS ready
      FROM requested LEFT JOIN signals USING (symbol))"""

_LOG = """WITH log AS (
      SELECT event_id AS seq, 'U' || user_id AS symbol,
             CASE WHEN event_type IN ('signup', 'purchase') THEN 'subscribe' ELSE 'unsubscribe' END AS action
      FROM events)"""

_CATALOG = """WITH held AS (
      SELECT 'C' || c_custkey AS symbol,
             CASE WHEN c_acctbal > 0 THEN 'available' ELSE 'unavailable' END AS state FROM customer),
    asked AS (
      SELECT 'C' || o_custkey AS symbol FROM orders
      UNION SELECT 'S' || s_suppkey FROM supplier)"""

_PATH = "'archive/' || \"interval\" || '/klines/' || symbol || '/1m/' || symbol || '-1m-' || date || '.zip'"

_PLANNED = f"""WITH {_ticks()}, {_candles(HOUR_MS)},
    days AS (SELECT symbol, CAST(make_timestamp("timestamp" * 1000) AS DATE) AS day FROM ticks),
    ranges AS (SELECT symbol, min(day) - INTERVAL 2 DAY AS lo, max(day) AS hi FROM days GROUP BY symbol),
    spread AS (SELECT symbol, CAST(unnest(range(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM ranges),
    whole AS (SELECT *, count(*) OVER (PARTITION BY symbol, date_trunc('month', day)) = day(last_day(day)) AS whole FROM spread),
    plan AS (
      SELECT DISTINCT symbol, CASE WHEN whole THEN 'monthly' ELSE 'daily' END AS "interval",
             CASE WHEN whole THEN strftime(day, '%Y-%m') ELSE strftime(day, '%Y-%m-%d') END AS date FROM whole),
    landed AS (
      SELECT symbol, strftime(make_timestamp(start * 1000), '%Y-%m-%d') AS date, count(*) AS n,
             bool_or(hour(make_timestamp(start * 1000)) = 7) AS at_seven
      FROM candles GROUP BY ALL)"""

_MS = "(epoch_us(o_orderdate) // 1000 + o_orderkey)"

ORACLE: dict[str, str] = {
    "parse_records": f"""WITH {_ticks()}
      SELECT CASE WHEN event_type = 'view' THEN 'heartbeat' ELSE 'tick' END AS kind,
             CASE WHEN event_type = 'view' THEN '' ELSE symbol END AS symbol,
             CASE WHEN event_type = 'view' THEN CAST(0 AS DECIMAL(18,8)) ELSE price END AS price,
             CASE WHEN event_type = 'view' THEN CAST(0 AS DECIMAL(18,8)) ELSE quantity END AS quantity,
             "timestamp", CASE WHEN event_type = 'view' THEN -1 ELSE trade_id END AS trade_id, arrival
      FROM ticks""",
    "normalize_trades": f"""WITH {_ticks()}
      SELECT symbol AS routing_symbol, symbol, price, quantity, "timestamp", trade_id FROM ticks""",
    "tick_payload_json": f"""WITH {_ticks()}
      SELECT symbol AS key, '{{"symbol":"' || symbol || '","price":"' || price || '","quantity":"' || quantity
             || '","timestamp":' || "timestamp" || ',"trade_id":' || trade_id || '}}' AS value FROM ticks""",
    "klines_json_to_candles": f"{_HOURS} {KLINES}",
    "klines_csv_to_candles": f"{_HOURS} {KLINES}",
    "klines_zip_to_candles": f"{_HOURS} {KLINES}",
    "backfill_file_report": f"""{_PLANNED}
      SELECT symbol, "interval", date, {_PATH} AS path, status, CASE WHEN status = 'ok' THEN n ELSE 0 END AS rows
      FROM (SELECT *, CASE WHEN n IS NULL THEN 'missing' WHEN symbol = 'ERROR' OR symbol = 'CLICK' AND at_seven THEN 'failed' ELSE 'ok' END AS status
            FROM plan LEFT JOIN landed USING (symbol, date))""",
    "backfill_job_totals": f"""{_PLANNED}
      SELECT symbol, CAST(sum(coalesce(n, 0)) AS BIGINT) AS candles, count(*) FILTER ("interval" = 'monthly') AS monthly_files,
             count(*) FILTER ("interval" = 'daily') AS daily_files, count(*) FILTER (n IS NULL) AS missing_files, CAST(0 AS BIGINT) AS failed_files
      FROM plan LEFT JOIN landed USING (symbol, date) GROUP BY symbol""",
    "same_day_candles": f"{_SAME_DAY} SELECT until, {COLUMNS} FROM paged",
    "same_day_pages": f"""{_SAME_DAY}
      SELECT symbol, until, page,
             min(CASE WHEN n = 0 THEN day WHEN n % 1000 = 0 THEN resume END) AS requested_from,
             count(*) AS rows, min(start) AS first_start, max("end") AS last_end
      FROM paged GROUP BY symbol, until, page""",
    "bucket_ticks": f"""WITH {_ticks()}
      SELECT symbol, price, quantity, "timestamp", trade_id, arrival,
             "timestamp" // {MINUTE_MS} * {MINUTE_MS} AS start,
             "timestamp" // {MINUTE_MS} * {MINUTE_MS} + {MINUTE_MS} AS "end" FROM ticks""",
    "candles": f"{_MINUTES} SELECT {COLUMNS} FROM candles",
    "candles_colocated": f"{_MINUTES} SELECT {COLUMNS} FROM candles",
    "candles_unique_ids": f"{_MINUTES} SELECT {COLUMNS} FROM candles",
    "candles_ties": f"""WITH {_ticks()},
      tied AS (SELECT * REPLACE ("timestamp" // 600000 * 600000 AS "timestamp") FROM ticks),
      {_candles(HOUR_MS, "tied")} SELECT {COLUMNS} FROM candles""",
    "dedup_ticks": f"""{_REPEATED}
      SELECT symbol, "timestamp" // {DAY_MS} * {DAY_MS} AS start, trade_id, price, quantity, "timestamp", arrival
      FROM repeated QUALIFY row_number() OVER (PARTITION BY symbol, start, trade_id ORDER BY arrival) = 1""",
    "candles_dedup": f"{_REPEATED}, {_candles(DAY_MS, 'repeated')} SELECT {COLUMNS} FROM candles",
    "to_candle_schema": f"{_MINUTES} SELECT {COLUMNS} FROM candles",
    "add_month": f"{_MINUTES} SELECT {COLUMNS}, {MONTH} FROM candles",
    "candles_gapfilled": f"{_MINUTES}, {_filled(MINUTE_MS, WATERMARK)} SELECT {COLUMNS} FROM filled",
    "late_ticks": f"""WITH {_ticks()}, {_SHUFFLED}, {_LATE}
      SELECT symbol, trade_id, "timestamp", arrival, start, is_late FROM flagged""",
    "live_candles": f"""WITH {_ticks()}, {_SHUFFLED}, {_LATE},
      taken AS (SELECT * EXCLUDE (start) FROM flagged WHERE NOT is_late),
      {_candles(MINUTE_MS, "taken")}, {_filled(MINUTE_MS, WATERMARK)} SELECT {COLUMNS} FROM filled""",
    "readiness_trigger": f"WITH {_ticks(USER)}, {_trigger('ticks', 'symbol')}",
    "readiness_by_session": f"""WITH {_ticks(USER)},
      counted AS (
        SELECT *, CAST(coalesce(sum(CAST(event_type = 'error' AS INTEGER)) OVER (
          PARTITION BY symbol ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS session
        FROM ticks),
      sessions AS (SELECT * FROM counted WHERE event_type <> 'error'),
      {_trigger("sessions", "symbol, session")}""",
    "readiness_report": f"{_READINESS} SELECT symbol, started_ms, elapsed_ms, ready FROM report",
    "pending_symbols": f"{_READINESS} SELECT symbol FROM report WHERE NOT ready",
    "subscription_audit": f"""{_LOG}
      SELECT seq, action, symbol, (action = 'subscribe') = coalesce(
             lag(action) OVER (PARTITION BY symbol ORDER BY seq) = 'subscribe', false) AS is_noop FROM log""",
    "active_symbols": f"{_LOG} SELECT symbol FROM log GROUP BY symbol HAVING arg_max(action, seq) = 'subscribe'",
    "catalog_upsert": f"""{_CATALOG}
      SELECT symbol, CASE WHEN symbol IN (SELECT symbol FROM asked) THEN 'unavailable' ELSE state END AS state
      FROM held FULL JOIN asked USING (symbol)""",
    "catalog_mark_available": f"""{_CATALOG}
      SELECT symbol, CASE WHEN symbol IN (SELECT symbol FROM asked) THEN 'available' ELSE state END AS state FROM held""",
    "catalog_gated": f"""{_READINESS}, {_CATALOG.removeprefix("WITH ")},
      facts AS (SELECT (SELECT bool_and(ready) FROM report) AS in_time, (SELECT count(ready_ms) = count(*) FROM requested LEFT JOIN signals USING (symbol)) AS ever,
        (SELECT bool_and(o_totalprice > 0) FROM orders) AS ended, (SELECT bool_and(o_totalprice > 10000) FROM orders) AS strict),
      gates AS (SELECT 'done' AS gate, ever AND ended AS open FROM facts
        UNION ALL SELECT 'timeout', in_time AND ended FROM facts UNION ALL SELECT 'failed job', ever AND strict FROM facts)
      SELECT symbol, gate, CASE WHEN open AND symbol IN (SELECT symbol FROM asked) THEN 'available' ELSE state END AS state
      FROM held, gates""",
    "stream_names": """SELECT upper(c_name) AS symbol, lower(c_name) || '@trade' AS stream,
      upper(split_part(lower(c_name) || '@trade', '@', 1)) AS routing_symbol, left(c_name, 8) AS short_id FROM customer""",
    "subscribe_messages": """SELECT p_partkey,
      'Subscribed to ' || replace(upper(p_name), ' ', ', ') AS subscribed,
      'Unsubscribed from ' || replace(upper(p_name), ' ', ', ') AS unsubscribed FROM part""",
    "onboarding_ranges": f"""WITH {_ticks(USER)}, {_candles(HOUR_MS)}
      SELECT symbol, strftime(make_timestamp(min(start) * 1000), '%Y-%m-%d') AS start_date, '2024-02-01' AS end_date
      FROM candles GROUP BY symbol""",
    "download_plan": f"""WITH ranges AS (
        SELECT 'C' || o_custkey AS symbol, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
        FROM orders GROUP BY o_custkey),
      days AS (SELECT symbol, CAST(unnest(range(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM ranges),
      marked AS (
        SELECT symbol, day, count(*) OVER (PARTITION BY symbol, date_trunc('month', day))
               = day(last_day(day)) AS whole FROM days),
      files AS (
        SELECT DISTINCT symbol, CASE WHEN whole THEN 'monthly' ELSE 'daily' END AS "interval",
               CASE WHEN whole THEN strftime(day, '%Y-%m') ELSE strftime(day, '%Y-%m-%d') END AS date FROM marked)
      SELECT symbol, "interval", date, {_PATH} AS path FROM files""",
    "date_functions": f"""SELECT o_orderkey, {_iso(_MS)} AS iso,
      strftime(make_timestamp({_MS} * 1000), '%Y-%m-%d') AS day, {_MS} // {DAY_MS} * {DAY_MS} AS midnight FROM orders""",
    "append_candles": f"{_MINUTES} SELECT {COLUMNS}, {MONTH} FROM candles",
    "append_candles_named": f"{_MINUTES} SELECT {COLUMNS}, {MONTH} FROM candles",
    "append_nothing": f"{_MINUTES} SELECT count(*) AS held, CAST(sum(trades) AS BIGINT) AS trades, false AS wrote FROM candles",
    "candle_spans": f"""{_MINUTES}
      SELECT symbol, count(*) AS count, min(start) AS first, max(start) AS last FROM candles GROUP BY symbol""",
    "insert_into_created_table": f"{_HOURS} SELECT {COLUMNS}, {MONTH} FROM candles",
    "write_summary": f"""{_MINUTES}
      SELECT string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols, count(*) AS count,
             {_iso("min(start)")} AS start, {_iso(f"max(start) + {MINUTE_MS}")} AS "end" FROM candles""",
    "write_summary_by_symbol": f"""{_MINUTES}
      SELECT symbol, count(*) AS count, {_iso("min(start)")} AS start,
             {_iso(f"max(start) + {MINUTE_MS}")} AS "end" FROM candles GROUP BY symbol""",
    "candles_all_sources": f"""{_HOURS}, klines AS ({KLINES})
      SELECT 'stream' AS source, {COLUMNS} FROM candles
      UNION ALL SELECT 'rest', {COLUMNS} FROM klines UNION ALL SELECT 'archive', {COLUMNS} FROM klines""",
    "source_ticks": f"""WITH {_ticks()}
      SELECT 'tick' AS kind, symbol, price, quantity, "timestamp", trade_id, arrival FROM ticks""",
    "stream_candles": f"{_MINUTES} SELECT {COLUMNS} FROM candles",
    "stream_candles_gapfilled": f"{_HOURS}, {_filled(HOUR_MS, _after_last_window(HOUR_MS))} SELECT {COLUMNS} FROM filled",
    "stream_candles_gapfilled_skewed": f"{_HOURS}, {_filled(HOUR_MS, _after_last_window(HOUR_MS))} SELECT {COLUMNS} FROM filled",
    "stream_candle_sink": f"{_HOURS} SELECT {COLUMNS}, {MONTH} FROM candles",
    "restart_resumes": f"{_HOURS}, {_filled(HOUR_MS, _after_last_window(HOUR_MS))} SELECT {COLUMNS} FROM filled",
    "heartbeat_advances": f"""{_HOURS}, {_filled(HOUR_MS, _after_last_window(HOUR_MS))}
      SELECT {COLUMNS} FROM filled WHERE "end" > (SELECT max("timestamp") - {DELAY_MS} FROM ticks)""",
}

#: Micro-batches of a replay: runs of equal length in the order of arrival.
_RUNS = 8


def _run(place: str, source: str) -> str:
    return f"{place} * {_RUNS} // (SELECT max({place}) + 1 FROM {source})"


def _rejected(size: int) -> str:
    """``judged``: each tick with the bound below which windows were sealed when its micro-batch began."""
    return f"""reversed AS (SELECT * REPLACE (arrival + 999 - 2 * (arrival % 1000) AS arrival) FROM ticks),
    placed AS (SELECT *, {_run("arrival", "reversed")} AS run, "timestamp" // {size} * {size} AS start FROM reversed),
    marks AS (SELECT run, (max(max("timestamp")) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY_MS})
                // {size} * {size} AS stop FROM placed GROUP BY run),
    firsts AS (SELECT symbol, run, min(start) AS first FROM placed GROUP BY ALL),
    judged AS (
      SELECT p.*, CASE WHEN (SELECT min(first) FROM firsts f WHERE f.symbol = p.symbol AND f.run < p.run) < stop THEN stop ELSE 0 END AS bound
      FROM placed p JOIN marks USING (run))"""


ORACLE |= {
    "stream_readiness": ORACLE["readiness_by_session"],
    "stream_subscriptions": f"""{_LOG}, placed AS (SELECT *, {_run("seq", "log")} AS run FROM log),
      audit AS (SELECT *, (action = 'subscribe') = coalesce(lag(action) OVER (PARTITION BY symbol ORDER BY seq) = 'subscribe', false) AS is_noop
        FROM placed),
      runs AS (SELECT unnest(range({_RUNS})) AS batch),
      listed AS (
        SELECT batch, symbol, max(seq) FILTER (action = 'subscribe' AND NOT is_noop) AS seq, arg_max(action, seq) AS last
        FROM runs JOIN audit ON run <= batch GROUP BY batch, symbol)
      SELECT -1 AS batch, seq, action, symbol, is_noop FROM audit
      UNION ALL SELECT batch, seq, 'listed', symbol, false FROM listed WHERE last = 'subscribe'""",
    "stream_waiting": ORACLE["readiness_report"],
    "readiness_problem": f"""{_READINESS}
      SELECT CASE WHEN count(*) FILTER (NOT ready) > 0 THEN 'not ready: ' || string_agg(symbol, ', ' ORDER BY symbol) FILTER (NOT ready)
             || '; slowest ready after ms: ' || coalesce(CAST(max(elapsed_ms) FILTER (ready) AS VARCHAR), 'none') END AS problem
      FROM report""",
    "stream_late_ticks": f"""WITH {_ticks()}, {_rejected(HOUR_MS)}
      SELECT symbol, trade_id, "timestamp", arrival, start, bound, CAST(run AS BIGINT) AS batch_id FROM judged WHERE start < bound""",
    "stream_candles_beside_late": f"""WITH {_ticks()}, {_rejected(HOUR_MS)},
      taken AS (SELECT * EXCLUDE (start) FROM judged WHERE start >= bound),
      {_candles(HOUR_MS, "taken")}, {_filled(HOUR_MS, _after_last_window(HOUR_MS))} SELECT {COLUMNS} FROM filled""",
    "stream_write_summary": ORACLE["write_summary"],
}
