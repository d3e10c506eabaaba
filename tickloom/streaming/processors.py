"""Per-symbol stateful processors. Prices and quantities are whole 1e-8 units here."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FLAT_CANDLE = (
    "symbol string, start bigint, open bigint, high bigint, low bigint, close bigint, "
    "volume bigint, trades bigint"
)
_COLUMNS = ["symbol", "start", "open", "high", "low", "close", "volume", "trades"]
_PRICES = ["open", "high", "low", "close"]
#: Candles and rejected ticks in one output; the columns of the other kind are 0.
TAGGED = f"tag string, {FLAT_CANDLE}, trade_id bigint, timestamp bigint, arrival bigint, bound bigint"
_TAGGED_COLUMNS = ["tag", *_COLUMNS, "trade_id", "timestamp", "arrival", "bound"]
_CHUNK = 50_000
_INT64_SAFE = 9.2e18


def _flat(symbol: str, first: int, stop: int, size_ms: int, close: int) -> Iterator[pd.DataFrame]:
    """Candles at ``close`` for every window start in [first, stop), in bounded chunks."""
    for begin in range(first, stop, size_ms * _CHUNK):
        starts = np.arange(begin, min(stop, begin + size_ms * _CHUNK), size_ms, dtype="int64")
        frame = pd.DataFrame({"start": starts, "volume": 0, "trades": 0, "symbol": symbol})
        for price in _PRICES:
            frame[price] = close
        yield frame[_COLUMNS]


class GapFillProcessor(StatefulProcessor):
    """Sealed candles in, contiguous candles out."""

    def __init__(self, size_ms: int):
        self._size = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._tail = handle.getValueState("tail", "next_start bigint, close bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (symbol,) = key
        # One row per closed window of this symbol, so a batch holds few.
        candles = pd.concat(list(rows), ignore_index=True).sort_values("start")
        known = self._tail.exists()
        next_start, close = (int(v) for v in self._tail.get()) if known else (None, None)
        for row in candles.itertuples(index=False):
            if next_start is not None:
                yield from _flat(symbol, next_start, row.start, self._size, close)
            next_start, close = int(row.start) + self._size, int(row.close)
        yield candles[_COLUMNS]
        self._tail.update((next_start, close))
        if not known:
            self._handle.registerTimer(next_start + self._size)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (symbol,) = key
        next_start, close = (int(v) for v in self._tail.get())
        watermark = timerValues.getCurrentWatermarkInMs()
        stop = watermark - watermark % self._size
        if next_start < stop:
            yield from _flat(symbol, next_start, stop, self._size, close)
            next_start = stop
            self._tail.update((next_start, close))
        self._handle.registerTimer(next_start + self._size)

    def close(self) -> None:
        pass


#: Columns of a trade while it is folded: window, id, arrival, time, price, quantity.
_TRADE = ["start", "trade_id", "arrival", "timestamp", "price", "quantity"]
#: Trade ids of one state entry: a power of two.
_ID_BITS = 20
#: Trades that wait before they are folded into the first arrivals of the micro-batch.
_FOLD_ROWS = 1 << 16


def _first_arrivals(parts: list[np.ndarray]) -> np.ndarray:
    """One row per (window, trade id), the first to arrive, ordered by both."""
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


class IdRanges:
    """A set of numbers as bounds ``low, high, low, high ...`` of half-open ranges, ascending."""

    def __init__(self, bounds=()):
        self.bounds = np.asarray(bounds, dtype="int64")

    def holds(self, ids: np.ndarray) -> np.ndarray:
        # an odd number of bounds at or below a number means that it lies inside a range
        return np.searchsorted(self.bounds, ids, side="right") % 2 == 1

    def with_new(self, ids: np.ndarray) -> IdRanges:
        """The set with ``ids`` added, none of which it holds; they ascend without repeats."""
        if not len(ids):
            return self
        # a bound that one range ends and another starts with falls out
        bounds = np.sort(np.concatenate([self.bounds, ids, ids + 1]))
        value, times = np.unique(bounds, return_counts=True)
        return IdRanges(value[times % 2 == 1])


def _windows_of(trades: np.ndarray) -> dict[int, tuple]:
    """Window state by start, from trades without duplicates."""
    start, _, arrival, ts, price, quantity = trades.T
    # The first arrival wins among equal timestamps, at either end of the window.
    by_open = np.lexsort((arrival, ts, start))
    by_close = np.lexsort((arrival, -ts, start))
    starts, first = np.unique(start[by_open], return_index=True)
    opening, closing = by_open[first], by_close[first]
    quantities = quantity[by_open]
    if np.add.reduceat(quantities.astype("float64"), first).max() > _INT64_SAFE:
        raise OverflowError("window volume exceeds decimal(18,8)")
    columns = (
        ts[opening],
        price[opening],
        np.maximum.reduceat(price[by_open], first),
        np.minimum.reduceat(price[by_open], first),
        ts[closing],
        price[closing],
        np.add.reduceat(quantities, first),
        np.diff(np.append(first, len(start))),
    )
    return dict(zip(starts.tolist(), zip(*(c.tolist() for c in columns), strict=True), strict=True))


def _merge(held: tuple | None, new: tuple) -> tuple:
    """Window state with later arrivals added."""
    if held is None:
        return new
    opened = held[:2] if held[0] <= new[0] else new[:2]
    closed = held[4:6] if held[4] >= new[4] else new[4:6]
    return (*opened, max(held[2], new[2]), min(held[3], new[3]), *closed, held[6] + new[6], held[7] + new[7])


class CandleProcessor(StatefulProcessor):
    """Ticks in, contiguous candles out; a window is sealed once its candle is out.

    A timer set for a moment already passed fires only in the next micro-batch, so one firing
    seals every window the watermark has passed and then sets a single timer for the next.

    Trade ids run nearly without gaps, so those of a window are kept as ranges, cut into entries of
    ``2**_ID_BITS`` numbers; a micro-batch reads and writes only the entries whose ids it brings. Rows
    are folded chunk by chunk, and what is kept of them in a micro-batch is 48 bytes a trade.

    With ``report_late`` the output is ``TAGGED``: candles, and a row for each tick rejected because
    its window was sealed.
    """

    def __init__(self, size_ms: int, report_late: bool = False):
        self._size = size_ms
        self._report = report_late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # Open windows only: a symbol has one or two in steady state.
        self._windows = handle.getMapState(
            "windows",
            "start bigint",
            "open_ts bigint, open bigint, high bigint, low bigint, close_ts bigint, close bigint, volume bigint, trades bigint",
        )
        self._ids = handle.getMapState("ids", "start bigint, part bigint", "bounds array<bigint>")
        self._sealed = handle.getValueState("sealed", "min_open bigint, last_close bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        (symbol,) = key
        if symbol is None:
            for _ in rows:
                pass
            return
        held = self._open_windows()
        # Spark hands over rows before timers. Windows already due are sealed first, so that a
        # tick arriving after its window's end passed is late here too.
        if held or self._sealed.exists():
            yield from self._seal(symbol, held, timerValues.getCurrentWatermarkInMs())
        sealed = self._sealed.exists()
        min_open = int(self._sealed.get()[0]) if sealed else 0

        taken, waiting, n = np.zeros((0, len(_TRADE)), "int64"), [], 0
        for chunk in rows:
            chunk["start"] = chunk["timestamp"] // self._size * self._size
            late = chunk["start"] < min_open
            if self._report and late.any():
                yield self._late(symbol, chunk[late], min_open)
            waiting.append(chunk.loc[~late, _TRADE].to_numpy(dtype="int64"))
            n += len(waiting[-1])
            if n >= max(_FOLD_ROWS, len(taken)):
                taken, waiting, n = _first_arrivals([taken, *waiting]), [], 0
        taken = self._unseen(_first_arrivals([taken, *waiting]))
        if not len(taken):
            return
        fresh = _windows_of(taken)
        for start, window in fresh.items():
            self._windows.updateValue((start,), _merge(held.get(start), window))
        # After the first seal a timer is always pending; before it, the earliest window needs one.
        earliest = min(fresh)
        if not sealed and earliest < min(held, default=earliest + 1):
            self._handle.registerTimer(earliest + self._size)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (symbol,) = key
        yield from self._seal(symbol, self._open_windows(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _open_windows(self) -> dict[int, tuple]:
        return {int(start): tuple(window) for (start,), window in self._windows.iterator()}

    def _unseen(self, trades: np.ndarray) -> np.ndarray:
        """The trades whose ids their window has not met; their ids are noted."""
        if not len(trades):
            return trades
        entry = np.stack([trades[:, 0], trades[:, 1] >> _ID_BITS], axis=1)
        new = np.flatnonzero(np.concatenate([[True], (entry[1:] != entry[:-1]).any(axis=1)]))
        kept = []
        for low, high in zip(new.tolist(), [*new[1:].tolist(), len(trades)], strict=True):
            at = (int(entry[low, 0]), int(entry[low, 1]))
            known = IdRanges(self._ids.getValue(at)[0] if self._ids.containsKey(at) else ())
            part = trades[low:high]
            part = part[~known.holds(part[:, 1])]
            if len(part):
                self._ids.updateValue(at, (known.with_new(part[:, 1]).bounds.tolist(),))
                kept.append(part)
        return np.concatenate(kept) if kept else trades[:0]

    def _candles(self, frame: pd.DataFrame) -> pd.DataFrame:
        if self._report:
            frame = frame.assign(tag="candle", trade_id=0, timestamp=0, arrival=0, bound=0)[_TAGGED_COLUMNS]
        return frame

    def _late(self, symbol: str, ticks: pd.DataFrame, bound: int) -> pd.DataFrame:
        unused = dict.fromkeys([*_PRICES, "volume", "trades"], 0)
        frame = ticks[["start", "trade_id", "timestamp", "arrival"]].assign(tag="late", symbol=symbol, bound=bound, **unused)
        return frame[_TAGGED_COLUMNS]

    def _seal(self, symbol: str, held: dict[int, tuple], watermark: int) -> Iterator[pd.DataFrame]:
        """Emit every window the watermark has passed, removing it from ``held`` and the state."""
        stop = watermark - watermark % self._size
        cursor, close = min(held, default=stop), None
        if self._sealed.exists():
            cursor, close = (int(v) for v in self._sealed.get())
        if cursor >= stop:
            return
        due = sorted(start for start in held if start < stop)
        traded = []
        for start in due:
            yield from map(self._candles, _flat(symbol, cursor, start, self._size, close))
            _, opened, high, low, _, close, volume, trades = held.pop(start)
            traded.append((symbol, start, opened, high, low, close, volume, trades))
            cursor = start + self._size
        if traded:
            yield self._candles(pd.DataFrame(traded, columns=_COLUMNS))
        yield from map(self._candles, _flat(symbol, cursor, stop, self._size, close))
        if due:
            for start in due:
                self._windows.removeKey((start,))
            for at in [(int(start), int(part)) for start, part in self._ids.keys() if start < stop]:
                self._ids.removeKey(at)
        self._sealed.update((stop, close))
        self._handle.registerTimer(stop + self._size)
