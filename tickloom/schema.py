"""Record layouts shared by every source, operator and sink."""

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 8)

# Defaults every writer and reader of the candle table agrees on.
WINDOW_MS = 60_000
WATERMARK_DELAY_MS = 500
DAY_MS = 86_400_000
PAGE_ROWS = 1_000
READY_TIMEOUT_S = 3_600

TICK = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", PRICE),
        T.StructField("quantity", PRICE),
        T.StructField("timestamp", T.LongType()),
        T.StructField("trade_id", T.LongType()),
    ]
)

# A tick or heartbeat with its position in the topic. Heartbeats have no symbol.
RECORD = T.StructType(
    [T.StructField("kind", T.StringType()), *TICK.fields, T.StructField("arrival", T.LongType())]
)

CANDLE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("open", PRICE),
        T.StructField("high", PRICE),
        T.StructField("low", PRICE),
        T.StructField("close", PRICE),
        T.StructField("volume", PRICE),
        T.StructField("trades", T.LongType()),
    ]
)
CANDLE_COLUMNS = CANDLE.fieldNames()

STORED_CANDLE = T.StructType([*CANDLE.fields, T.StructField("month", T.IntegerType())])
PARTITION_COLUMNS = ["symbol", "month"]

# What the Kafka source hands over; file-backed topics use the same columns.
TOPIC = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Topic names.
TICK_TOPIC = "raw_ticks"
HEARTBEAT_TOPIC = "_heartbeats"

# Zero-based positions in a REST kline.
KLINE_POSITIONS = {
    "start": 0,
    "open": 1,
    "high": 2,
    "low": 3,
    "close": 4,
    "volume": 5,
    "end": 6,
    "trades": 8,
}

# Header names of an archive CSV, per candle column.
ARCHIVE_COLUMNS = {
    "start": "open_time",
    "open": "open",
    "high": "high",
    "low": "low",
    "close": "close",
    "volume": "volume",
    "end": "close_time",
    "trades": "count",
}
