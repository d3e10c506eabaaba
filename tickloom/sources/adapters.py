"""Views of the benchmark tables as ticks, logs and landed files."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.streams import stream_name
from tickloom.functions.timing import utc_date
from tickloom.plans.backfill import archive_path
from tickloom.schema import ARCHIVE_COLUMNS, HEARTBEAT_TOPIC, PRICE, TICK_TOPIC
from tickloom.sinks.topic import payload_columns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks_from_events(events: DataFrame, symbol: Column | None = None) -> DataFrame:
    """Each event as a trade of its event type; works on batch and streaming frames."""
    return events.select(
        (F.upper("event_type") if symbol is None else symbol).alias("symbol"),
        F.col("value").cast(PRICE).alias("price"),
        F.get_json_object("props", "$.k").cast(PRICE).alias("quantity"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("event_id").alias("trade_id"),
        F.col("event_id").alias("arrival"),
    )


def user_symbol() -> Column:
    return F.concat(F.lit("U"), F.col("user_id").cast("string"))


def topic_from_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks as topic records with their arrival as offset."""
    return ticks.select(
        *payload_columns(),
        F.lit(TICK_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("arrival").alias("offset"),
        F.timestamp_millis("timestamp").alias("timestamp"),
    )


def heartbeat_topic(timestamps: DataFrame, offset: Column) -> DataFrame:
    """A heartbeat record per row of ``timestamp``."""
    value = F.to_json(F.struct(F.lit("heartbeat").alias("type"), "timestamp"))
    return timestamps.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(HEARTBEAT_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        offset.alias("offset"),
        F.timestamp_millis("timestamp").alias("timestamp"),
    )


def feed_messages(ticks: DataFrame) -> DataFrame:
    """Ticks as the exchange's JSON messages in column ``raw``."""
    data = F.struct(
        F.lit("trade").alias("e"),
        F.col("symbol").alias("s"),
        F.col("price").cast("string").alias("p"),
        F.col("quantity").cast("string").alias("q"),
        F.col("timestamp").alias("T"),
        F.col("trade_id").alias("t"),
    )
    return ticks.select(F.to_json(F.struct(stream_name(F.col("symbol")).alias("stream"), data.alias("data"))).alias("raw"))


def acknowledgements(ids: DataFrame) -> DataFrame:
    """Replies to subscribe requests, as they appear among the trades."""
    return ids.select(F.concat(F.lit('{"result":null,"id":'), F.col("id").cast("string"), F.lit("}")).alias("raw"))


def inclusive_end(candles: DataFrame) -> DataFrame:
    """Klines as the exchange gives them: closing one millisecond before the next."""
    return candles.withColumn("end", F.col("end") - 1)


def kline_payloads(candles: DataFrame) -> DataFrame:
    """REST responses: one JSON list of positional klines per symbol and UTC day."""
    text = [F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")]
    fields = [F.col("start").cast("string"), *text, F.col("end").cast("string"), F.lit("0"), F.col("trades").cast("string")]
    kline = F.array(*fields, F.lit("0"), F.lit("0"), F.lit("0"))
    return (
        candles.withColumn("_day", utc_date(F.col("start")))
        .groupBy("symbol", "_day")
        .agg(F.to_json(F.collect_list(kline)).alias("payload"))
        .select("symbol", "payload")
    )


def archive_rows(candles: DataFrame) -> DataFrame:
    """Candles under the archive's column names, with two it does not use."""
    named = [F.col(c).alias(archive) for c, archive in ARCHIVE_COLUMNS.items()]
    return candles.select("symbol", *named, F.lit("0").alias("quote_volume"), F.lit("0").alias("ignore"))


def zipped_archives(candles: DataFrame, base: str) -> DataFrame:
    """One zipped CSV per symbol and UTC day, as (path, content); bounded by a day of candles."""
    return zipped_rows(archive_rows(candles), base)


def zipped_rows(rows: DataFrame, base: str) -> DataFrame:
    """``zipped_archives`` of rows under the archive's column names."""
    columns = [c for c in rows.columns if c != "symbol"]
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in columns])
    day = utc_date(F.col("open_time")).cast("string")
    texts = (
        rows.groupBy("symbol", day.alias("date"))
        .agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))
    )
    header = ",".join(columns)
    return texts.select(
        archive_path(base, F.lit("daily"), F.col("symbol"), F.col("date")).alias("path"),
        _zip_text(F.concat(F.lit(header + "\n"), "body", F.lit("\n"))).alias("content"),
    )


@F.pandas_udf(T.BinaryType())
def _zip_text(texts: pd.Series) -> pd.Series:
    def pack(text: str) -> bytes:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("klines.csv", text)
        return buffer.getvalue()

    return texts.map(pack)
