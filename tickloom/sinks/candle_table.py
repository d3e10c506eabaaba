"""The candle table, partitioned by symbol and month, and its readers."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.timing import iso_utc, month_key
from tickloom.operators.candles import add_month, to_candle_schema
from tickloom.schema import CANDLE_COLUMNS, PARTITION_COLUMNS, STORED_CANDLE, WINDOW_MS
from tickloom.streaming.candles import candle_rows, late_rows

# Fixed value: isolation level of a new Delta table.
#: Folder level of a table whose appends have names.
COMMIT = "commit"
_DELTA_PROPERTIES = {"delta.isolationLevel": "SnapshotIsolation"}


def to_stored(candles: DataFrame) -> DataFrame:
    """Candle schema plus ``month``, in table order."""
    return add_month(to_candle_schema(candles)).select(*STORED_CANDLE.fieldNames())


def append_candles(
    candles: DataFrame, path: str, *, file_format: str = "parquet", options: dict | None = None, commit: str | None = None
) -> dict | None:
    """Append to the table at ``path``; the first append lays it out. Zero rows write no data.

    With ``commit`` the rows go into a folder of that name, and an append repeated under the same name
    replaces the first: on storage without transactions each row is there once. All appends to such
    a table need a name; ``read_candles`` finds them.

    Returns the summary of the write as in ``write_summary``, with ``write_ms``, or None where no rows
    were written. It is observed by the tasks that write, so it costs no second pass and counts a
    repeated task once.

    The rebalance lets AQE merge small (symbol, month) shuffles into one task and split a hot one,
    so partitions get few files without a task per partition. Rows are sorted by ``start`` within
    a file, which keeps its row-group statistics useful.
    """
    rows = (
        to_stored(candles)
        .hint("rebalance", *PARTITION_COLUMNS)
        .sortWithinPartitions(*PARTITION_COLUMNS, "start")
    )
    seen = Observation()
    rows = rows.observe(
        seen,
        F.count(F.lit(1)).alias("count"),
        F.min("start").alias("first"),
        F.max("start").alias("last"),
        F.collect_set("symbol").alias("symbols"),
    )
    began = time.monotonic()
    writer = rows.write.format(file_format).mode("overwrite" if commit else "append").partitionBy(*PARTITION_COLUMNS)
    writer.options(**(options or {})).save(f"{path}/{COMMIT}={commit}" if commit else path)
    found = seen.get
    if not found["count"]:
        return None
    return {
        "symbols": ",".join(sorted(found["symbols"])),
        "count": found["count"],
        "start": _iso(found["first"]),
        "end": _iso(found["last"] + WINDOW_MS),
        "write_ms": int((time.monotonic() - began) * 1000),
    }


def _iso(ms: int) -> str:
    """One moment as ``iso_utc`` writes it."""
    return (dt.datetime(1970, 1, 1, tzinfo=dt.UTC) + dt.timedelta(milliseconds=ms)).isoformat()


SUMMARY = "batch_id bigint, symbols string, count bigint, start string, end string, write_ms bigint"


def log_summary(spark: SparkSession, summary: dict | None, path: str, batch_id: int | None = None) -> None:
    """Append a write's summary as one row to the table of summaries at ``path``; None adds none."""
    if summary:
        row = (batch_id, *(summary[c] for c in ("symbols", "count", "start", "end", "write_ms")))
        spark.createDataFrame([row], SUMMARY).coalesce(1).write.mode("append").parquet(path)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY).parquet(path)


def summary_of(summaries: DataFrame) -> DataFrame:
    """One row, as from ``write_summary``, for all writes logged together."""
    symbols = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split("symbols", ",")))))
    return summaries.agg(
        F.array_join(symbols, ",").alias("symbols"), F.sum("count").alias("count"), F.min("start").alias("start"), F.max("end").alias("end")
    )


def create_candle_table(spark: SparkSession, name: str, *, file_format: str = "parquet", location: str | None = None) -> None:
    """Register the table in the catalog unless it is there; layout is set at creation only. Its
    files lie at ``location``, or in the warehouse."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STORED_CANDLE.fields)
    place = f" LOCATION '{location}'" if location else ""
    properties = ""
    if file_format == "delta":
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in _DELTA_PROPERTIES.items())
        properties = f" TBLPROPERTIES ({pairs})"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING {file_format} "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}){place}{properties}"
    )


def insert_candles(candles: DataFrame, name: str) -> None:
    """Append to a catalog table made by ``create_candle_table``."""
    # Inserts go by position, and a catalog table keeps its partition columns last.
    order = candles.sparkSession.table(name).columns
    to_stored(candles).select(*order).hint("rebalance", *PARTITION_COLUMNS).write.insertInto(name)


def read_candles(spark: SparkSession, path: str, *, file_format: str = "parquet") -> DataFrame:
    """The stored table. The schema is given, since a symbol such as ``1000`` read from a folder
    name would otherwise turn into a number."""
    reader = spark.read.format(file_format)
    if file_format != "delta":
        # the level of named appends is there or not; with the schema given it is a column to drop
        reader = reader.schema(T.StructType([*STORED_CANDLE.fields, T.StructField(COMMIT, T.StringType())]))
    return reader.load(path).select(*STORED_CANDLE.fieldNames())


def candle_spans(spark: SparkSession, path: str) -> DataFrame:
    """``symbol, count, first, last`` of the stored Parquet table, from the footers of its files alone.

    Count, smallest and largest ``start`` of a partition are pushed into the scan, which reads no
    rows for them. The frame belongs to a session of its own with that switched on; store it to join
    it with others.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.schema(STORED_CANDLE).parquet(path)
    # only an aggregate per whole partition is pushed
    parts = table.groupBy(*PARTITION_COLUMNS).agg(F.count("*").alias("count"), F.min("start").alias("first"), F.max("start").alias("last"))
    return parts.groupBy("symbol").agg(F.sum("count").alias("count"), F.min("first").alias("first"), F.max("last").alias("last"))


def between(candles: DataFrame, from_ms: int, to_ms: int) -> DataFrame:
    """Candles starting in [from_ms, to_ms). The matching months are filtered too, so that the
    scan skips the other partitions."""
    low, high = (month_key(F.lit(ms).cast("long")) for ms in (from_ms, max(from_ms, to_ms - 1)))
    return candles.filter(
        F.col("month").between(low, high) & (F.col("start") >= from_ms) & (F.col("start") < to_ms)
    )


def write_summary_by_symbol(candles: DataFrame) -> DataFrame:
    """Count and time range per symbol. The end follows from ``start``: writers disagree on
    whether ``end`` is inclusive."""
    return _spans(candles).select(
        "symbol",
        "count",
        iso_utc(F.col("_first")).alias("start"),
        iso_utc(F.col("_last") + F.lit(WINDOW_MS)).alias("end"),
    )


def _spans(candles: DataFrame) -> DataFrame:
    return candles.groupBy("symbol").agg(
        F.count("*").alias("count"), F.min("start").alias("_first"), F.max("start").alias("_last")
    )


def write_summary(candles: DataFrame) -> DataFrame:
    """One row for a whole write: its symbols, count and time range.

    Rows shrink to one per symbol first, so only the list of symbols, which the row must show,
    meets in one place.
    """
    return _spans(candles).agg(
        F.array_join(F.array_sort(F.collect_list("symbol")), ",").alias("symbols"),
        F.sum("count").alias("count"),
        iso_utc(F.min("_first")).alias("start"),
        iso_utc(F.max("_last") + F.lit(WINDOW_MS)).alias("end"),
    )


def stream_to_table(
    candles: DataFrame,
    path: str,
    checkpoint: str,
    *,
    file_format: str = "parquet",
    trigger: dict | None = None,
    name: str = "candles",
    summaries: str | None = None,
    named: bool = False,
) -> StreamingQuery:
    """Append closed candles to the shared table, one commit per micro-batch.

    With ``summaries`` every commit adds a row to the table of write summaries there. With ``named``
    every micro-batch is an append named by stream and batch, which a repeated one replaces.

    At least once: a batch that failed between its append and its checkpoint is appended again.
    On Delta the transaction options below make the repeat a no-op; their id is the query's own,
    which Spark keeps in the checkpoint, so another stream or a fresh checkpoint is never skipped. On
    plain storage ``named`` appends are exactly once and share the table with other writers' named
    appends; ``stream_to_files`` is exactly once in a folder of its own.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        # Persisted for the emptiness test: without it the batch would be computed twice.
        batch = batch.persist()
        try:
            _append_batch(batch, batch_id, path, file_format, summaries, named)
        finally:
            batch.unpersist()

    writer = candles.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(append).trigger(**(trigger or {"processingTime": "1 second"})).start()


def _append_batch(batch: DataFrame, batch_id: int, path: str, file_format: str, summaries: str | None, named: bool) -> None:
    if batch.isEmpty():
        return
    spark = batch.sparkSession
    # the id of the stream, kept in its checkpoint: set by Spark on the batch's session
    app = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    options = {"txnAppId": app, "txnVersion": str(batch_id)} if file_format == "delta" else {}
    commit = f"{app}-{batch_id}" if named else None
    summary = append_candles(batch, path, file_format=file_format, options=options, commit=commit)
    if summaries:
        log_summary(spark, summary, summaries, batch_id)


def stream_to_tables(
    tagged: DataFrame,
    path: str,
    late_path: str,
    checkpoint: str,
    *,
    size_ms: int = WINDOW_MS,
    file_format: str = "parquet",
    trigger: dict | None = None,
    name: str = "candles",
    summaries: str | None = None,
) -> StreamingQuery:
    """``stream_to_table`` for ``stream_candles_and_late``: rejected ticks go to a table of their own.

    Both come from one computation of the micro-batch. Rejected ticks carry ``batch_id``, so that a
    repeated batch can be told from a repeated tick. Their table is there from the start, empty until
    a tick is rejected.
    """
    late_schema = T.StructType([*late_rows(tagged).schema.fields, T.StructField("batch_id", T.LongType())])
    tagged.sparkSession.createDataFrame([], late_schema).write.format(file_format).mode("ignore").save(late_path)

    def append(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            _append_batch(candle_rows(batch, size_ms), batch_id, path, file_format, summaries, False)
            late = late_rows(batch)
            if not late.isEmpty():
                late.withColumn("batch_id", F.lit(batch_id).cast("long")).write.format(file_format).mode("append").save(late_path)
        finally:
            batch.unpersist()

    writer = tagged.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(append).trigger(**(trigger or {"processingTime": "1 second"})).start()


def stream_to_files(
    candles: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None, name: str = "candles"
) -> StreamingQuery:
    """Closed candles as exactly-once Parquet files in the table's layout.

    The file sink keeps a log in ``path`` that readers follow, so no other writer may use the
    folder; read it together with the shared table by ``union_sources``.
    """
    return (
        to_stored(candles)
        .writeStream.queryName(name)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITION_COLUMNS)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def union_sources(**sources: DataFrame) -> DataFrame:
    """Candles of several writers, ``end`` as each writes it, tagged with ``source``."""
    tagged = [
        to_candle_schema(df).select(F.lit(name).alias("source"), *CANDLE_COLUMNS)
        for name, df in sources.items()
    ]
    union = tagged[0]
    for df in tagged[1:]:
        union = union.unionByName(df)
    return union
