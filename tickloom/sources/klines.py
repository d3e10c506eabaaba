"""Klines: REST payloads, archive CSV files and zipped archives, all to the candle schema."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.decimals import exact_decimal, required, try_exact_decimal, whole_number
from tickloom.schema import ARCHIVE_COLUMNS, CANDLE, CANDLE_COLUMNS, KLINE_POSITIONS, PRICE

# The folder below ``klines`` names the symbol.
SYMBOL_IN_PATH = r"/klines/([^/]+)/"

#: Bytes of a chunk of lines of an archive.
_CHUNK_BYTES = 1 << 20
_VALUES = [f for f in CANDLE.fields if f.name != "symbol"]


def _typed(text: Column, data_type) -> Column:
    return exact_decimal(text) if data_type == PRICE else whole_number(text)


def _needed(text: Column, field) -> Column:
    """A value that every kline has: a missing or inexact one raises."""
    return required(_typed(text, field.dataType), field.name, field.dataType).alias(field.name)


def _cells(line: Column) -> Column:
    """The cells of a line of numbers or column names, which hold no commas of their own."""
    return F.transform(F.split(F.rtrim(line, F.lit("\r")), ","), lambda c: F.trim(c, F.lit('" ')))


def _places(header: Column) -> Column:
    """Where each candle column stands among the cells of a header, from 1; 0 where it lacks."""
    return F.struct(*[F.array_position(header, ARCHIVE_COLUMNS[f.name]).cast("int").alias(f.name) for f in _VALUES])


def _cell(name: str) -> Column:
    """The text of a candle column in a row with ``at`` (see ``_places``) and ``cells``, empty as NULL."""
    return F.nullif(F.get("cells", F.col(f"at.{name}") - 1), F.lit(""))


def klines_json(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Positional kline lists in JSON text to candles; ``pages`` also has ``symbol``.

    An empty list gives no rows. Elements may be numbers or strings; other positions are unread.
    """
    klines = pages.select(
        "symbol",
        F.explode(F.from_json(payload, "array<array<string>>", {"mode": "FAILFAST"})).alias("k"),
    )
    values = [_needed(F.get("k", F.lit(KLINE_POSITIONS[f.name])), f) for f in _VALUES]
    return klines.select("symbol", *values)


def klines_csv(spark: SparkSession, path: str, *, symbol_pattern: str = SYMBOL_IN_PATH) -> DataFrame:
    """Archive CSV files to candles. Each file's columns are found by its own header line, in any
    order; others are not parsed. A file without the header of a kline archive raises, one without
    any line gives no rows.

    A file holds a symbol's month at most, so it is read whole: its header meets its lines in one
    row, and nothing is joined or shuffled.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.split("value", "\n").alias("lines"))
    files = files.withColumn("lines", F.filter("lines", lambda x: F.length(F.trim(F.rtrim(x, F.lit("\r")))) > 0))
    files = files.filter(F.size("lines") > 0).withColumn("at", _places(_cells(F.get("lines", F.lit(0)))))
    lacking = F.raise_error(F.concat(F.lit("no kline header in "), F.col("path"))).cast("array<string>")
    whole = F.least(*[F.col(f"at.{f.name}") for f in _VALUES]) > 0
    lines = F.when(whole, F.slice("lines", F.lit(2), F.size("lines"))).otherwise(lacking)
    rows = files.select("path", "at", F.explode(lines).alias("line")).withColumn("cells", _cells(F.col("line")))
    symbol = F.regexp_extract("path", symbol_pattern, 1)
    return rows.select(symbol.alias("symbol"), *[_needed(_cell(f.name), f) for f in _VALUES])


_CHUNKS = "path string, number long, header string, lines string, error string"


def _inflated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first entry of each archive in chunks of whole lines; nothing is split or parsed here.

    ``number`` is that of the first line of a chunk, or of the line after the last one read where an
    archive fails. A row numbered 0 without lines stands for an archive that could be opened.
    """
    schema = pa.schema([(n, pa.int64() if n == "number" else pa.string()) for n in ("path", "number", "header", "lines", "error")])
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            number, header = 0, None

            def row(lines=None, error=None):
                return pa.RecordBatch.from_pylist([dict(zip(schema.names, (path, number, header, lines, error), strict=True))], schema)  # noqa: B023

            try:
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive, archive.open(archive.namelist()[0]) as entry:
                    header = entry.readline().decode().rstrip("\r\n")
                    yield row()
                    number = 1
                    while block := entry.read(_CHUNK_BYTES):
                        block += entry.readline()  # to the end of a line
                        yield row(lines=block.decode().removesuffix("\n"))
                        number += block.count(b"\n")
            except Exception as failure:  # one bad archive must not stop the others
                yield row(error=f"{type(failure).__name__}: {failure}")


def archive_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Zipped archives as (path, content); Spark reads no content where only paths are selected."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "content")
    )


def read_archives(files: DataFrame) -> DataFrame:
    """Rows of each archive: ``path, kind, error`` and the candle columns but the symbol.

    ``kind`` is ``file`` once per archive that could be opened, ``row`` per kline, and ``failed``
    where the archive cannot be read or a row lacks a value or has one that does not fit; ``error``
    then says which. Tasks only inflate archives, in chunks of lines; Spark parses them.
    """
    chunks = files.select("path", "content").mapInArrow(_inflated, _CHUNKS)
    chunks = chunks.withColumn("at", _places(_cells(F.col("header"))))
    # a row without lines, that is the start or the failure of an archive, stays one row
    lines = chunks.select("path", "number", "at", "error", F.posexplode_outer(F.split("lines", "\n")).alias("place", "line"))
    lines = lines.withColumn("number", F.col("number") + F.coalesce("place", F.lit(0)))
    lines = lines.filter("line is null or length(trim(line)) > 0").withColumn("cells", _cells(F.col("line")))
    for f in _VALUES:
        text = _cell(f.name)
        lines = lines.withColumn(f.name, try_exact_decimal(text) if f.dataType == PRICE else text.try_cast(f.dataType))
    bad = F.when(
        F.col("line").isNotNull() & (F.greatest(*[F.col(f.name).isNull().cast("int") for f in _VALUES]) == 1),
        F.concat(F.lit("unusable row "), F.col("number").cast("string")),
    )
    error = F.coalesce("error", bad)
    kind = F.when(error.isNotNull(), "failed").when(F.col("number") == 0, "file").otherwise("row")
    return lines.select("path", kind.alias("kind"), error.alias("error"), *[f.name for f in _VALUES])


def archive_candles(scanned: DataFrame, *, symbol_pattern: str = SYMBOL_IN_PATH) -> DataFrame:
    """The candles of the archives without a failure among the rows of ``read_archives``.

    An archive holds a symbol's month at most, so its rows can meet.
    """
    failed = F.max("error").over(Window.partitionBy("path"))
    rows = scanned.withColumn("_failed", failed).filter("_failed is null and kind = 'row'")
    return rows.withColumn("symbol", F.regexp_extract("path", symbol_pattern, 1)).select(*CANDLE_COLUMNS)


def archive_outcomes(scanned: DataFrame) -> DataFrame:
    """Rows and error per archive; a failed one counts as no rows."""
    found = scanned.groupBy("path").agg(F.count_if(F.col("kind") == "row").alias("rows"), F.min("error").alias("error"))
    return found.withColumn("rows", F.when(F.col("error").isNull(), F.col("rows")).otherwise(F.lit(0).cast("long")))


def klines_zip(files: DataFrame, *, symbol_pattern: str = SYMBOL_IN_PATH) -> DataFrame:
    """Zipped archives to candles; a failed archive gives no rows."""
    return archive_candles(read_archives(files), symbol_pattern=symbol_pattern)
