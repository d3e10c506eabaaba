"""Candles of the current day up to a moment, as the exchange hands them out in pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.timing import bucket_start
from tickloom.schema import CANDLE_COLUMNS, DAY_MS, PAGE_ROWS


def _paged(klines: DataFrame, requests: DataFrame, page_rows: int, inclusive: bool) -> DataFrame:
    """Klines per request with their page and the start time that page was asked for."""
    asked = (
        requests.select("symbol", "until")
        .distinct()
        .withColumn("_day", bucket_start(F.col("until"), DAY_MS))
        .filter(F.col("_day") < F.col("until"))
    )
    days = klines.withColumn("_day", bucket_start(F.col("start"), DAY_MS))
    upto = F.col("start") <= F.col("until") if inclusive else F.col("start") < F.col("until")
    # A request covers one symbol and day, so the window below is bounded by the day.
    request = Window.partitionBy("symbol", "_day", "until").orderBy("start")
    ranked = (
        days.join(asked, ["symbol", "_day"])
        .filter(upto)
        .withColumn("_row", F.row_number().over(request) - 1)
        .withColumn("_resume", F.lag("end").over(request) + 1)
    )
    opens_page = F.col("_row") % page_rows == 0
    # A page is asked for only while its start time lies before ``until``.
    never_asked = opens_page & (F.col("_row") > 0) & (F.col("_resume") >= F.col("until"))
    return (
        ranked.filter(~never_asked)
        .withColumn("page", F.floor(F.col("_row") / page_rows) + 1)
        .withColumn("_asked", F.when(opens_page, F.coalesce("_resume", "_day")))
    )


def same_day_candles(
    klines: DataFrame, requests: DataFrame, *, page_rows: int = PAGE_ROWS, inclusive: bool = True
) -> DataFrame:
    """Candles from UTC midnight of ``until`` up to it, per request (symbol, until).

    The exchange's bound is inclusive, so the minute still open at ``until`` comes along as it
    stands, unless a page ended right before it. ``inclusive=False`` leaves it out.
    """
    return _paged(klines, requests, page_rows, inclusive).select("until", *CANDLE_COLUMNS)


def same_day_pages(
    klines: DataFrame, requests: DataFrame, *, page_rows: int = PAGE_ROWS, inclusive: bool = True
) -> DataFrame:
    """The pages those candles arrive in."""
    return (
        _paged(klines, requests, page_rows, inclusive)
        .groupBy("symbol", "until", "page")
        .agg(
            F.min("_asked").alias("requested_from"),
            F.count("*").alias("rows"),
            F.min("start").alias("first_start"),
            F.max("end").alias("last_end"),
        )
    )
