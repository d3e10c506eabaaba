"""Which archive files a backfill needs, and what became of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.timing import utc_date


def archive_path(base: str, interval: Column, symbol: Column, date: Column) -> Column:
    """``{base}/{monthly|daily}/klines/{symbol}/1m/{symbol}-1m-{date}.zip``."""
    return F.format_string(
        base.rstrip("/").replace("%", "%%") + "/%s/klines/%s/1m/%s-1m-%s.zip", interval, symbol, symbol, date
    )


def download_plan(ranges: DataFrame, base: str) -> DataFrame:
    """Files that cover [start_date, end_date) per symbol.

    A calendar month that lies wholly inside is one monthly file, every other day a daily one.
    Each month decides that for itself, so the plan is a pure row expansion without a shuffle.
    """
    start, last = F.col("start_date"), F.date_sub("end_date", 1)
    # Midnight timestamps would step with the session zone; dates do not.
    months = ranges.filter(F.col("start_date") < F.col("end_date")).withColumn(
        "_month",
        F.explode(
            F.expr("sequence(trunc(start_date, 'MM'), date_sub(end_date, 1), interval 1 month)")
        ),
    )
    whole = (F.col("_month") >= start) & (F.last_day("_month") <= last)
    first_day = F.greatest(F.col("_month"), start)
    final_day = F.least(F.last_day("_month"), last)
    days = F.sequence(first_day, F.when(whole, first_day).otherwise(final_day), F.expr("interval 1 day"))
    files = months.select(
        "symbol",
        F.when(whole, F.lit("monthly")).otherwise(F.lit("daily")).alias("interval"),
        F.explode(days).alias("_day"),
    )
    day = F.col("_day").cast("string")
    date = F.when(F.col("interval") == "monthly", F.substring(day, 1, 7)).otherwise(day)
    return files.select("symbol", "interval", date.alias("date")).withColumn(
        "path", archive_path(base, F.col("interval"), F.col("symbol"), F.col("date"))
    )


def backfill_file_report(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Rows and status per planned file; a missing or failed file counts as zero rows.

    ``outcomes`` holds (path, rows, error) per file that was found, see ``archive_outcomes``.
    """
    found = outcomes.select("path", "rows", "error", F.lit(True).alias("_found"))
    status = (
        F.when(F.col("_found").isNull(), F.lit("missing"))
        .when(F.col("error").isNotNull(), F.lit("failed"))
        .otherwise(F.lit("ok"))
    )
    rows = F.when(status == "ok", F.col("rows")).otherwise(F.lit(0).cast("long"))
    return plan.join(found, "path", "left").select(
        "symbol", "interval", "date", "path", status.alias("status"), rows.alias("rows")
    )


def backfill_totals(report: DataFrame) -> DataFrame:
    """Files by status and candles per symbol."""
    return report.groupBy("symbol").agg(
        F.sum("rows").alias("candles"),
        F.count_if(F.col("interval") == "monthly").alias("monthly_files"),
        F.count_if(F.col("interval") == "daily").alias("daily_files"),
        F.count_if(F.col("status") == "missing").alias("missing_files"),
        F.count_if(F.col("status") == "failed").alias("failed_files"),
    )


def onboarding_ranges(symbols: DataFrame, klines: DataFrame, end_date: Column) -> DataFrame:
    """Backfill range per symbol: the UTC date of its first kline up to ``end_date``, exclusive.

    A symbol without klines fails the query.
    """
    first = klines.groupBy("symbol").agg(F.min("start").alias("_first"))
    start = F.when(
        F.col("_first").isNull(),
        F.raise_error(F.concat(F.lit("no data found for "), F.col("symbol"))).cast("date"),
    ).otherwise(utc_date(F.col("_first")))
    return (
        symbols.select("symbol")
        .distinct()
        .join(first, "symbol", "left")
        .select("symbol", start.alias("start_date"), end_date.alias("end_date"))
    )
