"""Landed archives of a date range into the candle table.

``spark-submit -m tickloom.jobs.backfill --symbol BTCUSDT --start-date 2024-01-15
--end-date 2024-04-03 --archives DIR --table DIR`` prints one line per symbol and exits 0 even
where files were missing or broken; those count as zero candles.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.plans.backfill import backfill_file_report, backfill_totals, download_plan
from tickloom.session import build_session, work_dir
from tickloom.sinks.candle_table import append_candles
from tickloom.sources.klines import archive_candles, archive_files, archive_outcomes, read_archives

_BELOW_BASE = r"((?:monthly|daily)/klines/[^/]+/1m/[^/]+)$"


def run_backfill(
    spark: SparkSession, ranges: DataFrame, archives: str, table: str, *, file_format: str = "parquet"
) -> DataFrame:
    """Append the candles of all planned archives and return the report per file.

    ``ranges`` holds (symbol, start_date, end_date). Only archives that the plan names are opened.
    They are parsed once, into a staging folder, from which both the table and the report are fed.
    """
    plan = download_plan(ranges, archives).withColumn("_file", F.regexp_extract("path", _BELOW_BASE, 1))
    landed = archive_files(spark, archives).select("path").withColumn("_file", F.regexp_extract("path", _BELOW_BASE, 1))
    # names only, as the reader takes them: one per file of the plan that is there
    wanted = [r["path"] for r in landed.join(plan.select("_file"), "_file", "left_semi").select("path").collect()]
    files = archive_files(spark, wanted) if wanted else landed.select("path", F.lit(None).cast("binary").alias("content")).limit(0)
    staging = work_dir(spark, "backfill")
    read_archives(files).write.parquet(staging)

    staged = spark.read.parquet(staging)
    written = append_candles(archive_candles(staged), table, file_format=file_format)
    if written:
        print("wrote candles:", written)
    outcomes = archive_outcomes(staged).withColumn("path", F.regexp_extract("path", _BELOW_BASE, 1))
    by_file = plan.select("symbol", "interval", "date", F.col("_file").alias("path"))
    return backfill_file_report(by_file, outcomes)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load landed kline archives of a date range into the candle table")
    parser.add_argument("--symbol", required=True, nargs="+", help="one or more symbols")
    parser.add_argument("--start-date", required=True, help="first UTC day to load")
    parser.add_argument("--end-date", required=True, help="UTC day at which to stop; not loaded itself")
    parser.add_argument("--archives", required=True, help="folder the archives were landed in")
    parser.add_argument("--table", required=True, help="folder of the candle table")
    parser.add_argument("--format", default="parquet")
    args = parser.parse_args(argv)

    spark = build_session("backfill")
    symbols = spark.createDataFrame([(s,) for s in args.symbol], "symbol string")
    ranges = symbols.select(
        "symbol",
        F.to_date(F.lit(args.start_date)).alias("start_date"),
        F.to_date(F.lit(args.end_date)).alias("end_date"),
    )
    report = run_backfill(spark, ranges, args.archives, args.table, file_format=args.format)
    for row in backfill_totals(report).toLocalIterator():
        print("backfill:", row.asDict())


if __name__ == "__main__":
    main()
