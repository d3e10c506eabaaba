"""Runs queries next to their SQL on DuckDB. ``python tests/compare.py SF_DIR [name ...]``"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from __spark_entry__ import oracle_sql, queries  # noqa: E402


def duck(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(r[i]) for i in order) for r in rows)


def differences(spark, sf_dir, name, con):
    """None when both sides agree, else a short account."""
    frame = queries()[name](spark, sf_dir)
    got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.sql(oracle_sql()[name])
    want = normal(result.columns, result.fetchall())
    if got == want:
        return None, len(got[1])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1])
    a, b = set(got[1]), set(want[1])
    return (
        f"{len(got[1])} rows != {len(want[1])}; extra {sorted(a - b)[:2]}; missing {sorted(b - a)[:2]}",
        len(got[1]),
    )


def main(sf_dir, names):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names or list(queries()):
        began = time.time()
        try:
            problem, rows = differences(spark, sf_dir, name, con)
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += problem is not None
        print(f"{name:34} {'ok' if problem is None else 'FAIL'} {rows:8} {time.time() - began:6.1f}s {problem or ''}", flush=True)
    print("failed:", failed, "without SQL:", sorted(set(queries()) - set(oracle_sql())))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
