"""Shared storage for intermediate tables, and keys for documents whose ids repeat."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Whether Spark removes the shuffle files of a finished job at once.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a folder of its own on a local master without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there.

    Nothing reads the shuffles of that job again, so their files go as soon as it has ended.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, text) with a long key per row that orders rows as their ids do.

    Where ids are unique and never null the key is the id. Otherwise, rows take a dense number in
    order of (id, nulls first, hash of the text); rows equal in both share it and are one document.
    The check reads the id column alone.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    again = base.groupBy("id").count().filter("count > 1 or id is null").limit(1)
    if again.isEmpty():
        return base.select(F.col("id").alias("key"), "id", "text")
    hashed = base.withColumn("h", F.xxhash64("text"))
    numbers = stored(numbered(hashed.select("id", "h").distinct(), ["id", "h"]), "keys")
    joined = hashed.alias("a").join(
        numbers.alias("b"), F.expr("a.id <=> b.id and a.h = b.h")
    )
    return joined.select(F.col("b.row_number").alias("key"), F.col("a.id").alias("id"), "text")


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``row_number``, dense from 0 in the given order, nulls first; no task sees all rows.

    Rows are cut into ranges of the order, counted per range, and numbered by range start plus
    place in the range. The counts are one row per partition. The ranges are stored in between,
    so that a lost executor cannot cut them differently.
    """
    cut = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(
        *[F.col(c).asc_nulls_first() for c in order]
    )
    placed = stored(
        cut.withColumn("_m", F.monotonically_increasing_id()).select(
            *df.columns,
            F.shiftright("_m", 33).alias("_range"),
            F.col("_m").bitwiseAND((1 << 33) - 1).alias("_place"),
        ),
        "ranges",
    )
    sizes = placed.groupBy("_range").count()
    starts = sizes.select(
        F.col("_range").alias("_of"),
        F.expr("sum(count) over (order by _range) - count").alias("_start"),
    )
    return placed.join(starts, F.col("_range") == F.col("_of")).select(
        *df.columns, (F.col("_start") + F.col("_place")).alias("row_number")
    )
