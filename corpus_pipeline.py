"""The training-text pipeline: each stage's rows are written as Parquet and read as the next one's.

Rejected documents go, one document of each group of near copies stays (five-word shingles, a
similarity of 0.8), documents with benchmark windows go, secrets are replaced in place, and what
is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, jaccard, pieces, quality, secrets
from tickloom.llm.store import numbered, stored


def _packed(docs: DataFrame) -> DataFrame:
    """``id`` with all columns but the text, and ``text``: whole rows go through an operator."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("id"), "text")


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col("text") if c == "text" else F.col(f"id.`{c}`").alias(c) for c in docs.columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return _unpacked(quality.ledger(_packed(docs), "id").filter(quality.keeps("v2")), docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; of rows that share an id, one by text."""
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("row"), "text")
    repeated = rows.groupBy("row").count().filter("count > 1 or row is null").limit(1)
    if not repeated.isEmpty():
        order = rows.withColumn("h", F.xxhash64("text")).select("doc", "row", "h", "text")
        rows = stored(numbered(order, ["row", "h"]).drop("row").withColumnRenamed("row_number", "row"), "rows")
    found = jaccard.jaccard_components(rows.select("row", "text"), 5, (8, 10), "row", rounds=3)
    first = found.filter("component = key").select("key")
    return rows.join(first, F.col("row") == F.col("key"), "left_semi").select("doc.*")


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(_packed(docs), benchmark, id_col="id")
    return _unpacked(found.filter(F.size("spans") == 0), docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; ``n_chars``, where there is one, follows.

    Secrets depend on text and source alone, so rows that share both share their secrets: the join
    needs no id, and ids may repeat or be null. Other columns pass through whatever their names.
    Rows without a candidate hold no secret and go past the join, so their texts are not shuffled.
    """
    rows = _packed(docs).withColumnRenamed("id", "others").withColumn("before", F.col("text"))
    if "source" in docs.columns:
        rows = rows.withColumn("source", F.col("others.source"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "source") if c in rows.columns]
    rows = rows.withColumn("id", F.sha2(F.concat_ws("\x00", *parts), 256))
    some = F.coalesce(F.col("text").rlike(secrets.CANDIDATE), F.lit(False))
    suspects = rows.filter(some)
    clean = secrets.redact(suspects, secrets.scan(suspects, "id", "text"), "id").unionByName(rows.filter(~some))
    changed = ~F.col("text").eqNullSafe(F.col("before"))
    columns = []
    for c in docs.columns:
        held = F.col("text") if c == "text" else F.col(f"others.`{c}`")
        if c == "n_chars":
            held = F.when(changed, F.length("text")).otherwise(held).cast(docs.schema[c].dataType)
        columns.append(held.alias(c))
    return clean.select(*columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, starts, ends, decoded_sha256``: ids and the source bytes of each."""
    found = pieces.encode(docs, pieces.model_path())
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        "starts",
        "ends",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_stage),
    ("near copies", near_copies_stage),
    ("benchmark decontamination", benchmark_stage),
    ("secret scan", secrets_stage),
    ("encoding", encoding_stage),
]

#: Random forest and tokenizer stages have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
