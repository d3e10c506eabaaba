"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered from 0 in order of their ids. A keyed permutation of the numbers 0..n-1 then
gives each row a place in the shuffled data, and shard and slot are computed from the place alone:
no sort by a random key, and any row's shard can be found again from its number, n and the seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import numbered
from tickloom.llm.words import mix

_U = np.uint64
ROUNDS = 6


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A permutation of 0..n-1, fixed by ``seed``.

    A Feistel network permutes the smallest domain of two halves of bits that holds n. A result
    outside 0..n-1 is permuted again until it is inside, which keeps the map one to one; the domain
    is less than four times n.
    """
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = _U((1 << half) - 1)
    keys = mix(np.arange(ROUNDS, dtype=_U) + _U(seed * 0x9E3779B97F4A7C15 % (1 << 64)))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> _U(half), x & mask
        for key in keys:
            left, right = right, left ^ (mix(right ^ key) & mask)
        return (left << _U(half)) | right

    out = once(numbers.astype(_U))
    while len(outside := np.flatnonzero(out >= _U(n))):
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def shard_rows(docs: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, size, text_crc32, place, shard, slot``.

    ``place`` is the row's number after the shuffle, ``shard = place % shards`` and ``slot =
    place // shards``: shards differ by one row at most and slots have no gaps. ``size`` is the
    text's UTF-8 bytes (null: none) plus 16; the checksum of a null text is that of an empty one.
    Rows are numbered in order of (id, nulls first, checksum, size), so rows equal in all of these
    may swap numbers, which leaves the same set of results. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # the last key tells apart the parts of a hot group of equal rows, so that ranges can cut it
    rows = rows.withColumn("_part", F.monotonically_increasing_id())
    placed = numbered(rows, ["id", "text_crc32", "size", "_part"]).drop("_part")
    n = docs.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = permute(batch["row_number"].to_numpy(), n, seed)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("id", "size", "text_crc32")), pa.array(place), pa.array((place % shards).astype(np.int32)), pa.array(place // shards)],
                ["id", "size", "text_crc32", "place", "shard", "slot"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return placed.mapInArrow(run, f"id {kind}, size long, text_crc32 long, place long, shard int, slot long")


def op3_feistel_shards(spark, sf_dir: str) -> DataFrame:
    found = shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), 40, seed=42)
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
