"""Removal of repeated word windows, with a count-min sketch before the exact grouping.

Every window of words is counted under an anchor: the smallest hash among the short shingles in
it. Equal windows have equal anchors at equal places, so the number of places of an anchor is at
least the count of each of its windows. Sketches of those numbers are made per partition and
merged; a second pass groups exactly the windows that the merged sketch estimates to be repeated.
An estimate is never too low, so no repeated window is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.bits import bitmap, bits_for, holds
from tickloom.llm.store import keyed, stored
from tickloom.llm.words import GRAPHIC, Texts, Words, covered, mix, steps, strings

_U = np.uint64
#: Rows of the sketch; of their cells the executors see only whether they reach 2.
DEPTH = 2
#: Bytes of text for each anchor that cells are made for: about two anchors in prose.
_BYTES = 60
#: Windows and counts that a task gathers before it passes them on.
_GATHERED = 1_000_000


def _anchors(words: Words, window: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window: its first word, and the word where its anchor starts."""
    at = words.windows(window)
    if not len(at):
        return at, at
    n = len(words.start)
    codes = np.full(n, ~_U(0))
    inner = words.windows(shingle)
    codes[inner] = words.window_hashes(inner, shingle, 2)
    # minima over doubling spans; the place breaks ties, so the leftmost of equals is taken
    span, best, place = window - shingle + 1, codes, np.arange(n)
    have = 1
    while have < span:
        step = min(have, span - have)
        later, other = np.empty_like(best), np.empty_like(place)
        later[: n - step], later[n - step :] = best[step:], ~_U(0)
        other[: n - step], other[n - step :] = place[step:], n - 1
        less = later < best
        best, place = np.where(less, later, best), np.where(less, other, place)
        have += step
    return at, place[at]


def _cells(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [mix(codes + _U(row)) >> _U(64 - bits) for row in range(DEPTH)]


def _partition_sketch(window: int, shingle: int, bits: int):
    """(row, cell, n): how many places fall into each cell of the task's own sketch."""

    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        codes = np.concatenate(parts)
        for row, cells in enumerate(_cells(codes, bits)):
            cell, n = np.unique(cells, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(((row << bits) + cell.astype(np.int64))), pa.array(np.minimum(n, 2).astype(np.int32))], ["cell", "n"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, have = [], 0
        for batch in steps(batches):
            words = Words(Texts(batch["text"]), GRAPHIC)
            places = np.unique(_anchors(words, window, shingle)[1])
            parts.append(words.window_hashes(places, shingle, 2))
            have += len(places)
            if have > _GATHERED:
                yield from flush(parts)
                parts, have = [], 0
        if parts:
            yield from flush(parts)

    return run


def _repeated_windows(window: int, shingle: int, bits: int, sketch):
    """Rows (h, g, key, pos, run) of windows that may be repeated.

    A task passes on the first place it sees of each window, by key and position, with ``run`` 0.
    The others follow that place whatever the rest holds, so they are passed on as removed: ``run``
    windows from ``pos`` on, under a hash of their own.
    """
    rows = sketch.value

    def flush(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, g, key, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((pos, key, g, h))
        h, g, key, pos = h[order], g[order], key[order], pos[order]
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
        # rows equal in key and place are one document given twice: both stay as they are
        twice = np.zeros(len(h), bool)
        twice[1:] = same[1:] & (key[1:] == key[:-1]) & (pos[1:] == pos[:-1])
        first = ~same
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[first].view(np.int64)), pa.array(g[first].view(np.int32)), pa.array(key[first]), pa.array(pos[first].astype(np.int32)), pa.array(np.zeros(first.sum(), np.int32))],
            ["h", "g", "key", "pos", "run"],
        )
        later = np.flatnonzero(same & ~twice)
        key, pos = key[later], pos[later]
        order = np.lexsort((pos, key))
        key, pos = key[order], pos[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (pos[1:] > pos[:-1] + 1)
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(key)) - 1 if len(begin) else begin
        run = (pos[end] - pos[begin] + 1).astype(np.int32)
        key, pos = key[begin], pos[begin]
        own = mix(key.view(_U) * _U(0x9E3779B97F4A7C15) ^ pos.astype(_U))
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.view(np.int64)), pa.array(np.full(len(key), -1, np.int32)), pa.array(key), pa.array(pos.astype(np.int32)), pa.array(run)],
            ["h", "g", "key", "pos", "run"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, have = [], 0
        for batch in steps(batches):
            words = Words(Texts(batch["text"]), GRAPHIC)
            at, place = _anchors(words, window, shingle)
            places, of = np.unique(place, return_inverse=True)
            likely = np.ones(len(places), bool)
            for row, cells in zip(rows, _cells(words.window_hashes(places, shingle, 2), bits), strict=True):
                likely &= holds(row, cells)
            at = at[likely[of]]
            owner = words.owner()[at]
            keys = batch["key"].to_numpy()
            second = (words.window_hashes(at, window, 2) >> _U(32)).astype(np.uint32)
            parts.append((words.window_hashes(at, window, 1), second, keys[owner], at - words.first[owner]))
            have += len(at)
            if have > _GATHERED:
                yield from flush(parts)
                parts, have = [], 0
        if parts:
            yield from flush(parts)

    return run


def _without(window: int):
    """Texts without the words that the removed windows cover; marks are pos * 2**32 + run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            words = Words(Texts(batch["text"]), GRAPHIC)
            marks = batch["marks"]
            flat = marks.flatten().to_numpy()
            sizes = marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            start = words.first[doc] + (flat >> 32)
            gone = covered(len(words.start), start, start + (flat & 0xFFFFFFFF) - 1 + window)
            kept = np.flatnonzero(~gone)
            owner = words.owner()
            data = np.append(words.data, np.uint8(0))
            change = np.zeros(len(data) + 1, np.int8)
            change[words.start[kept]] += 1
            np.subtract.at(change, words.end[kept], 1)
            inside = np.cumsum(change[:-1], dtype=np.int8) > 0
            if len(kept):
                last = np.append(owner[kept][1:] != owner[kept][:-1], True)
                blank = words.end[kept[~last]]
                data = data.copy()
                data[blank] = 0x20
                inside[blank] = True
            ends = np.concatenate([[0], np.cumsum(inside)])[words.texts.offsets[1:]]
            removed = np.bincount(owner[gone], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    batch["id"],
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(removed.astype(np.int64)),
                    strings(data[inside], ends),
                ],
                ["key", "id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame,
    window: int = 20,
    shingle: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int | None = None,
) -> DataFrame:
    """One row per document: ``key, id, n_words, n_removed, kept``.

    A window is ``window`` consecutive words (runs without white space) of one document. Words
    covered by a window whose words also start earlier, in a smaller id or earlier in the same
    document, are removed; ``kept`` joins the others by one space. Windows are judged on the
    input. Null and empty texts have no words. Where ids repeat or are null, rows are told apart
    by id, nulls first, and text (see ``keyed``); rows equal in both are one document.

    An empty table gives no rows; other columns are not read, whatever their names.

    The merged sketch is a bitmap of ``DEPTH * 2**bits`` bits. Unless given, ``bits`` follows from
    the bytes of all texts, so that a cell has an eighth to a quarter of an anchor at any size up to
    8 GB, where the bitmap has its largest size, 256 MB. Beyond that it lets more windows through to
    the exact grouping, all of them from some 100 GB on; the rows stay the same.
    """
    spark = docs.sparkSession
    base = keyed(docs, id_col, text_col)
    texts = base.select("key", "text")
    if bits is None:
        bits = bits_for((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // _BYTES)
    counted = texts.select("text").mapInArrow(_partition_sketch(window, shingle, bits), "cell long, n int")
    # stored, like the marks below, so that the shuffle files of the counts go before the next ones come
    reached = stored(counted.groupBy("cell").agg(F.sum("n").alias("n")).filter("n > 1").select("cell"), "reached")
    merged = bitmap(reached, bits + DEPTH.bit_length() - 1).reshape(DEPTH, -1)
    sketch = spark.sparkContext.broadcast(merged)
    windows = texts.mapInArrow(
        _repeated_windows(window, shingle, bits, sketch), "h long, g int, key long, pos int, run int"
    )
    # tasks have sent each window once, so a window has as many rows here as there are tasks at most
    later = windows.withColumn("first", F.expr("min(struct(key, pos)) over (partition by h, g)")).filter(
        "run > 0 or struct(key, pos) > first"
    )
    marks = later.groupBy("key").agg(
        F.collect_list(F.shiftleft(F.col("pos").cast("long"), 32) + F.greatest(F.col("run"), F.lit(1))).alias("marks")
    )
    marks = stored(marks, "marks")
    return base.join(marks, "key", "left").select("key", "id", "text", "marks").mapInArrow(
        _without(window), "key long, id long, n_words long, n_removed long, kept string"
    )


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
with w as materialized (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
p as materialized (select doc_id, k, array_to_string(ws[k:k + 19], ' ') as seq from w, unnest(range(1, len(ws) - 18)) as u(k) where len(ws) >= 20),
later as materialized (select doc_id, k from (select doc_id, k, row_number() over (partition by seq order by doc_id, k) as r from p) where r > 1),
gone as materialized (select distinct doc_id, j from later, unnest(range(k, k + 20)) as u(j)),
words as (select doc_id, j, ws[j] as word from w, unnest(range(1, len(ws) + 1)) as u(j)),
kept as (select doc_id, string_agg(word, ' ' order by j) as text from words anti join gone using (doc_id, j) group by doc_id),
counts as (select doc_id, count(*) as n from gone group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256
from w left join kept using (doc_id) left join counts using (doc_id)
"""
