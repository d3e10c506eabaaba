"""Benchmark decontamination as a prefix-filtered set join.

Benchmark items are cut into item-sized windows. A document contains a window only if it contains
every shingle of it, so the rarest shingle of each window, by its count over all documents, is the
one prefix token that needs a lookup. Each hit fixes where the window would start; length and
position bounds cut impossible starts, and the words are then compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import stored
from tickloom.llm.words import ALNUM, Texts, Words, steps

#: Windows of one broadcast index: about 100 MB on an executor. More windows make more passes.
BLOCK_WINDOWS = 500_000


def item_windows(benchmark: DataFrame, window: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(codes, items): each distinct window as word hashes, with the ids of the items that have it.

    An item with fewer words than ``window`` is one window; without words it has none. Items
    without an id still make windows, with no name.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            words = Words(Texts(batch["text"]), ALNUM, lower=True)
            names, codes = [], []
            for i, name in enumerate(batch["id"].to_pylist()):
                own = words.hash[words.first[i] : words.first[i + 1]].view(np.int64)
                seen = {own[k : k + window].tobytes() for k in range(max(1, len(own) - window + 1))} if len(own) else ()
                names += [name] * len(seen)
                codes += seen
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(codes, pa.binary())], ["id", "codes"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return (
        rows.mapInArrow(cut, "id string, codes binary")
        .groupBy("codes")
        .agg(F.sort_array(F.collect_set("id")).alias("items"))
    )


class _Tokens:
    """Sorted shingle hashes of one size and a bit filter before them."""

    def __init__(self, size: int, hashes: np.ndarray):
        self.size = size
        self.hashes = np.unique(hashes)
        self.shift = np.uint64(64 - min(24, max(12, int(np.ceil(np.log2(16 * len(self.hashes) + 1))))))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[self.hashes >> self.shift] = True

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Words at which a known shingle starts, and its number."""
        at = words.windows(self.size)
        found = words.window_hashes(at, self.size)
        near = np.flatnonzero(self.bits[found >> self.shift])
        at, found = at[near], found[near]
        number = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        same = self.hashes[number] == found
        return at[same], number[same]


class _Index:
    """Windows grouped by length, and the shingles of each."""

    def __init__(self, windows: list[np.ndarray], shingle: int):
        self.windows = windows
        self.groups = []  # (length, numbers of the windows, their codes, tokens, token numbers)
        for length in sorted({len(w) for w in windows}):
            ids = np.array([i for i, w in enumerate(windows) if len(w) == length])
            codes = np.stack([windows[i] for i in ids])
            size = min(shingle, length)
            flat = Words.__new__(Words)
            flat._hash = codes.reshape(-1)
            at = (np.arange(len(ids))[:, None] * length + np.arange(length - size + 1)).reshape(-1)
            hashes = flat.window_hashes(at, size)
            tokens = _Tokens(size, hashes)
            numbers = np.searchsorted(tokens.hashes, hashes).reshape(len(ids), -1)
            self.groups.append((length, ids, codes, tokens, numbers))

    def choose(self, counts: dict[tuple[int, int], int]) -> None:
        """Keeps the rarest shingle of each window, the first of equals, as its prefix token."""
        chosen = []
        for length, ids, codes, tokens, numbers in self.groups:
            rarity = np.array([counts.get((tokens.size, int(h)), 0) for h in tokens.hashes.view(np.int64)])
            place = rarity[numbers].argmin(axis=1)
            token = numbers[np.arange(len(ids)), place]
            order = np.argsort(token, kind="stable")
            prefix = _Tokens(tokens.size, tokens.hashes[token])
            of = np.searchsorted(prefix.hashes, tokens.hashes[token[order]])
            bounds = np.searchsorted(of, np.arange(len(prefix.hashes) + 1))
            chosen.append((length, ids[order], codes[order], prefix, place[order], bounds))
        self.groups = chosen

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, first word, end) of every place where a window occurs."""
        found = []
        last = np.repeat(words.first[1:], words.counts)
        begin = np.repeat(words.first[:-1], words.counts)
        for length, ids, codes, prefix, place, bounds in self.groups:
            at, token = prefix.find(words)
            many = bounds[token + 1] - bounds[token]
            hit = np.repeat(np.arange(len(at)), many)
            entry = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + bounds[token][hit]
            start = at[hit] - place[entry]
            fits = (start >= begin[at[hit]]) & (start + length <= last[at[hit]])
            start, entry = start[fits], entry[fits]
            for k in range(length):
                same = words.hash[start + k] == codes[entry, k]
                start, entry = start[same], entry[same]
            found.append((ids[entry], start, start + length))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _shingle_counts(docs: DataFrame, shared) -> dict[tuple[int, int], int]:
    """How often each shingle of the index occurs in all documents; one row per shingle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = [g[3] for g in shared.value.groups]
        totals = [np.zeros(len(t.hashes), np.int64) for t in tokens]
        for batch in steps(batches):
            words = Words(Texts(batch["text"]), ALNUM, lower=True)
            for t, total in zip(tokens, totals, strict=True):
                total += np.bincount(t.find(words)[1], minlength=len(total))
        for t, total in zip(tokens, totals, strict=True):
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), t.size)), pa.array(t.hashes[seen].view(np.int64)), pa.array(total[seen])],
                ["size", "hash", "n"],
            )

    # groups of one shingle size may share a shingle: each counted it in full, so the largest holds
    per_task = docs.select("text").mapInArrow(count, "size long, hash long, n long").withColumn("task", F.spark_partition_id())
    rows = per_task.groupBy("task", "size", "hash").agg(F.max("n").alias("n")).groupBy("size", "hash").agg(F.sum("n").alias("n"))
    return {(r["size"], r["hash"]): r["n"] for r in rows.collect()}


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    shingle: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per document: ``id, text, n_words, spans, items``.

    ``spans`` are the maximal runs (first word, end) of words inside an occurrence of a benchmark
    window, ``items`` the ids whose windows occur, sorted as strings. Words are runs of digits,
    letters a-z after lower-casing A-Z, and non-ASCII characters. Null and empty texts have no
    words; repeated rows each get their own equal row; an empty benchmark hits nothing. Windows
    are broadcast in blocks of ``block_windows``; further blocks are further passes over the
    documents, cut by a stored table.
    """
    spark = docs.sparkSession
    out = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.lit(None).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<first:long, end:long>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    windows = stored(item_windows(benchmark, window), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    for block in range(blocks):
        part = windows.filter(F.pmod(F.xxhash64("codes"), F.lit(blocks)) == block).orderBy("codes").collect()
        index = _Index([np.frombuffer(r["codes"], np.uint64) for r in part], shingle)
        names = [r["items"] for r in part]
        index.choose(_shingle_counts(out, spark.sparkContext.broadcast(index)) if part else {})
        shared = spark.sparkContext.broadcast((index, names))
        out = out.mapInArrow(_marker(shared), out.schema)
        if block + 1 < blocks:
            out = stored(out, "marked")
    return out


def _marker(shared):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, names = shared.value
        for batch in steps(batches):
            words = Words(Texts(batch["text"]), ALNUM, lower=True)
            found = index.occurrences(words) if index.groups else (np.zeros(0, int),) * 3
            inside = np.zeros(len(words.start) + 1, np.int32)
            np.add.at(inside, found[1], 1)
            np.subtract.at(inside, found[2], 1)
            owner = words.owner()
            doc = owner[found[1]] if len(found[1]) else found[1]
            items = [set(x) for x in batch["items"].to_pylist()]
            for d, w in {*zip(doc.tolist(), found[0].tolist(), strict=True)}:
                items[d].update(names[w])
            hit = np.cumsum(inside[:-1]) > 0
            for i, spans in enumerate(batch["spans"].to_pylist()):
                for s in spans:  # of earlier blocks
                    hit[words.first[i] + s["first"] : words.first[i] + s["end"]] = True
            own = np.flatnonzero(hit)
            fresh = np.ones(len(own), bool)
            fresh[1:] = (np.diff(own) > 1) | (np.diff(owner[own]) > 0)
            begins = own[fresh]
            ends = own[np.append(fresh[1:], True)] + 1 if len(own) else own
            spans = [[] for _ in range(batch.num_rows)]
            for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
                d = owner[b]
                spans[d].append({"first": b - int(words.first[d]), "end": e - int(words.first[d])})
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["text"],
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ],
                ["id", "text", "n_words", "spans", "items"],
            )

    return mark


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


SQL = r"""
with w as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as materialized (select item_id::varchar as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
win as materialized (select distinct item, least(10, len(ws)) as size, array_to_string(ws[k:k + least(10, len(ws)) - 1], ' ') as seq
    from b, unnest(range(1, greatest(1, len(ws) - 9) + 1)) as u(k) where len(ws) > 0),
sizes as (select distinct size from win),
places as (select doc_id, size, k, array_to_string(ws[k:k + size - 1], ' ') as seq
    from w, sizes, unnest(range(1, len(ws) - size + 2)) as u(k) where len(ws) >= size),
hits as materialized (select doc_id, p.size, k, item from places p join win using (size, seq)),
words as (select doc_id, count(distinct j) as n_hit from hits, unnest(range(k, k + size)) as u(j) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct doc_id, item from hits) group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join words using (doc_id) left join items using (doc_id)
"""
