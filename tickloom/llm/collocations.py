"""Phrase collocations from FM-indexes over word ids, one per shard of a language.

A task gathers the texts of a language into shards, numbers their words, and indexes the numbers in
both directions (``fmindex``). Extending the intervals of the index to the left and to the right in turn
lists every phrase of a shard up to a length, with its count. Counts are summed across shards, and
scores, containment and ranks follow from the phrases that are frequent enough.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.fmindex import BidirectionalIndex
from tickloom.llm.store import numbered, stored
from tickloom.llm.words import Texts, Words, mix, range_codes, steps

#: Words of a shard, and bytes of text gathered for one; a piece is never cut, however long.
SHARD_WORDS = 1 << 18
SHARD_BYTES = 1 << 20
#: Texts waiting in a task, all languages together; beyond it the largest language is indexed.
PENDING_BYTES = 6 << 20
#: Text bytes per group of phrases that are summed together.
GROUP_BYTES = 1 << 22
#: Tasks that sum phrases, at most.
MOST_TASKS = 20_000
#: Rows of phrases that wait in a task before they are summed.
PENDING_ROWS = 1 << 20
#: Copies of single words for joins, so that the phrases around a hot word spread.
SALTS = 8

_PIECE_ENDS = np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)
_BREAK = np.zeros(256, bool)
_BREAK[_PIECE_ENDS] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False

_U = np.uint64
_PACKED = "bucket int, lang string, n_phrases int, n_bytes int, phrases binary, counts binary"


def _packed(values: bytes | np.ndarray) -> bytes:
    return pa.compress(values if isinstance(values, bytes) else values.tobytes(), "zstd", asbytes=True)


def _shards(texts: Texts) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(dictionary of words, ids with a 0 before, between and after the pieces) of bounded length.

    Ids count from 1 in byte order of the words, so that intervals of the index stand in the order
    of their phrases.
    """
    words = Words(texts, _WORD, lower=True)
    if not len(words.start):
        return
    breaks = np.concatenate([[0], np.cumsum(_BREAK[words.data])])
    owner = words.owner()
    new = np.ones(len(words.start), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (breaks[words.start[1:]] != breaks[words.start[:-1]])
    begins = np.flatnonzero(new)
    low = 0
    while low < len(new):
        after = begins[np.searchsorted(begins, low + SHARD_WORDS, side="right") - 1]
        high = len(new) if low + SHARD_WORDS >= len(new) else int(after)
        if high <= low:  # one piece longer than a shard
            later = begins[begins > low]
            high = int(later[0]) if len(later) else len(new)
        yield _numbered_words(words, low, high, new)
        low = high


def _numbered_words(words: Words, low: int, high: int, new: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    start, end = words.start[low:high], words.end[low:high]
    inside = np.zeros(int(end[-1] - start[0]) + 1, np.int8)
    inside[start - start[0]] += 1
    inside[end - start[0]] -= 1
    data = words.data[start[0] : end[-1]][np.cumsum(inside[:-1], dtype=np.int8) > 0]
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    tokens = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = tokens.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    at = np.arange(high - low) + np.cumsum(new[low:high])
    ids = np.zeros(int(at[-1]) + 2, np.int64)
    ids[at] = rank[coded.indices.to_numpy()]
    return coded.dictionary.take(pa.array(order)), ids


def _phrases(dictionary: pa.Array, ids: np.ndarray, longest: int, buckets: int) -> Iterator[tuple]:
    """Rows of ``_PACKED`` but the language: every phrase of a shard once, grouped by bucket.

    A last row of bucket 0 holds the number of words as the count of an empty phrase.
    """
    offsets = np.frombuffer(dictionary.buffers()[1], np.int64)[dictionary.offset : dictionary.offset + len(dictionary) + 1]
    data = np.frombuffer(dictionary.buffers()[2], np.uint8)
    code = np.concatenate([np.zeros(1, _U), range_codes(data, offsets[:-1], offsets[1:])])
    texts, counts, bucket, lows = [], [], [], []
    index = BidirectionalIndex(ids, len(dictionary) + 1, longest)
    for found in index.phrases(longest):
        columns = [dictionary.take(pa.array(w - 1)) for w in found.words.T]
        texts.append(pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())) if len(columns) > 1 else columns[0])
        key = np.zeros(len(found.count), _U)
        for w in found.words.T:
            key = mix(key * _U(0x9FB21C651E98DF25) + code[w])
        bucket.append((key % _U(buckets)).astype(np.int64))
        counts.append(found.count)
        lows.append(found.low)
    bucket = np.concatenate(bucket)
    counts = np.concatenate(counts)
    order = np.argsort((bucket << 32) + np.concatenate(lows))
    rows = pa.concat_arrays(texts).take(pa.array(order))
    lines = pc.binary_join_element_wise(rows, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
    ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
    body = memoryview(lines.buffers()[2])
    bucket, counts = bucket[order], counts[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        part = bytes(body[ends[a] : ends[b]])
        yield int(bucket[a]), b - a, len(part), _packed(part), _packed(counts[a:b].astype("<i4"))
    yield 0, 1, 1, _packed(b"\n"), _packed(np.array([np.count_nonzero(ids)], "<i4"))


def _batch(rows: list[tuple[str, tuple]]) -> pa.RecordBatch:
    lang = [r[0] for r in rows]
    bucket, n, size, phrases, counts = zip(*(r[1] for r in rows), strict=True)
    arrays = [pa.array(bucket, pa.int32()), pa.array(lang, pa.string()), pa.array(n, pa.int32()), pa.array(size, pa.int32())]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array(phrases, pa.binary()), pa.array(counts, pa.binary())],
        ["bucket", "lang", "n_phrases", "n_bytes", "phrases", "counts"],
    )


def _indexed(longest: int, buckets: int):
    """Texts of a task to the packed phrases of its shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[pa.Array]] = defaultdict(list)
        size: dict[str, int] = defaultdict(int)

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            texts = Texts(pa.concat_arrays(waiting.pop(lang)))
            size.pop(lang)
            for dictionary, ids in _shards(texts):
                rows = []
                for row in _phrases(dictionary, ids, longest, buckets):
                    rows.append((lang, row))
                    if len(rows) >= 64:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)
            # workers live on after their task: what they no longer need goes back
            pa.default_memory_pool().release_unused()

        for batch in steps(batches):
            langs = batch["lang"].dictionary_encode()
            names, place = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            for i, lang in enumerate(names):
                part = batch["text"].take(pa.array(np.flatnonzero(place == i))).cast(pa.large_binary())
                waiting[lang].append(part)
                size[lang] += part.nbytes
                if size[lang] >= SHARD_BYTES:
                    yield from flush(lang)
            while sum(size.values()) > PENDING_BYTES:
                yield from flush(max(size, key=size.get))
        for lang in list(waiting):
            yield from flush(lang)

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _unpacked(row: dict) -> pa.Table:
    body = np.frombuffer(pa.decompress(row["phrases"], row["n_bytes"], "zstd"), np.uint8)
    ends = np.flatnonzero(body == 0x0A)
    offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int64)
    phrases = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(body[body != 0x0A])])
    counts = np.frombuffer(pa.decompress(row["counts"], 4 * row["n_phrases"], "zstd"), "<i4").astype(np.int64)
    return pa.table({"phrase": phrases, "f": counts})


def _summed(least: int):
    """Packed phrases, ordered by bucket and language, to the sums that reach ``least``."""

    def total(parts: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(parts).group_by("phrase", use_threads=False).aggregate([("f", "sum")])
        return pa.table({"phrase": found["phrase"], "f": found["f_sum"]})

    def closed(lang: str, parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        found = total(parts)
        keep = pc.or_(pc.greater_equal(found["f"], least), pc.equal(pc.binary_length(found["phrase"]), 0))
        found = found.filter(keep)
        text = found["phrase"].cast(pa.large_string()).cast(pa.string())
        found = pa.table({"lang": pa.array([lang] * found.num_rows, pa.string()), "phrase": text, "f": found["f"]})
        yield from found.combine_chunks().to_batches(max_chunksize=65_536)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, rows = None, [], 0
        for row in _rows(batches):
            if (row["bucket"], row["lang"]) != key:
                if parts:
                    yield from closed(key[1], parts)
                key, parts, rows = (row["bucket"], row["lang"]), [], 0
            parts.append(_unpacked(row))
            rows += row["n_phrases"]
            if rows > PENDING_ROWS and len(parts) > 1:
                parts = [total(parts)]
                rows = min(parts[0].num_rows, PENDING_ROWS // 2)
        if parts:
            yield from closed(key[1], parts)
        pa.default_memory_pool().release_unused()

    return run


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, phrase, k, f``: every phrase of up to ``longest`` words met ``least`` times or more.

    The empty phrase (``k`` 0) has the number of words of the language, which may be any. Counts are
    exact. Shards send each of their phrases once, whatever its count there, packed by groups whose
    number follows the bytes of all texts, so a group stays within a task's memory at any size.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = size // GROUP_BYTES + 1
    packed = rows.mapInArrow(_indexed(longest, buckets), _PACKED)
    # a task sums its buckets one after the other, so more of them per task take time, not memory
    tasks = min(buckets // 4 + 1, MOST_TASKS)
    dealt = packed.repartitionById(tasks, F.col("bucket") % tasks).sortWithinPartitions("bucket", "lang")
    found = dealt.mapInArrow(_summed(least), "lang string, phrase string, f long")
    k = F.when(F.col("phrase") == "", F.lit(0)).otherwise(F.size(F.split("phrase", " ")))
    return found.select("lang", "phrase", k.alias("k"), "f")


def _with_part(rows: DataFrame, grams: DataFrame, part: str, name: str) -> DataFrame:
    """``rows`` with the count of the phrase in column ``part``; single words are salted."""
    hot = F.size(F.split(F.col(part), " ")) == 1
    salt = F.when(hot, F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    copies = F.when(F.col("k") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    parts = grams.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(name), F.explode(copies).alias("_of"))
    salted = rows.withColumn("_salt", salt)
    found = salted.join(parts, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part")) & (F.col("_salt") == F.col("_of")))
    return found.drop("_lang", "_part", "_of", "_salt")


def collocations(
    docs: DataFrame, *, longest: int = 3, least: int = 10, inside: int = 50, top: int = 2000, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``top`` phrases of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and into words at blanks
    and tabs. A candidate has 2 to ``longest`` words and ``a >= least`` occurrences. Its score is the
    lowest ``1000000 * a * a div (l * r)`` over the places where it can be cut into a first part met
    ``l`` times and a rest met ``r`` times; of equal cuts the first counts. A candidate that stands
    inside a longer one with ``inside`` percent of its count or more is left out. Ranks go by score
    and count, highest first, then by bytes of the phrase; they are dense from 1. Arithmetic is in
    whole numbers of up to 38 digits.

    A null language counts as ``und``, a null text as empty; repeated rows count again; other columns
    and ids are not read. No words, or no candidate, give no rows. A text is indexed whole, whatever
    its length; only a piece is never cut between shards.
    """
    grams = stored(phrase_counts(docs, longest, least, lang_col, text_col), "grams")
    words = F.split("phrase", " ")
    several = grams.filter("k >= 2")
    # every place to cut, with the counts of both parts: these are frequent, as the phrase is
    cuts = several.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).withColumn("words", words)
    cuts = cuts.withColumn("head", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ")).withColumn(
        "tail", F.array_join(F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut")), " ")
    )
    shorter = grams.filter(f"k between 1 and {longest - 1}")
    cuts = _with_part(_with_part(cuts.drop("words"), shorter, "head", "l"), shorter, "tail", "r")
    a, l, r = (F.col(c).cast("decimal(19,0)") for c in ("f", "l", "r"))
    cuts = cuts.withColumn("square", (a * a * F.lit(1_000_000)).cast("decimal(38,0)")).withColumn("product", (l * r).cast("decimal(38,0)"))
    cuts = cuts.withColumn("score", F.expr("square div product"))
    lowest = F.min(F.struct("score", "cut", "l", "r"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("f").alias("a"), lowest.alias("c"))
    # what stands inside longer candidates, with the largest count of one of them
    spans = [(i, j) for i in range(longest) for j in range(2, longest) if i + j <= longest]
    span = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(j).alias("j")) for i, j in spans])) if spans else None
    if span is not None:
        within = several.filter("k > 2").withColumn("words", words).withColumn("span", span).filter("span.i + span.j - 1 <= k and span.j < k")
        held = within.groupBy(F.col("lang").alias("_lang"), F.array_join(F.expr("slice(words, span.i, span.j)"), " ").alias("_inner")).agg(F.max("f").alias("longer"))
        scored = scored.join(held, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_inner")), "left")
        scored = scored.filter(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    found = scored.select("lang", (-F.col("c.score")).alias("by_score"), (-F.col("a")).alias("by_count"), "phrase", F.col("c.l").alias("l"), F.col("c.r").alias("r"))
    ranked = stored(numbered(stored(found, "scored"), ["lang", "by_score", "by_count", "phrase"]), "ranked")
    first = ranked.groupBy(F.col("lang").alias("_lang")).agg(F.min("row_number").alias("first"))
    # one row per language, in a table of its own, so that Spark sees how small it is
    sizes = stored(grams.filter("k = 0").select(F.col("lang").alias("_of"), F.col("f").alias("n")), "sizes")
    rank = (F.col("row_number") - F.col("first") + 1).alias("rank")
    return (
        ranked.join(first, F.col("lang") == F.col("_lang"))
        .join(sizes, F.col("lang") == F.col("_of"))
        .select("lang", rank, "phrase", (-F.col("by_count")).alias("a"), "l", "r", "n", (-F.col("by_score")).alias("score"))
        .filter(F.col("rank") <= top)
    )


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language of all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
sizes as (select lang, sum(len(ws))::bigint as n from w group by lang),
g as (select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase, count(*)::bigint as f
    from w, unnest(range(1, len(ws) + 1)) as s(i), (values (1), (2), (3)) as t(k) where i + k - 1 <= len(ws) group by all having count(*) >= 10),
c as (select *, string_split(phrase, ' ') as ws from g where k >= 2),
cuts as (select c.lang, c.phrase, c.f as a, cut, h.f as l, t.f as r, ((1000000::hugeint * c.f * c.f) // (h.f::hugeint * t.f))::bigint as score
    from c, unnest(range(1, k)) as s(cut)
    join g h on h.lang = c.lang and h.phrase = array_to_string(c.ws[1:cut], ' ')
    join g t on t.lang = c.lang and t.phrase = array_to_string(c.ws[cut + 1:], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
longer as (select lang, phrase, max(f) as f from (select lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) as phrase from c where k = 3) group by all),
kept as (select best.* from best left join longer using (lang, phrase) where f is null or 100 * f < 50 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from kept join sizes using (lang)
qualify rank <= 2000
"""
