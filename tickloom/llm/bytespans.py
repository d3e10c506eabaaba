"""Removal of repeated byte strings with suffix arrays.

Every string of ``window`` bytes has an anchor: the smallest hash among the grams in it, the
leftmost of equals. Equal strings have equal anchors at equal places, so the text around each
anchor, as far as the strings of that anchor reach, is all that must be compared. Contexts equal
as a whole are one class. Where a gram stands in several classes, the suffixes of its contexts are
sorted by the grouping construction (see ``suffixes``), in blocks of a few contexts, and strings
equal in their first ``window`` bytes are neighbours there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import keyed, stored
from tickloom.llm.suffixes import suffix_arrays
from tickloom.llm.words import BYTE_CODE, Texts, covered, mix, prefix_sums, range_hashes, steps

_U = np.uint64
#: Contexts of one gram whose suffixes are sorted together; more make more blocks.
BLOCK = 8
#: Contexts of one gram in one task at most; more are dealt over several.
_SPREAD = 4096
_GATHERED = 1_500_000
_SORTED_BYTES = 2 << 20
_ROWS = "h long, g int, key long, pos int, run int"


def _anchors(texts: Texts, window: int, gram: int):
    """(first string, number of strings, anchor) of each run of strings with one anchor, and the
    prefix sums of the bytes."""
    n = len(texts.data)
    sums = prefix_sums(BYTE_CODE[texts.data], 0)
    left = np.repeat(texts.offsets[1:], np.diff(texts.offsets)) - np.arange(n)
    whole = np.flatnonzero(left >= window)
    if not len(whole):
        return whole, whole, whole, sums
    best = np.full(n, ~_U(0))
    inner = np.flatnonzero(left >= gram)
    best[inner] = range_hashes(sums, inner, inner + gram, 0)
    place, span, have = np.arange(n, dtype=np.int32), window - gram + 1, 1
    while have < span:  # minima over doubling spans
        step = min(have, span - have)
        less = best[step:] < best[:-step]
        best = np.concatenate([np.where(less, best[step:], best[:-step]), best[n - step :]])
        place = np.concatenate([np.where(less, place[step:], place[:-step]), place[n - step :]])
        have += step
    anchor = place[whole]
    fresh = np.ones(len(whole), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(whole) > 1)
    begin = np.flatnonzero(fresh)
    return whole[begin], np.diff(np.append(begin, len(whole))), anchor[begin].astype(np.int64), sums


def _runs(key: np.ndarray, pos: np.ndarray, run: np.ndarray) -> pa.RecordBatch:
    """Removed strings as few rows: runs of one document that touch are joined."""
    order = np.lexsort((pos, key))
    key, pos, run = key[order], pos[order], run[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (pos[1:] != pos[:-1] + run[:-1])
    begin = np.flatnonzero(fresh)
    total = np.add.reduceat(run, begin) if len(begin) else run
    key, pos = key[begin], pos[begin]
    own = mix(key.view(_U) * _U(0x9E3779B97F4A7C15) ^ pos.astype(_U))
    return _batch(own, np.full(len(key), -1, np.int32), key, pos, total)


def _batch(h, g, key, pos, run) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(g.astype(np.int32)), pa.array(key), pa.array(pos.astype(np.int32)), pa.array(run.astype(np.int32))],
        ["h", "g", "key", "pos", "run"],
    )


def _contexts(window: int, gram: int):
    """(gram, context, key, pos, run, gone): the first place in a task of each context, and as
    ``gone`` the strings of all others, which start later."""

    def flush(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        code, context, key, pos, run = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((pos, key, context, code))
        code, context, key, pos, run = (x[order] for x in (code, context, key, pos, run))
        same = np.zeros(len(code), bool)
        same[1:] = (code[1:] == code[:-1]) & (context[1:] == context[:-1])
        twice = same.copy()  # one document given twice
        twice[1:] &= (key[1:] == key[:-1]) & (pos[1:] == pos[:-1])
        names = ["code", "context", "key", "pos", "run", "gone"]
        for rows, gone in ((np.flatnonzero(~same), False), (np.flatnonzero(same & ~twice), True)):
            columns = [code[rows].view(np.int64), context[rows].view(np.int64), key[rows], pos[rows].astype(np.int32), run[rows].astype(np.int32)]
            if gone:
                joined = _runs(key[rows], pos[rows], run[rows])
                columns = [joined["h"], joined["h"], joined["key"], joined["pos"], joined["run"]]
            count = len(columns[0])
            yield pa.RecordBatch.from_arrays([*(pa.array(c) if isinstance(c, np.ndarray) else c for c in columns), pa.array(np.full(count, gone))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, have = [], 0
        for batch in steps(batches):
            texts = Texts(batch["text"])
            first, many, anchor, sums = _anchors(texts, window, gram)
            if not len(first):
                continue
            owner = np.searchsorted(texts.offsets, first, side="right") - 1
            context = range_hashes(sums, first, first + many - 1 + window, 0)
            context = mix(context ^ mix(((anchor - first).astype(_U) << _U(32)) | many.astype(_U)))
            code = range_hashes(sums, anchor, anchor + gram, 0)
            keys = batch["key"].to_numpy()
            parts.append((code, context, keys[owner], first - texts.offsets[owner], many))
            have += len(first)
            if have > _GATHERED:
                yield from flush(parts)
                parts, have = [], 0
        if parts:
            yield from flush(parts)

    return run


def _bytes_of(window: int):
    """The bytes of the contexts listed for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = Texts(batch["text"])
            lists = batch["open"]
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            code, many, pos, run_ = (flat.field(i) for i in range(4))
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            start = texts.offsets[doc] + pos.to_numpy()
            length = run_.to_numpy() - 1 + window
            ends = np.cumsum(length)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + length, length)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(texts.data[at]))])
            yield pa.RecordBatch.from_arrays(
                [code, many, batch["key"].take(pa.array(doc)), pos, run_, data], ["code", "many", "key", "pos", "run", "bytes"]
            )

    return run


def _repeats(window: int):
    """Rows (h, g, key, pos, run) of the contexts of each gram, which come together.

    Within a block of contexts, strings are equal where they are neighbours in the suffix array
    with ``window`` equal bytes. The first of each is left, the others are removed; where a gram
    has several blocks, the first ones go on with run 0, to be compared with those of the others.
    """

    def solve(code, many, key, pos, run, lengths, data) -> Iterator[pa.RecordBatch]:
        rows = len(code)
        change = np.ones(rows, bool)
        change[1:] = code[1:] != code[:-1]
        heads = np.flatnonzero(change)
        rank = np.arange(rows) - np.repeat(heads, np.diff(np.append(heads, rows)))
        opens = np.flatnonzero(rank % BLOCK == 0)
        block = np.cumsum(rank % BLOCK == 0) - 1
        # each context ends with symbol 1, each block with symbol 0; bytes are 2 and more
        ends = np.cumsum(lengths)
        dest = ends - lengths + np.arange(rows) + block
        total = len(data) + rows + len(opens)
        raw = np.zeros(total, np.uint8)
        symbols = np.ones(total, np.int16)
        at = np.arange(len(data)) + np.repeat(dest - ends + lengths, lengths)
        raw[at] = data
        symbols[at] = data.astype(np.int16) + 2
        base = np.append(dest[opens], total)
        symbols[base[1:] - 1] = 0
        order = suffix_arrays(symbols, base)
        context = np.full(total, -1, np.int64)
        inside = np.arange(run.sum()) + np.repeat(dest - np.cumsum(run) + run, run)
        context[inside] = np.repeat(np.arange(rows), run)
        order = order[context[order] >= 0]  # suffixes that start a whole string
        of = context[order]
        sums = prefix_sums(BYTE_CODE[raw], 0)
        code_of = range_hashes(sums, order, order + window, 0)
        near = np.flatnonzero((block[of[1:]] == block[of[:-1]]) & (code_of[1:] == code_of[:-1]))
        eight = np.ndarray((max(total - 7, 0),), "<u8", raw, strides=(1,))
        for k in [*range(0, window - 8, 8), window - 8]:
            near = near[eight[order[near] + k] == eight[order[near + 1] + k]]
        equal = np.zeros(len(order), bool)
        equal[near + 1] = True
        group = np.cumsum(~equal)
        where = pos[of] + order - dest[of]
        by = np.lexsort((where, key[of], group))
        group, keys, where, of, code_of, order = group[by], key[of][by], where[by], of[by], code_of[by], order[by]
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        lead = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
        later = (keys != keys[lead]) | (where != where[lead])
        if later.any():
            yield _runs(keys[later], where[later], np.ones(later.sum(), np.int64))
        on = first & (many[of] > BLOCK)
        if on.any():
            second = range_hashes(prefix_sums(BYTE_CODE[raw] ^ _U(0x5555), 1), order[on], order[on] + window, 1)
            h = mix(code_of[on] ^ code[of[on]].view(_U))
            yield _batch(h, (second >> _U(33)).astype(np.int32), keys[on], where[on], np.zeros(on.sum(), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def take(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            table = pa.concat_batches(held)
            code = table["code"].to_numpy()
            stop = len(code)
            if not final:  # contexts of the last gram may go on
                change = np.flatnonzero(code[1:] != code[:-1])
                stop = int(change[-1]) + 1 if len(change) else len(code)
            part = table.slice(0, stop)
            held = [table.slice(stop)] if stop < len(code) else []
            size = held[0]["bytes"].nbytes if held else 0
            texts = Texts(part["bytes"])
            columns = [part[c].to_numpy() for c in ("code", "many", "key", "pos", "run")]
            yield from solve(*columns, np.diff(texts.offsets), texts.data)

        for batch in batches:
            low = 0
            while low < batch.num_rows:
                piece = batch.slice(low, 4096)
                low += piece.num_rows
                held.append(piece)
                size += piece["bytes"].nbytes
                if size > _SORTED_BYTES:
                    yield from take(False)
        if held:
            yield from take(True)

    return run


def _without(window: int):
    """Texts without the bytes that the removed strings cover; marks are pos * 2**32 + run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = Texts(batch["text"])
            marks = batch["marks"]
            flat = marks.flatten().to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            start = texts.offsets[doc] + (flat >> 32)
            gone = covered(len(texts.data), start, start + (flat & 0xFFFFFFFF) - 1 + window)
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            edge = texts.offsets[:-1][np.diff(texts.offsets) > 0]
            begins[edge] = gone[edge]
            totals = [np.concatenate([[0], np.cumsum(x)])[texts.offsets] for x in (gone, begins, ~gone)]
            offsets = totals[2].astype(np.int64)
            kept = pa.Array.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(texts.data[~gone]))]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["id"], pa.array(np.diff(texts.offsets)), *(pa.array(np.diff(t).astype(np.int64)) for t in totals[:2]), kept],
                ["key", "id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_repeated_bytes(docs: DataFrame, window: int = 100, gram: int = 36, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``key, id, n_bytes, n_removed, n_spans, kept``.

    Bytes covered by a string of ``window`` bytes that also starts earlier, in a smaller id or
    earlier in the same document, are removed; strings are judged on the input and never cross
    documents. ``n_spans`` counts maximal removed runs, ``kept`` has the other bytes. Null and
    empty texts have no bytes. Where ids repeat or are null, rows are told apart by id, nulls
    first, and text (see ``keyed``); rows equal in both are one document.
    """
    if window < gram or window < 8:
        raise ValueError("the window must hold a gram and eight bytes")
    base = keyed(docs, id_col, text_col)
    rows = base.select("key", "text").mapInArrow(
        _contexts(window, gram), "code long, context long, key long, pos int, run int, gone boolean"
    )
    # tasks have sent each context once, so a class has as many rows here as there are tasks at most
    rows = rows.repartition("code").sortWithinPartitions("code", "context", "key", "pos")
    rows = rows.withColumn("first", F.expr("min(struct(key, pos)) over (partition by code, context)"))
    rows = rows.withColumn("later", F.expr("gone or struct(key, pos) > first")).withColumn(
        "many", F.expr("if(later, 0, count(if(later, null, 1)) over (partition by code))").cast("int")
    )
    seen = rows.filter("later or many > 1").groupBy("key").agg(
        F.collect_list(F.expr("if(later, shiftleft(cast(pos as long), 32) + run, null)")).alias("marks"),
        F.collect_list(F.expr("if(later, null, struct(code, many, pos, run))")).alias("open"),
    )
    # one row per document with repeats: from here on, contexts are places until their bytes are needed
    seen = stored(seen, "classes")
    opened = base.join(seen.filter("size(open) > 0").select(F.col("key").alias("of"), "open"), F.col("key") == F.col("of"))
    contexts = opened.select("key", "text", "open").mapInArrow(
        _bytes_of(window), "code long, many int, key long, pos int, run int, bytes binary"
    )
    spread = F.pmod(F.xxhash64("key", "pos"), F.ceil(F.col("many") / _SPREAD).cast("long"))
    found = contexts.repartition("code", spread).sortWithinPartitions("code").mapInArrow(_repeats(window), _ROWS)
    found = found.withColumn("first", F.expr("min(struct(key, pos)) over (partition by h, g)")).filter(
        "run > 0 or struct(key, pos) > first"
    )
    more = found.groupBy(F.col("key").alias("of")).agg(
        F.collect_list(F.shiftleft(F.col("pos").cast("long"), 32) + F.greatest("run", F.lit(1))).alias("more")
    )
    more = stored(more, "repeats")
    none = F.array().cast("array<long>")
    marks = seen.select("key", "marks").join(more, F.col("key") == F.col("of"), "left").select(
        F.col("key").alias("of"), F.concat(F.coalesce("marks", none), F.coalesce("more", none)).alias("marks")
    )
    return (
        base.join(marks, F.col("key") == F.col("of"), "left")
        .select("key", "id", "text", F.coalesce("marks", none).alias("marks"))
        .mapInArrow(_without(window), "key long, id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    found = remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


SQL = r"""
with b as materialized (select doc_id, hex(coalesce(text, '')) as x, strlen(coalesce(text, '')) as n from documents),
p as materialized (select doc_id, k, md5(substr(x, 2 * k + 1, 200)) as seq from b, unnest(range(0, n - 99)) as u(k) where n >= 100),
later as materialized (select doc_id, k from (select doc_id, k, row_number() over (partition by seq order by doc_id, k) as r from p) where r > 1),
bytes as (select doc_id, j, substr(x, 2 * j + 1, 2) as byte from b, unnest(range(0, n)) as u(j)),
g as (select bytes.doc_id, j, byte, coalesce(max(k) over (partition by bytes.doc_id order by j rows unbounded preceding) >= j - 99, false) as gone
    from bytes left join later on later.doc_id = bytes.doc_id and later.k = bytes.j),
s as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by j), false) as opens from g),
r as (select doc_id, count(*) filter (gone) as n_removed, count(*) filter (opens) as n_spans,
    coalesce(string_agg(byte, '' order by j) filter (not gone), '') as kept from s group by doc_id)
select b.doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
    sha256(unhex(coalesce(kept, ''))) as kept_sha256
from b left join r using (doc_id)
"""
