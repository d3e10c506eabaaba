"""Fill-in-the-middle documents by displacement scatter, and back.

Every text is cut into prefix, middle and suffix and rearranged around three marks. A batch of texts
is one byte array: the cuts are scanned, a difference array holds the change of displacement at every
cut, its running sum is the shift of each byte, and one scatter writes the whole output. Going back,
the marks give the cuts and the same shifts gather the bytes home.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.words import GRAPHIC, Texts, Words, steps, strings

#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
_MARK = 3
#: Orders of the parts (0 prefix, 1 suffix, 2 middle, numbered as their marks) in the output.
_ORDERS = {"psm": (0, 1, 2), "spm": (1, 0, 2)}


def draws(id_col: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit draws per id, from the sha256 of ``seed:id``; a null id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _place(spans: np.ndarray, order: tuple[int, int, int]) -> np.ndarray:
    """Output offsets, within its text, of each part of texts whose parts have lengths ``spans``."""
    out = np.empty_like(spans)
    at = np.zeros(len(spans), np.int64)
    for part in order:
        at = at + _MARK
        out[:, part] = at
        at = at + spans[:, part]
    return out


def _shifts(size: int, starts: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The shift of each of ``size`` bytes: ``shift[i]`` from ``starts[i]`` on, starts ascending.

    Empty stretches share their start with the next one; their differences add up to nothing.
    """
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, np.diff(shift, prepend=0))
    return np.cumsum(change[:-1])


def _stretches(begin: np.ndarray, spans: np.ndarray, plain: np.ndarray, target: np.ndarray, forms: np.ndarray):
    """Starts of the stretches in the source texts (prefix, middle, suffix) and their shifts to the output."""
    places = np.zeros_like(spans)
    for form, order in _ORDERS.items():
        rows = forms == form
        places[rows] = _place(spans[rows], order)
    # source order is prefix, middle, suffix; parts are numbered prefix, suffix, middle
    lengths = spans[:, [0, 2, 1]]
    starts = begin[:, None] + np.concatenate([np.zeros((len(spans), 1), np.int64), np.cumsum(lengths, axis=1)[:, :2]], axis=1)
    aims = target[:, None] + places[:, [0, 2, 1]]
    aims[plain] = (target[:, None] + (starts - begin[:, None]))[plain]
    return starts.ravel(), (aims - starts).ravel()


def _cut(texts: Texts, draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units per text and the byte places of its two cuts.

    A unit is a word with the white space before it; white space at the end is one more.
    """
    words = Words(texts, GRAPHIC)
    last = words.end[np.maximum(words.first[1:] - 1, 0)] if len(words.end) else np.zeros(texts.n, np.int64)
    covered = np.where(words.counts > 0, last, texts.offsets[:-1])
    units = words.counts + (covered < texts.offsets[1:])
    cuts = np.sort(draw % (units[:, None] + 1), axis=1)
    places = np.empty((texts.n, 2), np.int64)
    for i in range(2):
        k = cuts[:, i]
        inside = words.end[np.minimum(words.first[:-1] + np.maximum(k, 1) - 1, max(len(words.end) - 1, 0))] if len(words.end) else np.zeros(texts.n, np.int64)
        places[:, i] = np.where(k == 0, texts.offsets[:-1], np.where(k > words.counts, texts.offsets[1:], inside))
    return units, places


def _scatter(texts: Texts, places: np.ndarray, forms: np.ndarray) -> pa.Array:
    plain = forms == "plain"
    begin, end = texts.offsets[:-1], texts.offsets[1:]
    spans = np.stack([places[:, 0] - begin, end - places[:, 1], places[:, 1] - places[:, 0]], axis=1)
    sizes = end - begin + np.where(plain, 0, 3 * _MARK)
    stop = np.cumsum(sizes)
    target = stop - sizes
    out = np.zeros(int(stop[-1]), np.uint8)
    starts, shift = _stretches(begin, spans, plain, target, forms)
    out[np.arange(len(texts.data)) + _shifts(len(texts.data), starts, shift)] = texts.data
    for form, order in _ORDERS.items():
        rows = np.flatnonzero(forms == form)
        at = target[rows, None] + _place(spans[rows], order) - _MARK
        for part in order:
            out[at[:, part, None] + np.arange(_MARK)] = np.frombuffer(MARKS[part].encode(), np.uint8)
    return strings(out, stop)


def _gather(texts: Texts, forms: np.ndarray) -> pa.Array:
    """Source texts from outputs: the marks, which stand once each, tell the lengths of the parts."""
    plain = forms == "plain"
    begin, end = texts.offsets[:-1], texts.offsets[1:]
    found = np.zeros((texts.n, 3), np.int64)
    data = texts.data
    for part, mark in enumerate(MARKS):
        code = np.frombuffer(mark.encode(), np.uint8)
        at = np.flatnonzero((data[:-2] == code[0]) & (data[1:-1] == code[1]) & (data[2:] == code[2])) if len(data) > 2 else np.zeros(0, np.int64)
        owner = np.searchsorted(end, at, side="right")
        # a mark that runs over into the next text, or stands in a plain one, is none
        at, owner = at[(at + _MARK <= end[owner]) & ~plain[owner]], owner[(at + _MARK <= end[owner]) & ~plain[owner]]
        found[owner, part] = at
    spans = np.zeros((texts.n, 3), np.int64)
    for form, order in _ORDERS.items():
        rows = forms == form
        for part, after in zip(order, [*order[1:], None], strict=True):
            stop = end if after is None else found[:, after]
            spans[rows, part] = (stop - found[:, part] - _MARK)[rows]
    spans[plain, 0] = (end - begin)[plain]
    sizes = spans.sum(axis=1)
    stop = np.cumsum(sizes)
    source = stop - sizes
    starts, shift = _stretches(source, spans, plain, begin, forms)
    total = int(stop[-1])
    return strings(data[np.arange(total) + _shifts(total, starts, shift)], stop)


def _chars(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points between places: bytes that continue one do not count."""
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return before[end] - before[start]


def rearrange(
    docs: DataFrame, *, seed: int = 42, rate: int = 50, suffix_first: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts the units of the text. Of 100 documents about ``rate`` are rearranged, of those
    ``suffix_first`` in the order suffix, prefix, middle (``spm``), the others as prefix, suffix,
    middle (``psm``). A text that is null, empty or holds one of the marks stays ``plain``. Draws
    depend on seed and id alone, so repeated ids draw alike, and a null id draws as an empty one.
    Other columns of ``docs`` are not read; an empty table gives no rows. A text is handled within
    one batch, whatever its length; memory is a few times the longest text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = draws(id_col, seed)
    plain = (text == "") | (h3 % 100 >= rate)
    for mark in MARKS:
        plain = plain | F.contains(text, F.lit(mark))
    form = F.when(plain, F.lit("plain")).when(h4 % 100 < suffix_first, F.lit("spm")).otherwise(F.lit("psm"))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = Texts(batch["text"])
            forms = np.array(batch["form"].to_pylist(), object)
            draw = np.stack([batch[c].to_numpy() for c in ("h1", "h2")], axis=1)
            units, places = _cut(texts, draw)
            rearranged = forms != "plain"
            lengths = [_chars(texts.data, a, b) for a, b in ((texts.offsets[:-1], places[:, 0]), (places[:, 0], places[:, 1]))]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(units), batch["form"], *(pa.array(x, mask=~rearranged) for x in lengths), _scatter(texts, places, forms)],
                names,
            )

    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [rows.schema["id"].dataType, T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()]
    return rows.mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))


def restore(rows: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``rows`` with the source text in place of the output: ``output`` and ``form`` alone decide it.

    All other columns pass through as they are; a null output counts as an empty text.
    """
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, output_col):
            forms = np.array(batch[form_col].to_pylist(), object)
            text = _gather(Texts(batch[output_col]), forms)
            yield pa.RecordBatch.from_arrays([text if c == output_col else batch[c] for c in schema.names], schema.names)

    return rows.mapInArrow(run, schema)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Every document rearranged and rebuilt, as digests."""
    made = rearrange(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return restore(made.withColumn("output_sha256", F.sha2("output", 256))).select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        "output_sha256",
        F.sha2("output", 256).alias("restored_sha256"),
    )


SQL = r"""
with d as (select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u from documents),
h as (select *, len(u)::bigint as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
    ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
         when h4 % 100 < 80 then 'spm' else 'psm' end as form from h),
p as (select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s from c)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(text) as restored_sha256 from p
"""
