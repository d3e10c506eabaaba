"""License scans with a positional index of rare words.

Templates are short word sequences with a mandatory key phrase. The index holds postings: for a
word, the templates and the places in them where it stands. A file looks up its own licence words
of the highest IDF, those that are the rarest or next rarest of some key phrase; a posting and the
word's place in the file give the place where the template would start. The places that both words
agree on are kept, and there the whole key phrase is verified. Built-in column functions only; the
plan does not grow with the templates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: (label, words, key phrase). The first three are the base phrases.
TEMPLATES = [
    ("mit", "mit license", "mit license"),
    ("apache", "apache license", "apache license"),
    ("gpl", "general public license", "general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license version 2"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("bsd", "bsd license", "bsd license"),
    ("mpl", "mozilla public license version 2 0", "mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc", "creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc0", "creative commons zero v1 0 universal", "creative commons zero"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute"),
    ("isc", "isc license", "isc license"),
    ("zlib", "this software is provided as is without any express or implied warranty", "provided as is without any express or implied warranty"),
    ("zlib", "zlib license", "zlib license"),
    ("boost", "boost software license version 1 0", "boost software license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("epl", "eclipse public license v 2 0", "eclipse public license"),
    ("eupl", "licensed under the european union public licence", "european union public licence"),
    ("cddl", "common development and distribution license", "common development and distribution license"),
    ("artistic", "the artistic license 2 0", "artistic license"),
    ("ofl", "sil open font license version 1 1", "open font license"),
    ("psf", "python software foundation license version 2", "python software foundation license"),
    ("postgresql", "the postgresql license", "postgresql license"),
    ("ms-pl", "microsoft public license", "microsoft public license"),
    ("wtfpl", "do what the fuck you want to public license", "want to public license"),
    ("gfdl", "gnu free documentation license", "free documentation license"),
    ("sspl", "server side public license", "server side public license"),
    ("busl", "business source license 1 1", "business source license"),
    ("proprietary", "all rights reserved no part of this work may be reproduced", "all rights reserved"),
]
_BASE = 3
#: Added to places, so that a template that would start before the text stays with its number.
_BIAS = 1 << 16
_PLACE = (1 << 32) - 1


def _split() -> list[tuple[str, list[str], int, list[str]]]:
    """(label, words, place of the key phrase, its words) of each template."""
    out = []
    for label, words, key in TEMPLATES:
        words, key = words.split(), key.split()
        at = next(k for k in range(len(words)) if words[k : k + len(key)] == key)
        out.append((label, words, at, key))
    return out


def words_of(text):
    """Words of a text after lower-casing A-Z; null has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lower, _BREAKS), lambda w: w != "")


def word_weights(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """Weight of each template word: thousandths of log2 of all documents over those that have it.

    Counts cover all documents and come back as one row per template word.
    """
    vocabulary = sorted({w for _, words, _, _ in _split() for w in words})
    words = docs.select(words_of(F.col(text_col)).alias("_words"))
    # no word is empty, so the empty one counts the documents
    present = F.concat(F.array_intersect("_words", F.lit(vocabulary)), F.array(F.lit("")))
    found = words.select(F.explode(present).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in found.collect()}
    total = counts.get("", 0)
    return {w: round(1000 * _log2((total + 1) / (counts.get(w, 0) + 1))) + 1 for w in vocabulary}


def _log2(x: float) -> float:
    from math import log2

    return log2(x)


def postings(weights: dict[str, int], rank: int) -> dict[str, list[int]]:
    """Per word: template and place, for the templates in whose key phrase it ranks so by weight.

    Rank 0 is the rarest word, of equals the first. A posting is the number of the template times
    2**32, less the word's place in the key phrase.
    """
    index: dict[str, list[int]] = {}
    for number, (_, _, _, key) in enumerate(_split()):
        place = sorted(range(len(key)), key=lambda k: (-weights[key[k]], k))[rank]
        index.setdefault(key[place], []).append((number << 32) + _BIAS - place)
    return index


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, n_words, matches``.

    ``matches`` has, in order of the templates, ``template``, ``label``, ``start`` and ``score``
    of every place where a template's key phrase stands: the place of its first word, counted from
    0, and the share of the template's weight found at the right relative places. Null and empty
    texts match nothing; repeated rows and null ids are scanned each for itself; other columns are
    not read, whatever their names; an empty table gives no rows. Texts of any length are scanned
    whole, in time that grows with their words. Nothing is shuffled but the counts.
    """
    weights = word_weights(docs, text_col)
    rows = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("_words"))
    index = [postings(weights, rank) for rank in (0, 1)]
    looked_up = sorted({w for words in index for w in words})
    hits = F.filter(
        F.transform("_words", lambda w, i: F.when(w.isin(looked_up), F.struct(w.alias("w"), i.alias("p")))),
        lambda x: x.isNotNull(),
    )
    none = F.array().cast("array<struct<w:string,p:int>>")
    rows = rows.withColumn("_hits", F.when(F.arrays_overlap("_words", F.lit(looked_up)), hits).otherwise(none))
    # where the postings of both words agree, by hashing: linear in the looked-up words of the file
    agreed = F.array_intersect(*[_starts("_hits", words) for words in index])
    rows = rows.withColumn("_agreed", F.when(F.size("_hits") > 1, agreed).otherwise(F.array().cast("array<bigint>")))
    templates = F.array(*[
        F.struct(
            F.lit(label).alias("label"), F.lit(at).alias("at"), F.lit(key).alias("key"), F.lit(words).alias("words"),
            F.lit([weights[w] for w in words]).alias("weights"), F.lit(sum(weights[w] for w in words)).alias("total"),
        )
        for label, words, at, key in _split()
    ])

    def opened(code):
        template = F.shiftright(code, 32).cast("int")
        start = (code.bitwiseAND(F.lit(_PLACE)) - F.lit(_BIAS)).cast("int")
        return F.struct(template.alias("template"), start.alias("start"), F.get(templates, template).alias("of"))

    def verified(m):
        return (m["start"] >= 0) & (F.slice("_words", F.greatest(m["start"], F.lit(0)) + 1, F.size(m["of"]["key"])) == m["of"]["key"])

    def match(m):
        first = m["start"] - m["of"]["at"]
        there = F.zip_with(m["of"]["words"], F.sequence(F.lit(0), F.size(m["of"]["words"]) - 1), lambda w, k: F.get("_words", first + k).eqNullSafe(w))
        got = F.aggregate(F.zip_with(there, m["of"]["weights"], lambda t, v: F.when(t, v).otherwise(0)), F.lit(0), lambda a, x: a + x)
        return F.struct(m["template"].alias("template"), m["of"]["label"].alias("label"), m["start"].alias("start"), (got / m["of"]["total"]).alias("score"))

    matches = F.transform(F.filter(F.transform(F.array_sort("_agreed"), opened), verified), match)
    return rows.select("id", F.size("_words").cast("long").alias("n_words"), matches.alias("matches"))


def _starts(hits: str, index: dict[str, list[int]]):
    """Template and start for each posting of each hit."""
    words = list(index)
    held = F.create_map(*[x for w in words for x in (F.lit(w), F.array(*[F.lit(code).cast("long") for code in index[w]]))])
    own = F.filter(hits, lambda x: x["w"].isin(words))
    return F.flatten(F.transform(own, lambda x: F.transform(F.element_at(held, x["w"]), lambda code: code + x["p"])))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("matches", lambda m: m["template"] < _BASE)

    def joined(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return found.withColumn("_base", base).select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(F.transform("_base", lambda m: m["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("_base", lambda m: m["start"])).cast("long").alias("last_word"),
        joined("_base").alias("base_labels"),
        joined("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


_VALUES = ", ".join(
    f"({n}, '{label}', {k}, '{w}', {str(at <= k < at + len(key)).lower()}, {at})"
    for n, (label, words, at, key) in enumerate(_split())
    for k, w in enumerate(words)
)
SQL = rf"""
with t(n, label, k, w, key, off) as (values {_VALUES}),
d as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
p as materialized (select doc_id, i - 1 as i, ws[i] as w from d, unnest(range(1, len(ws) + 1)) as u(i) where ws[i] in (select w from t)),
weight as (select w, (round(1000 * log2((1 + (select count(*) from documents)) / (1 + coalesce(n, 0)))) + 1)::bigint as v
    from (select distinct w from t) left join (select w, count(distinct doc_id) as n from p group by w) using (w)),
size as (select n, any_value(label) as label, any_value(off) as off, count(*) filter (key) as keys, sum(v) as total from t join weight using (w) group by n),
place as (select doc_id, n, i - k as s from p join t using (w) where key group by doc_id, n, i - k having count(*) = (select keys from size where size.n = t.n)),
m as (select doc_id, n, s, sum(v) as got from place join t using (n) join p using (doc_id) join weight on weight.w = t.w where p.w = t.w and p.i = s + t.k group by all),
x as (select doc_id, n, label, s + off as start, got / total as score from m join size using (n)),
r as (select doc_id, count(*) filter (n < {_BASE}) as n_base, min(start) filter (n < {_BASE}) as first_word, max(start) filter (n < {_BASE}) as last_word,
    string_agg(distinct label, ',' order by label) filter (n < {_BASE}) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(score) as score
    from x group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
    coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from d left join r using (doc_id)
"""
