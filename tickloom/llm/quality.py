"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document; its outcome is one bit next to the measurements. A
policy is a named set of rules, that is a mask: applying one, comparing two or asking what a rule
adds reads the ledger and no text. Built-in column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"\x20\x09-\x0D"
WINDOW = 8

#: Rules by bit, as conditions on the measurements that mean failure. New rules go to the end.
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "5 * n_symbols > n_words"),
    ("exclamations", "2 * n_exclamations > n_words"),
    ("repeated_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars > 15 * n_words or word_chars < 2 * n_words"),
]
BASE = ("few_words", "repeated_words")
#: Versions of the policy and the rules each enforces.
POLICIES = {"v1": BASE, "v2": tuple(name for name, _ in RULES)}


def mask(rules) -> int:
    """The bits of some rules."""
    return sum(1 << bit for bit, (name, _) in enumerate(RULES) if name in rules)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text`` and the measurements of the whole text; a null text has no words and no lines.

    ``n_repeat_words`` counts the words inside windows of eight that stand twice or more in the
    text. Windows meet by a 64-bit hash within their own document.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    whole = F.coalesce("text", F.lit(""))
    bare = F.btrim(whole, F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.withColumn("_words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{_SPACE}]+")))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{_SPACE}]"))
    rows = rows.withColumns({"_lines": lines, "_h1": F.transform("_words", lambda w: F.xxhash64(w))})
    # hashes of two, four and eight words; those that run over the end are cut off
    for have in (1, 2, 4):
        rows = rows.withColumn(f"_h{2 * have}", _doubled(have))
    rows = rows.withColumn(
        "_windows", F.slice(f"_h{WINDOW}", F.lit(1), F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0)))
    )
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn(
        "_sorted", F.when(twice, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))))
    )
    same = F.filter(
        F.transform(
            "_sorted",
            lambda x, j: F.when(
                F.coalesce(F.get("_sorted", j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("_sorted", j + 1)["h"] == x["h"], F.lit(False)),
                x["p"],
            ),
        ),
        lambda p: p.isNotNull(),
    )
    rows = rows.withColumn("_places", F.sort_array(same))
    covers = F.transform("_places", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", j + 1) - p, F.lit(WINDOW))))
    return rows.select(
        "id",
        "text",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(whole, F.lit("!")).cast("long").alias("n_exclamations"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(covers, F.lit(0), lambda n, x: n + x), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _doubled(have: int) -> Column:
    return F.transform(f"_h{have}", lambda x, i: F.xxhash64(x, F.get(f"_h{have}", i + have)))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements with ``failures``, bit i set where rule i fails; one row per given row."""
    bits = [F.when(F.expr(rule), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, (_, rule) in enumerate(RULES)]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    # a row number, always 0 or more, keeps Spark from copying all measurements into filters on the bits
    kept_apart = F.when(F.monotonically_increasing_id() >= 0, failures.cast("long"))
    return measured(docs, id_col, text_col).withColumn("failures", kept_apart)


def keeps(policy: str) -> Column:
    """Whether a ledger row passes a version of the policy."""
    return F.col("failures").bitwiseAND(mask(POLICIES[policy])) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """(policy, rule, failed, alone): documents that fail each rule, and that fail no other.

    ``alone`` is what the policy would keep without the rule. Documents are first counted by their
    bits, so what the rules are compared on is at most one row per set of failed rules.
    """
    held = mask(POLICIES[policy])
    counts = rows.groupBy(F.col("failures").bitwiseAND(held).alias("bits")).agg(F.count("*").alias("n"))
    rules = [F.struct(F.lit(name).alias("rule"), F.lit(1 << bit).cast("long").alias("bit")) for bit, (name, _) in enumerate(RULES) if held >> bit & 1]
    return (
        counts.select("bits", "n", F.explode(F.array(*rules)).alias("r"))
        .groupBy(F.lit(policy).alias("policy"), F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("alone"),
        )
    )


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    rows = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~keeps("v1")).alias("base_failed"),
        keeps("v2").alias("kept"),
        "failures",
    )


_BITS = " + ".join(f"case when {rule} then {1 << bit} else 0 end" for bit, (_, rule) in enumerate(RULES))
SQL = rf"""
with w as materialized (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from documents),
p as (select doc_id, k, array_to_string(ws[k:k + 7], ' ') as seq from w, unnest(range(1, len(ws) - 6)) as u(k) where len(ws) >= 8),
again as (select doc_id, k from (select doc_id, k, count(*) over (partition by doc_id, seq) as n from p) where n > 1),
inside as (select doc_id, count(distinct j) as n from again, unnest(range(k, k + 8)) as u(j) group by doc_id),
m as (select w.doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, len(regexp_extract_all(text, '!'))::bigint as n_exclamations,
    len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
    from w left join inside using (doc_id)),
f as (select *, ({_BITS})::bigint as failures from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & {mask(BASE)} <> 0 as base_failed, failures & {mask(POLICIES["v2"])} = 0 as kept, failures from f
"""
