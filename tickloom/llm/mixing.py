"""Mixing sources to target weights by hash thresholds, without sorting any documents.

Every document has a fixed hash. A source that should give a share of its words gives the documents
whose hash lies below a threshold, so the documents of a smaller budget are among those of a larger
one. The threshold is found from sums of words by source and hash bucket; only the bucket in which
the budget ends is cut into finer buckets, level by level, until the hash has no bits left. Built-in
column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import numbered, stored

#: Weights of the sources in order, repeating, and how often a document may be taken.
WEIGHTS = (5, 2, 1)
MOST = 3
#: Bits of a document's hash, and of the buckets of one level.
HASH_BITS = 60
LEVEL_BITS = 12


def _hash(seed: int, id_col: str, text_col: str) -> Column:
    """60 bits of an md5 of seed, id and text: rows equal in both share them, and their fate."""
    text = F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit(""))
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), text)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, source, size, h`` per document: what mixing needs of a text. A null text has no words."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        _hash(seed, id_col, text_col).alias("h"),
    )


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, percent: int = 100) -> DataFrame:
    """``source, source_size, numerator, denominator``: the target words of each source as a fraction.

    ``sources`` holds (source, source_size). Sources weigh ``weights`` in code point order, null last,
    and share ``percent`` of all words; a target stops at ``most`` times the source's own words and
    the excess goes to the others by weight. The level that the open sources share rises with every
    one that stops, so each round of the loop closes some, or it ends; a round reads one row per
    source and brings back two sums.
    """
    ordered = numbered(sources.withColumn("last", F.col("source").isNull()), ["last", "source"])
    cycle = F.array(*[F.lit(w) for w in weights])
    held = stored(
        ordered.select("source", "source_size", F.get(cycle, (F.col("row_number") % len(weights)).cast("int")).cast("long").alias("weight")),
        "sources",
    )
    total = held.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * percent
    left, open_weight = total, None
    while True:
        # open are those whose own bound lies above the level left / open_weight, both in hundredths
        if open_weight is None:
            is_open = F.lit(True)
        else:
            is_open = _wide(F.col("source_size") * (100 * most)) * _wide(F.lit(open_weight)) > _wide(F.lit(left)) * F.col("weight")
        sums = held.agg(
            F.coalesce(F.sum(F.when(is_open, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_open, F.col("source_size"))), F.lit(0)),
        ).first()
        now = (total - sums[1] * 100 * most, sums[0])
        if now == (left, open_weight) or not sums[0]:
            break
        left, open_weight = now
    return held.select(
        "source",
        "source_size",
        F.when(is_open, _wide(F.lit(left)) * F.col("weight")).otherwise(_wide(F.col("source_size")) * (100 * most)).cast("decimal(38,0)").alias("numerator"),
        F.when(is_open, F.lit(100 * (open_weight or 1))).otherwise(F.lit(100)).cast("long").alias("denominator"),
    )


def _wide(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, copies, threshold`` for each row of ``budgets`` (source, source_size, budget).

    A source's documents are taken ``copies`` times, those with a hash below ``threshold`` once more.
    The words below it come nearest to what is left of the budget, a tie counting as below. Per
    level, words are summed by source and bucket before the shuffle, and only documents of a
    source's boundary bucket reach the next level. Documents of one hash stay together.
    """
    whole = F.col("source_size") > 0
    copies = F.when(whole, F.expr("budget div source_size")).otherwise(F.lit(0)).cast("long")
    left = F.when(whole, F.col("budget") % F.col("source_size")).otherwise(F.lit(0)).cast("long")
    held = budgets.select(F.col("source").alias("of"), copies.alias("copies"), left.alias("left"), F.lit(0).cast("long").alias("prefix"))
    for low in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        prefix = F.shiftright("h", low + LEVEL_BITS)
        bucket = F.shiftright("h", low).bitwiseAND((1 << LEVEL_BITS) - 1)
        found = (
            rows.join(held, F.col("source").eqNullSafe(F.col("of")) & (prefix == F.col("prefix")))
            .groupBy("of", "left", bucket.alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        # at most one row per bucket and source meets here
        before = F.expr("sum(words) over (partition by of order by bucket) - words")
        found = found.withColumn("before", before)
        # the first bucket that does not fit; where all fit, the one after the last
        ends = F.min(F.when(F.col("before") + F.col("words") > F.col("left"), F.struct("bucket", "before", "words")))
        cut = found.groupBy("of").agg(ends.alias("cut")).withColumnRenamed("of", "cut_of")
        joined = held.join(cut, F.col("of").eqNullSafe(F.col("cut_of")), "left")
        width = F.lit(1 << LEVEL_BITS).cast("long")
        next_prefix = F.col("prefix") * width
        if low:
            # a level that fits whole ends the search: no document lies below the last prefix
            held = joined.select(
                "of", "copies",
                F.when(F.col("cut").isNull(), F.lit(0)).otherwise(F.col("left") - F.col("cut.before")).cast("long").alias("left"),
                F.coalesce(next_prefix + F.col("cut.bucket"), next_prefix + width).alias("prefix"),
            )
        else:
            nearer = 2 * (F.col("left") - F.col("cut.before")) >= F.col("cut.words")
            last = next_prefix + F.col("cut.bucket") + nearer.cast("long")
            held = joined.select("of", "copies", F.coalesce(last, next_prefix + width).alias("threshold"))
        held = stored(held, "thresholds")
    return held.withColumnRenamed("of", "source")


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    percent: int = 100,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: ``id, source, size, source_size, target, copies, taken``.

    ``copies`` is how often the mix takes the document, ``taken`` its words times that. Targets are
    in ``source_targets``; a source's taken words differ from its target by half a document at most,
    or by half a group of rows that are equal in id and text, which share their fate. A null source
    is one of its own, after all others. Ids may be null or repeat; texts that are null or empty have
    size 0; other columns are not read. An empty table gives no rows.
    """
    rows = stored(sized(docs, seed, id_col, text_col, source_col), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sources, weights, most, percent), "targets")
    # the next whole number: a budget of half words cannot matter to whole documents
    budgets = targets.select("source", "source_size", F.expr("numerator div denominator").alias("budget"))
    cuts = thresholds(rows, budgets)
    plan = targets.join(cuts.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "of", "source_size", (F.col("numerator").cast("double") / F.col("denominator").cast("double")).alias("target"), "copies", "threshold"
    )
    taken = (F.col("copies") + (F.col("h") < F.col("threshold")).cast("long")).alias("copies")
    found = rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).select("id", "source", "size", "source_size", "target", taken)
    return found.withColumn("taken", F.col("size") * F.col("copies"))


def op13_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All documents mixed at the default weights."""
    found = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


SQL = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5('42:' || coalesce(doc_id::varchar, '') || ':' || coalesce(md5(text), '')), 1, 15))::bigint as h from documents),
s as (select *, case (row_number() over (order by source is null, source) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
    from (select source, sum(size)::bigint as source_size from d group by source)),
-- sources stop in order of their bound per weight: the first that stays open fixes the level
o as (select *, sum(source_size) over () as total, 3 * source_size::double / weight as bound,
    sum(3 * source_size) over (order by 3 * source_size::double / weight) as stopped,
    coalesce(sum(weight) over (order by 3 * source_size::double / weight desc) - sum(weight) over (partition by 3 * source_size::double / weight), 0) as above from s),
stops as (select *, above * bound + stopped <= total as stop from o),
k as (select coalesce(sum(3 * source_size) filter (stop), 0) as gone, coalesce(sum(weight) filter (not stop), 1) as open_weight, any_value(total) as words from stops),
t as (select source, source_size, case when stop then (300 * source_size)::hugeint else (100 * (words - gone) * weight)::hugeint end as num,
    case when stop then 100 else 100 * open_weight end as den from stops, k),
b as (select *, num::double / den::double as target, (num // den)::bigint as budget,
    case when source_size > 0 then (num // den)::bigint // source_size else 0 end as copies,
    case when source_size > 0 then (num // den)::bigint % source_size else 0 end as lft from t),
c as (select d.*, b.source_size, b.target, b.copies, b.lft, sum(size) over (partition by d.source order by h) as upto,
    sum(size) over (partition by d.source, h) as own from d join b on d.source is not distinct from b.source),
f as (select *, min(case when upto > lft then h end) over (partition by source) as cut from c)
select doc_id, size, source_size, target,
    (size * (copies + case when cut is null or h < cut then 1 when h = cut and 2 * (lft - (upto - own)) >= own then 1 else 0 end))::bigint as taken from f
"""
