"""Fill-in-the-middle, source mixing and collocations against brute force, on odd input too."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import collocations, infill, mixing
from tickloom.llm.fmindex import BidirectionalIndex

#: Null and repeated ids, repeated rows, null and empty texts, marks, and columns with clashing names.
TEXTS = [
    None, "", " ", "one", "two words", "  lead and trail \n", "été \U0001f600 ﬁn　x", "has <P> inside", "tail <", "P>head", "<", "a\tb\rc\x0bd",
    "the cat sat. the cat ran, the cat sat; The Cat!", "x " * 700, *[f"w{i % 7} w{i % 5} and the cat sat {i}" for i in range(60)],
]
ROWS = [(i if i % 9 else None, t, "ab"[i % 2] if i % 5 else None, ["de", None, "en"][i % 3]) for i, t in enumerate(TEXTS)]
ROWS += [ROWS[20], ROWS[20], (4, "again four", "a", "en"), (3, None, "", "und")]
CLASHING = ["id", "n", "h", "h1", "form", "output", "size", "copies", "of", "last", "phrase", "k", "f", "bucket", "row_number"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, source string, lang string")
    return rows.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


def empty(docs):
    return docs.limit(0)


def units(text):
    return re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)


def filled(doc_id, text, seed=42):
    text = text or ""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(key.encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    parts = units(text)
    a, b = sorted(x % (len(parts) + 1) for x in h[:2])
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or any(x in text for x in infill.MARKS) or h[2] % 100 >= 50:
        return (doc_id, len(parts), "plain", None, None, text)
    if h[3] % 100 < 80:
        return (doc_id, len(parts), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(parts), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_infill_by_brute_force_and_back(docs):
    made = infill.rearrange(docs).cache()
    got = sorted((tuple(r) for r in made.collect()), key=str)
    assert got == sorted((filled(r[0], r[1]) for r in ROWS), key=str)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
    back = infill.restore(made.withColumn("extra", F.lit(1)))
    assert back.columns == [*made.columns, "extra"]
    assert Counter(r.output for r in back.collect()) == Counter(r[1] or "" for r in ROWS)


def test_infill_of_a_long_text_and_of_nothing(spark, docs):
    text = "alpha beta  gammaé\n" * 200_000
    ids = [i for i in range(40) if filled(i, "a b")[2] != "plain"][:2]
    long = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")
    made = infill.rearrange(long)
    got = {r.id: r.output for r in made.collect()}
    assert got == {i: filled(i, text)[5] for i in ids}
    assert all(r.output == text for r in infill.restore(made).collect())
    assert infill.rearrange(empty(docs)).count() == 0


def test_marks_do_not_join_across_texts():
    import pyarrow as pa

    from tickloom.llm.words import Texts

    outputs = ["<P>a<S><M>b<", "<P><S>x<M>", "P>", "<S><P><M>"]
    forms = np.array(["psm", "psm", "plain", "spm"], object)
    assert infill._gather(Texts(pa.array(outputs)), forms).to_pylist() == ["ab<", "x", "P>", ""]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def hashed(doc_id, text, seed=42):
    inner = hashlib.md5(text.encode()).hexdigest() if text is not None else ""
    key = f"{seed}:{'' if doc_id is None else doc_id}:{inner}"
    return int(hashlib.md5(key.encode()).hexdigest()[:15], 16)


def levels(sizes, percent=100):
    """Targets by resharing the excess until no source is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = Fraction(sum(sizes.values()) * percent, 100), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = 3 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def mixed(rows, percent=100):
    sizes, groups = Counter(), defaultdict(Counter)
    for i, text, source, _ in rows:
        sizes[source] += words(text)
        groups[source][hashed(i, text)] += words(text)
    target, taken = levels(sizes, percent), {}
    for source, held in groups.items():
        budget = int(target[source])
        copies, left = divmod(budget, sizes[source]) if sizes[source] else (0, 0)
        before = 0
        for h in sorted(held):
            taken[source, h] = copies + (sizes[source] > 0 and 2 * (left - before) >= held[h])
            before += held[h]
            if before > left:
                for other in held:
                    if other > h:
                        taken[source, other] = copies
                break
    return target, {k: int(v) for k, v in taken.items()}


@pytest.mark.parametrize("percent", [100, 37, 250])
def test_mixing_by_brute_force(docs, percent):
    got = mixing.mix(docs, percent=percent).collect()
    assert len(got) == len(ROWS)
    target, taken = mixed(ROWS, percent)
    want = Counter((i, s, words(t), words(t) * taken[s, hashed(i, t)]) for i, t, s, _ in ROWS)
    assert Counter((r.id, r.source, r["size"], r.taken) for r in got) == want
    assert all(r.target == float(target[r.source]) for r in got)
    assert all(r.taken <= 3 * r["size"] for r in got)


def test_smaller_mixes_lie_in_larger_ones(docs):
    small, large = (Counter({(r.id, r.source, r["size"]): r.copies for r in mixing.mix(docs, percent=p).collect()}) for p in (20, 60))
    assert small != large and all(small[k] <= large[k] for k in small)


def test_mixing_of_odd_sources(spark, docs):
    assert mixing.mix(empty(docs)).count() == 0
    silent = spark.createDataFrame([(1, None, "a", "x"), (2, " ", None, "x")], "doc_id long, text string, source string, lang string")
    assert [(r.target, r.taken) for r in mixing.mix(silent).collect()] == [(0.0, 0), (0.0, 0)]
    # one hash for all rows of a source: they share their fate
    same = spark.createDataFrame([(1, "a b", "s", "x")] * 40 + [(2, "c", "t", "x")], "doc_id long, text string, source string, lang string")
    assert len({r.taken for r in mixing.mix(same).filter("source = 's'").collect()}) == 1


def test_index_lists_every_phrase():
    rng = np.random.default_rng(7)
    for symbols, size, depth in ((3, 60, 4), (6, 4_000, 3), (900, 9_000, 5), (4, 0, 3), (1 << 22, 500, 4)):
        text = np.concatenate([[0], rng.integers(0, symbols, size), [0]])
        for k, found in enumerate(BidirectionalIndex(text, symbols, depth).phrases(depth), 1):
            want = Counter(tuple(text[i : i + k].tolist()) for i in range(len(text) - k + 1) if 0 not in text[i : i + k])
            assert dict(zip(map(tuple, found.words.tolist()), found.count.tolist(), strict=True)) == want


def phrases(rows, longest, least, inside, top):
    out = []
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, _, lang in rows:
        lower = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            ws = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    counts[lang or "und"][tuple(ws[i : i + k])] += 1
    for lang, f in counts.items():
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in held.items():
            longer = [b for q, b in held.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= inside * a for b in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("longest", "least", "top"), [(3, 2, 2000), (4, 2, 7), (2, 3, 5)])
def test_collocations_by_brute_force(docs, longest, least, top):
    got = collocations.collocations(docs, longest=longest, least=least, top=top).collect()
    assert sorted(map(tuple, got)) == phrases(ROWS, longest, least, 50, top)


def test_collocations_across_shards_and_groups(spark, monkeypatch):
    for name, value in (("SHARD_WORDS", 40), ("SHARD_BYTES", 500), ("PENDING_BYTES", 900), ("GROUP_BYTES", 200), ("PENDING_ROWS", 50)):
        monkeypatch.setattr(collocations, name, value)
    rows = [(i, f"the cat {'sat on' if i % 3 else 'ran to'} the mat, a {i % 4} b " * 3, None, "abc"[i % 3]) for i in range(90)]
    rows.append((91, "no end of words " * 60, None, "a"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = collocations.collocations(frame.repartition(5)).collect()
    assert sorted(map(tuple, got)) == phrases(rows, 3, 10, 50, 2000)


def test_collocations_with_counts_past_64_bits(spark, monkeypatch):
    big = 4_000_000_000
    grams = [("x", "a", 1, 3 * big), ("x", "b", 1, 2 * big), ("x", "a b", 2, big), ("x", "", 0, 9 * big)]
    frame = spark.createDataFrame(grams, "lang string, phrase string, k int, f long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: frame)
    (row,) = collocations.collocations(frame).collect()
    assert (row.score, row.a, row.l, row.r, row.n) == (1_000_000 * big * big // (6 * big * big), big, 3 * big, 2 * big, 9 * big)


def test_collocations_of_nothing(spark, docs):
    assert collocations.collocations(empty(docs)).count() == 0
    silent = spark.createDataFrame([(1, None, None, None), (2, " .,", None, "x")], "doc_id long, text string, source string, lang string")
    assert collocations.collocations(silent).count() == 0
