"""Parts of the methods that results depend on, held against brute force."""

from math import log2
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tickloom.llm import jaccard, language, licenses, pieces, quality, secrets, shards, substrings
from tickloom.llm.words import Texts


def brute_length(learned, text):
    """Bits of a text by prediction by partial matching, context by context."""
    counts = {}
    for t in learned:
        data = bytes(language.ORDER) + t
        for i in range(language.ORDER, len(data)):
            for order in range(language.ORDER + 1):
                seen = counts.setdefault(data[i - order : i], {})
                seen[data[i]] = seen.get(data[i], 0) + 1
    data, total = bytes(language.ORDER) + text, 0.0
    for i in range(language.ORDER, len(data)):
        for order in range(language.ORDER, -1, -1):
            seen = counts.get(data[i - order : i])
            if not seen:
                continue
            if data[i] in seen:
                total -= log2(seen[data[i]] / (sum(seen.values()) + len(seen)))
                break
            total -= log2(len(seen) / (sum(seen.values()) + len(seen)))
        else:
            total += 8
    return total


def test_code_lengths(spark):
    learned = [("de", "die Katze und der Hund"), ("de", "ein Haus"), ("en", "the cat and the dog"), ("en", "the the a"), ("xx", "")]
    trees = language.learn(spark.createDataFrame(learned, "lang string, text string"))
    assert trees.langs == ["de", "en", "xx"]
    texts = ["the cat", "der Hund", "", "zürich \U0001f600", "a", "xyz" * 50]
    got = language.code_lengths(trees, Texts(pa.array(texts)))
    for row, text in zip(got, texts, strict=True):
        for lang, bits in zip(trees.langs, row, strict=True):
            want = brute_length([t.encode() for x, t in learned if x == lang], text.encode())
            assert bits == pytest.approx(want, rel=1e-5, abs=1e-6)


def test_contexts_are_all_kept(spark):
    rows = [("en", "".join(chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676) + " " for i in range(9000)))]
    trees = language.learn(spark.createDataFrame(rows, "lang string, text string"))
    text = bytes(3) + rows[0][1].encode()
    assert len(trees.levels[3][0]) == len({text[i - 3 : i + 1] for i in range(3, len(text))}) > 20_000


def brute_matches(text):
    words = [w for w in "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()]
    return {
        (number, s)
        for number, (_, _, _, key) in enumerate(licenses._split())
        for s in range(len(words))
        if words[s : s + len(key)] == key
    }


def test_license_places(spark):
    templates = [words for _, words, _ in licenses.TEMPLATES]
    texts = [
        *templates, " x ".join(templates), "license mit license mit license", "public license general public license",
        "license", "by cc by nc cc by sa cc", "MIT-License, Apache (License)!", "mit license " * 3000, "", None,
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, matches string")
    got = {r.id: {(m.template, m.start) for m in r.matches} for r in licenses.scan(docs).collect()}
    assert got == {i: brute_matches(t or "") for i, t in enumerate(texts)}
    assert len(got[len(templates)]) >= len(templates)


def test_license_postings_decide(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "under the mit license and the apache license")], "doc_id long, text string")
    assert len(licenses.scan(docs).first().matches) == 2
    whole = licenses.postings
    monkeypatch.setattr(licenses, "postings", lambda weights, rank: {w: c for w, c in whole(weights, rank).items() if w != "mit"})
    assert [m.label for m in licenses.scan(docs).first().matches] == ["apache"]


def test_sketch_of_any_size_loses_no_window(spark):
    words = [f"w{i * 7919 % 389}" for i in range(1500)]
    texts = [" ".join(words[a : a + 90]) for a in range(0, 1400, 35)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [sorted(map(tuple, substrings.remove_repeats(docs, bits=b).select("id", "n_removed", "kept").collect())) for b in (6, 12, None)]
    assert found[0] == found[1] == found[2] and sum(r[1] for r in found[0]) > 0


@pytest.mark.parametrize("n", [1, 2, 3, 40, 257, 5000])
def test_permutation_is_one_to_one_and_fixed_by_its_seed(n):
    numbers = np.arange(n)
    places = shards.permute(numbers, n, 42)
    assert sorted(places) == list(range(n))
    # a number's place does not depend on which others are asked for
    assert [int(shards.permute(numbers[i : i + 1], n, 42)[0]) for i in range(min(n, 50))] == list(places[:50])
    assert (places == shards.permute(numbers, n, 42)).all()
    if n > 100:
        assert (places != shards.permute(numbers, n, 43)).mean() > 0.9
        # over many seeds, the correlation of numbers and places spreads as that of random orders does
        seen = [np.corrcoef(numbers, shards.permute(numbers, n, seed))[0, 1] for seed in range(200)]
        assert 0.85 < np.std(seen) * (n - 1) ** 0.5 < 1.15 and abs(np.mean(seen)) * (n - 1) ** 0.5 < 0.25


def test_ablations_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = quality.ledger(docs).select("failures")
    failures = [r.failures for r in rows.collect()]
    for policy in quality.POLICIES:
        held = quality.mask(quality.POLICIES[policy])
        own = [f & held for f in failures]
        want = {
            (policy, name, sum(f >> bit & 1 for f in own), sum(f == 1 << bit for f in own))
            for bit, (name, _) in enumerate(quality.RULES)
            if held >> bit & 1
        }
        got = {tuple(r) for r in quality.ablations(rows, policy).collect()}
        assert got == want and any(failed for _, _, failed, _ in want)


def test_hot_finding_leaves_the_sample_whole(spark):
    """Copies of one finding count once, and the cut by hash counts takes the smallest hashes."""
    texts = ['api_key = "9f8a7d6c5b4e3f2a1908b7c6d5e4f3a2"'] * 300 + [f"commit {i:020d} merged" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.scan(docs, sample=50).collect()
    assert len(found) == 500
    assert all(r.secret for r in found if r.candidate.startswith("9f8a"))


def test_all_findings_train_the_forest(spark, monkeypatch):
    given, features = [], secrets.features
    monkeypatch.setattr(secrets, "features", lambda rows, *learned: given.append(rows) or features(rows, *learned))
    text = F.concat(F.lit("commit "), F.lpad(F.col("id").cast("string"), 20, "0"), F.lit(" merged"))
    docs = spark.range(21_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    secrets.train(secrets.candidates(docs))
    assert given[0].filter("before = 'commit ' and after = ' merged'").select("candidate").distinct().count() == 21_000


def test_plain_words_need_no_decoding():
    with open(pieces.model_path(), "rb") as file:
        encoder = pieces.Encoder(file.read())
    lib, encoder.lib = encoder.lib, SimpleNamespace(encode=encoder.lib.encode)
    for text in ["", " ", "  two  words ", "a ▁ mark ▁▁x", "é漢\u0301 \U0001f600 \ufffd\x00\t\r\n end", "<unk> <s> </s> <0x41>"]:
        ids, decoded = encoder.encode(text)
        assert ids[:-1] == lib.encode(text) and decoded == lib.decode(ids)


def test_parities_bound_the_difference():
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(400)])
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 2, 3, 40, 300, 3000)]
    texts += [t.replace("w7 ", "new ") for t in texts]
    owner, codes, _ = jaccard._sets(Texts(pa.array(texts)), 3)
    sets = [set(codes[owner == i].tolist()) for i in range(len(texts))]
    marks = [sum((int(v) & (1 << 64) - 1) << 64 * i for i, v in enumerate(p)) for p in jaccard._parities(owner, codes, len(texts)).to_pylist()]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            odd = (marks[i] ^ marks[j]).bit_count()
            assert odd <= len(a ^ b) and (odd - len(a ^ b)) % 2 == 0
            assert (odd == 0) == (a == b)


def test_similar_sets_share_the_segments_they_need():
    """Of sets that link, each has as many segments in common with the other as ``need`` says, and the
    least common one in any order is among the first of both."""
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(30000)])
    texts = []
    for n in (8, 12, 20, 45, 70, 150, 151, 400, 2500):
        base = rng.choice(words, n)
        for cut in range(0, max(2, n // 9), max(1, n // 80)):
            texts += [" ".join(base[cut:]), " ".join(np.append(base, rng.choice(words, cut)))]
    for size, num, den in ((3, 9, 10), (5, 8, 10)):
        owner, codes, _ = jaccard._sets(Texts(pa.array(texts)), size)
        sets = [set(codes[owner == i].tolist()) for i in range(len(texts))]
        rows = {}
        for o, segment, upper, need in zip(*jaccard._segments(owner, codes, len(texts), jaccard._Levels(num, den, 2600)), strict=True):
            rows.setdefault((o, bool(upper)), ({}, need))[0][int(segment)] = None
        links = 0
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a != b and a and den * len(a & b) >= num * len(a | b):
                    met = []
                    for (o, upper), (x, need_a) in rows.items():
                        for (p, lower), (y, need_b) in rows.items():
                            if (o, p) == (i, j) and len(common := x.keys() & y.keys()) >= max(need_a, need_b):
                                met.append(all(sorted(z).index(min(common)) <= len(z) - need for z, need in ((x, need_a), (y, need_b))))
                    links += 1
                    assert any(met)
        assert links > 100


def test_a_common_passage_makes_no_meetings(spark, monkeypatch):
    """Texts that share a passage but are not similar do not meet; near copies among them do."""
    rng = np.random.default_rng(6)
    passage = [f"p{i}" for i in range(40)]
    bodies = [[*passage, *(f"b{i}" for i in rng.integers(0, 10**9, 120))] for _ in range(40)]
    texts = [" ".join(b) for b in bodies] + [" ".join(b[:-k]) for k, b in enumerate(bodies[:6], 1)]
    seen = {}
    kept = jaccard.stored

    def noted(df, name):
        out = kept(df, name)
        seen.setdefault(name, out)
        return out

    monkeypatch.setattr(jaccard, "stored", noted)
    found = jaccard.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, (8, 10))
    assert {r.key: r.component for r in found.collect()} == {i: i if i < 40 else i - 40 for i in range(46)}
    assert {r.key for r in seen["meetings"].select("key").collect()} == {*range(6), *range(40, 46)}


def test_overlaps_are_sums_of_fragments(spark):
    """A pair links by the sum of all its rows: with any one fragment's row gone, these pairs do not."""
    base = [f"w{i}" for i in range(200)]
    texts = {1: " ".join(base), 2: " ".join(base[:190]), 3: " ".join(base[:120])}
    rows = [(a, b, texts[a], texts[b]) for a, b in ((1, 2), (1, 3), (2, 3))]
    pairs = spark.createDataFrame(rows, "a long, b long, ta string, tb string")
    partial = pairs.mapInArrow(jaccard._partial_overlaps(3), "a long, b long, fragment int, common long, total long").cache()
    sums = {(r.a, r.b): (r.c, r.t) for r in partial.groupBy("a", "b").agg(F.sum("common").alias("c"), F.sum("total").alias("t")).collect()}
    assert sums == {(1, 2): (188, 386), (1, 3): (118, 316), (2, 3): (118, 306)}
    assert partial.count() == 48 and partial.select("a", "b", "fragment").distinct().count() == 48
    assert [tuple(r) for r in jaccard.linked(partial, 188, 198).collect()] == [(1, 2)]
    for gone in range(16):
        fewer = partial.withColumn("common", F.when(F.col("fragment") == gone, 0).otherwise(F.col("common")))
        assert jaccard.linked(fewer, 188, 198).isEmpty()
