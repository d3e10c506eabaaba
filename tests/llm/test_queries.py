"""The training-text queries on a small fixture: against their SQL, brute force or a public library.

The fixture holds null and empty texts, exact and near copies, a benchmark passage, a secret and a
very long text.
"""

import hashlib
import tempfile
import zlib

import corpus_pipeline
import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tickloom.llm import jaccard, language, pieces, quality, secrets
from tickloom.llm.suite import ORACLE, QUERIES

SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
SECRET = 'password = "Qz7vT1xLw93bRk22mN8pHd45"'


def folder(rows, benchmark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    pq.write_table(pa.Table.from_pylist(rows, schema=SCHEMA), f"{path}/documents.parquet")
    pq.write_table(benchmark, f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def rows():
    docs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()[:70]
    items = [r["text"] for r in pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist() if r["text"]]
    base = next(r["text"] for r in docs if r["text"] and len(r["text"].split()) > 60)
    near = base.split(" ")
    near[len(near) // 2] = "changedword"
    extra = [
        None, "", "   \n\t", "ok", base, base, " ".join(near), base + " " + items[0],
        base[: len(base) // 2] + " " + SECRET + " " + base[len(base) // 2 :],
        "The MIT License and the Apache License, or the GNU General Public License.\n" * 3,
        "été \U0001f600 ﬁn 　 Á ­" * 5, " ".join(f"w{i * i % 977}" for i in range(6000)),
    ]
    return docs + [
        {"doc_id": 10_000 + i, "text": t, "lang": "en" if i % 2 else None, "source": "web" if i % 3 else None, "n_chars": len(t or "")}
        for i, t in enumerate(extra)
    ]


@pytest.fixture(scope="module")
def small(rows):
    return folder(rows, pq.read_table(f"{SF_DIR}/benchmark.parquet"))


@pytest.fixture(scope="module")
def nothing():
    return folder([], pq.read_table(f"{SF_DIR}/benchmark.parquet").slice(0, 0))


def table(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, small)
    assert table(got.columns, [tuple(r) for r in got.collect()]) == table(want.columns, want.fetchall())


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, nothing, name):
    assert QUERIES[name](spark, nothing).count() == 0


def test_shards_are_gapless_and_even(spark, small, rows):
    got = QUERIES["op3_feistel_shards"](spark, small).collect()
    text = {r["doc_id"]: (r["text"] or "").encode() for r in rows}
    assert sorted(r.doc_id for r in got) == sorted(text)
    assert all((r.size, r.text_crc32) == (len(text[r.doc_id]) + 16, zlib.crc32(text[r.doc_id])) for r in got)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))
    counts = [len(slots.get(s, [])) for s in range(40)]
    assert {r.law for r in got} == {"rows"} and max(counts) - min(counts) <= 1


def test_language_by_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()}
    got = QUERIES["op4_language_id"](spark, SF_DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id] and r.lang_pred != "und"]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held) > 0


def test_language_of_texts_without_letters(spark, small):
    got = {r.doc_id: r.lang_pred for r in QUERIES["op4_language_id"](spark, small).collect()}
    assert [got[i] for i in (10_000, 10_001, 10_002)] == ["und"] * 3


def test_language_learned_from_nothing(spark):
    docs = spark.createDataFrame([(1, "", "en"), (2, "words", None), (3, None, "de")], "doc_id long, text string, lang string")
    got = {r.id: r.lang_pred for r in language.predict(docs, language.learn(docs)).collect()}
    assert got == {1: "und", 2: "en", 3: "und"}


def test_planted_secret_is_found_and_replaced(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("score", F.lit(1))
    found = secrets.scan(docs).cache()
    hit = found.filter("id = 10008 and secret").select("candidate").collect()
    assert "Qz7vT1xLw93bRk22mN8pHd45" in [r.candidate for r in hit]
    clean = secrets.redact(docs, found)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert "Qz7vT1xLw93bRk22mN8pHd45" not in clean.filter("doc_id = 10008").first().text


def test_pieces_are_those_of_the_library(spark, small, rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    got = {r.doc_id: r for r in QUERIES["op10_sentencepiece"](spark, small).collect()}
    for row in rows:
        ids = model.encode(row["text"] or "", add_eos=True)
        r = got[row["doc_id"]]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_jaccard_at_the_threshold(spark):
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()

    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[: 60 - cut]) for cut in range(12)] + ["a b", "A B", "", "a b c"]
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.key: r.component for r in jaccard.jaccard_components(docs, 3, (9, 10), "doc_id").collect()}
    assert got == dict(enumerate(label))


def test_policies_and_ablations(spark, small):
    ledger = quality.ledger(spark.read.parquet(f"{small}/documents.parquet")).cache()
    kept = ledger.filter(quality.keeps("v2")).count()
    assert 0 < kept < ledger.count()
    assert quality.ablations(ledger, "v2").filter("alone > failed").count() == 0


def test_pipeline_stages(spark, small, rows):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    ids = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, docs, small).cache()
        assert after.columns == docs.columns
        ids.append({r.doc_id for r in after.select("doc_id").collect()})
        docs = after
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False)) and ids[-1]
    assert not ids[0] & {10_000, 10_001, 10_002, 10_003}
    assert not ids[1] & {10_004, 10_005, 10_006}
    assert 10_007 not in ids[2] and ids[3] == ids[2]
    got = corpus_pipeline.run(spark, small)
    assert {r.doc_id for r in got.select("doc_id").collect()} == ids[-1]
