"""Every training-text query on null and repeated ids, repeated rows, clashing columns and a text of
several MB; and the encoder with a model that has a character map."""

import re
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR

from tickloom.llm import pieces
from tickloom.llm.suite import QUERIES

CLASHING = [
    "id", "key", "row", "row_number", "h", "g", "pos", "run", "marks", "kept", "n", "words", "_words", "_hits", "_set", "_id",
    "_before", "_range", "_place", "cell", "count", "score", "start", "code", "doc", "of", "others", "size", "bucket", "path",
]


@pytest.fixture(scope="module")
def folders():
    """The same documents twice: as they are, and with columns named as the operators name theirs."""
    docs = [r for r in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist() if len(r["text"] or "") < 3000][:30]
    long = " ".join(f"v{i * i % 99991}" for i in range(400_000))
    text = docs[3]["text"]
    odd = [(None, text), (None, text), (None, "another text"), (7, text), (7, text), (7, "tied id"), (8, None), (8, ""), (9_000, long)]
    docs += [{"doc_id": i, "text": t, "lang": None, "source": None, "n_chars": None} for i, t in odd]
    out = []
    for extra in ([], CLASHING):
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
        table = pa.Table.from_pylist([{c: d[c] for c in schema.names} for d in docs], schema)
        for c in extra:
            table = table.append_column(c, pa.array([None if i % 3 else f"{c}{i}" for i in range(len(docs))]))
        pq.write_table(table, f"{folder}/documents.parquet")
        pq.write_table(pq.read_table(f"{SF_DIR}/benchmark.parquet"), f"{folder}/benchmark.parquet")
        out.append(folder)
    return [*out, docs]


@pytest.mark.parametrize("name", QUERIES)
def test_rows_do_not_depend_on_other_columns(spark, folders, name):
    plain, clashing, docs = folders
    assert len(long := docs[-1]["text"]) > 2_000_000 and long
    found = [sorted(map(repr, QUERIES[name](spark, folder).collect())) for folder in (plain, clashing)]
    assert found[0] == found[1]
    if "doc_id" in QUERIES[name](spark, plain).columns and not name.startswith("op5"):
        assert len(found[0]) == len(docs)


TEXTS = [
    "ﬁne ①②  x", "Ａ Ｂ　Ｃ", "été été", "  two  spaces  ", "", " ", "plain words", "ｶﾞ ½ ­ a​b", "tab\tand\nline", "\U0001f600 ok ㍿",
]


@pytest.mark.parametrize("trim", [False, True])
def test_normalisation_and_spans_with_a_character_map(trim):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    rules = sentencepiece_model_pb2.ModelProto()
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    spec = sentencepiece_model_pb2.ModelProto()
    with open(pieces.model_path(), "rb") as file:
        spec.ParseFromString(file.read())
    spec.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    spec.normalizer_spec.remove_extra_whitespaces = trim
    model = spec.SerializeToString()
    encoder, lib = pieces.Encoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    assert encoder.map.units and not encoder.by_word
    for text in TEXTS:
        normal, align = encoder.normalise(text.encode())
        assert normal.decode() == lib.normalize(text), text
        assert len(align) == len(normal) + 1 and align == sorted(align)
        ids, decoded = encoder.encode(text)
        assert ids[:-1] == lib.encode(text) and decoded == lib.decode(ids[:-1])
        starts, ends = encoder.spans(text, pa.array(ids).to_numpy())
        # words that the map leaves alone have spans that read as the pieces do
        for i, a, b in zip(ids[:-1], starts, ends, strict=False):
            piece = lib.id_to_piece(i).replace(pieces.SPACE, " ").strip()
            source = text.encode()[a:b].decode(errors="replace").strip()
            if re.fullmatch("[a-z]+", piece) and source.isascii():
                assert source == piece, (text, piece, source)


def test_spans_join_to_the_text(spark):
    """Without a map the spans of a text follow each other and cover it."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in pieces.encode(docs, pieces.model_path()).collect():
        source = TEXTS[r.id].encode()
        assert b"".join(source[a:b] for a, b in zip(r.starts, r.ends, strict=True)) == source
        assert r.ends[-1] == r.starts[-1] == len(source)
