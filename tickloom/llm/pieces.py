"""SentencePiece encoding that keeps the byte span of every piece in the source text, and decoding.

The normaliser reads the compiled character map of the model: at each place the longest prefix
with an entry is replaced, other characters pass unchanged, and the source offset of every byte
written is recorded. A piece covers a range of the normalised bytes; the offsets project it to the
bytes of the source.

Where the map is empty and no piece has a space after another character, merges never cross from a
word into the next one's space. Words are then encoded one by one, and each distinct word of a
task once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.words import steps

SPACE = "▁"
#: Distinct words whose pieces a task remembers.
_REMEMBERED = 300_000


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 prefixes and the texts it points to."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest prefix at ``at`` with an entry, 0 without one, and its text."""
        units, found, value = self.units, 0, 0
        if units:
            # a unit holds a label (8 bits), an offset, a shift flag (bit 9) and a leaf flag (bit 8)
            node = _offset(units[0])
            for k in range(at, len(source)):
                node ^= source[k]
                unit = units[node]
                if unit & 0x800000FF != source[k]:
                    break
                node ^= _offset(unit)
                if unit >> 8 & 1:
                    found, value = k + 1 - at, units[node] & 0x7FFFFFFF
        return found, self.texts[value : self.texts.index(b"\0", value)] if found else b""


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & (1 << 9)) >> 6)


class Encoder:
    """Encodes and decodes with a model, and projects pieces to the source."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        rules = spec.normalizer_spec
        if not rules.add_dummy_prefix or not rules.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that put an escaped space before a text are supported")
        if any(p.type == 4 for p in spec.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        self.trim = rules.remove_extra_whitespaces
        self.map = CharacterMap(rules.precompiled_charsmap)
        self.eos = self.lib.eos_id()
        self.width = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in spec.pieces], np.int64)
        self.by_word = not self.map.units and not self.trim and not any(SPACE in p.piece.lstrip(SPACE) for p in spec.pieces)
        self.probe = next(i for i, p in enumerate(spec.pieces) if p.type == 1 and p.piece.isascii())
        # pieces that stand for their own text or byte
        self.plain = frozenset(i for i, p in enumerate(spec.pieces) if p.type in (1, 6))
        self.space = self.lib.piece_to_id(SPACE)
        self.known: dict[str, tuple[list[int], str]] = {}

    def normalise(self, source: bytes) -> tuple[bytes, list[int]]:
        """The normalised bytes, and for each of them and the end, the source offset."""
        found, at = [], 0  # (text, source offset of each of its bytes, end in the source)
        while at < len(source):
            size, text = self.map.longest(source, at)
            offsets = [at] * len(text)
            if not size:
                lead = source[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                text, offsets = source[at : at + size], list(range(at, at + size))
            at += size
            found.append((text, offsets, at))
        if self.trim:
            while found and not found[0][0].strip(b" "):
                del found[0]
            while found and not found[-1][0].strip(b" "):
                del found[-1]
        if not found:
            return b"", [len(source)]
        mark = SPACE.encode()
        out, align = bytearray(mark), [found[0][1][0] if found[0][1] else 0] * 3
        for text, offsets, _ in found:
            for byte, offset in zip(text, offsets, strict=True):
                if byte != 0x20:
                    out.append(byte)
                    align.append(offset)
                elif not (self.trim and out.endswith(mark)):
                    out += mark
                    align += [offset] * 3
        end = found[-1][2]
        if self.trim:
            while out.endswith(mark):
                del out[-3:], align[-3:]
        return bytes(out), [*align, end]

    def words(self, text: str) -> list[tuple[list[int], str]]:
        """Pieces and decoded text of each word with the spaces before it."""
        found = _WORD.findall(SPACE + text) if text else []
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        new = [w for w in dict.fromkeys(found) if w not in known]
        if new:
            ids = self.lib.encode([w[1:] if w[0] in _SPACES else w for w in new], num_threads=1)
            ids = [x or [self.space] for x in ids]  # a lone space at the end of a text
            # without a map, plain pieces join to the word they came from; others are decoded
            back = [w.replace(SPACE, " ") for w in new]
            odd = [k for k, x in enumerate(ids) if not self.plain.issuperset(x)]
            if odd:
                cut = len(self.lib.decode([self.probe]))
                for k, text in zip(odd, self.lib.decode([[self.probe, *ids[k]] for k in odd], num_threads=1), strict=True):
                    back[k] = text[cut:]
            known.update(zip(new, zip(ids, back, strict=True), strict=True))
        return [known[w] for w in found]

    def encode(self, text: str) -> tuple[list[int], str]:
        """All ids with the end id, and the decoded text."""
        if not self.by_word:
            ids = self.lib.encode(text)
            return [*ids, self.eos], self.lib.decode(ids)
        words = self.words(text)
        return [*chain.from_iterable(w[0] for w in words), self.eos], "".join([w[1] for w in words])[1:]

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source bytes (start, end) of each id; the end id has none and stands at the end."""
        source = text.encode()
        if self.by_word:
            data = np.frombuffer(source, np.uint8)
            widths = np.where(data == 0x20, 3, 1)
            align = np.concatenate([np.zeros(3, np.int64), np.repeat(np.arange(len(data)), widths), [len(data)]])
        else:
            align = np.array(self.normalise(source)[1])
        ends = np.cumsum(self.width[ids[:-1]])
        if len(ends) and ends[-1] != len(align) - 1:
            raise ValueError("pieces and normalised text differ in length")
        starts = ends - self.width[ids[:-1]]
        return np.append(align[starts], len(source)), np.append(align[ends], len(source))


_SPACES = " " + SPACE
_WORD = re.compile(f"[{_SPACES}]+[^{_SPACES}]*|[^{_SPACES}]+")


def _rows(model, with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for batch in steps(batches):
            ids, decoded, starts, ends = [], [], [], []
            for text in batch["text"].to_pylist():
                own, back = encoder.encode(text or "")
                own = np.array(own, np.int32)
                ids.append(own)
                decoded.append(back)
                if with_spans:
                    start, end = encoder.spans(text or "", own)
                    starts.append(start.astype(np.int32))
                    ends.append(end.astype(np.int32))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(offsets, np.concatenate(x)) for x in (ids, *((starts, ends) if with_spans else ()))]
            names = ["ids", "starts", "ends"] if with_spans else ["ids"]
            yield pa.RecordBatch.from_arrays([batch["id"], *lists, pa.array(decoded, pa.string())], ["id", *names, "decoded"])

    return run


def encode(docs: DataFrame, model_path: str, with_spans: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, ids, starts, ends, decoded``.

    ``ids`` are those of the library with the end id; ``starts`` and ``ends`` the byte span of each
    in the UTF-8 text, left out without ``with_spans``; ``decoded`` is the library's decoding of
    the ids. Null and empty texts have the end id alone and decode to an empty text. Repeated rows
    are encoded each. The model, read on the driver, is broadcast (it is at most a few MB).
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    spans = "starts array<int>, ends array<int>, " if with_spans else ""
    return rows.mapInArrow(_rows(model, with_spans), f"id {kind}, ids array<int>, {spans}decoded string")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_sentencepiece(spark, sf_dir: str) -> DataFrame:
    found = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path())
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.size(F.filter("starts", lambda s: s >= 0)).cast("long").alias("n_spans"),
    )
