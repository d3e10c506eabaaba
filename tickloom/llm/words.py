"""Words of whole Arrow batches of texts by numpy: places, hashes and hashes of word windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts of one step: so many bytes together, or one longer text.
STEP_BYTES = 1 << 19

_U = np.uint64


def _table(pattern_bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(pattern_bytes)] = True
    return table


#: Bytes of words ``[^\x20\x09-\x0D]+``.
GRAPHIC = ~_table([0x20, *range(0x09, 0x0E)])
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = _table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASES = (_U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base and of its inverse modulo 2**64."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        base = _BASES[which]
        inverse = _U(pow(int(base), -1, 1 << 64))
        size = max(n, STEP_BYTES + 2)
        have = tuple(
            np.concatenate([np.ones(1, _U), np.cumprod(np.full(size - 1, b, _U), dtype=_U)])
            for b in (base, inverse)
        )
        if size == STEP_BYTES + 2:  # one very long text must not keep its tables
            _POWERS[which] = have
    return have


def prefix_sums(codes: np.ndarray, which: int) -> np.ndarray:
    """Sums whose differences, times an inverse power, are hashes of any range of ``codes``."""
    n = len(codes)
    out = np.zeros(n + 1, _U)
    np.cumsum(codes * powers(which, n)[0][:n], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    inverse = powers(which, len(sums))[1]
    return mix((sums[end] - sums[start]) * inverse[start])


def range_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of many short byte ranges, eight bytes at a time; long ones one by one."""
    length = end - start
    out = mix(length.astype(_U) + _U(0x9E3779B97F4A7C15))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    for i in np.flatnonzero(length > 64):
        digest = hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    todo = np.flatnonzero((length > 0) & (length <= 64))
    for k in range(0, 64, 8):
        todo = todo[length[todo] > k] if k else todo
        if not len(todo):
            break
        have = np.minimum(length[todo] - k, 8).astype(_U)
        value = eight[start[todo] + k] & (_U(0xFFFFFFFFFFFFFFFF) >> (_U(64) - _U(8) * have))
        out[todo] = mix(out[todo] * _U(0x9FB21C651E98DF25) ^ value)
    return out


class Texts:
    """Bytes of some texts: ``data`` together, text i at ``offsets[i]:offsets[i + 1]``."""

    def __init__(self, array: pa.Array):
        array = pc.fill_null(array.cast(pa.large_binary()), b"")
        _, offsets, data = array.buffers()
        self.n = len(array)
        self.offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + self.n + 1]
        low, high = int(self.offsets[0]), int(self.offsets[-1])
        self.offsets = self.offsets - low
        self.data = np.frombuffer(data, np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)


class Words:
    """Words of some texts.

    ``start`` and ``end`` are places in ``data``; words ``first[i]:first[i + 1]`` are those of text
    i; ``hash`` has 64 bits of each. ``lower`` lower-cases A-Z first.
    """

    def __init__(self, texts: Texts, inside: np.ndarray, lower: bool = False):
        self.texts = texts
        self.data = _LOWER[texts.data] if lower else texts.data
        n = len(self.data)
        word = np.zeros(n + 1, bool)
        word[:n] = inside[self.data]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        ends = word[:-1] & ~word[1:]
        cuts = texts.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        begins[cuts] = word[cuts]
        ends[cuts - 1] = word[cuts - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, texts.offsets)
        self.counts = np.diff(self.first)

    @property
    def hash(self) -> np.ndarray:
        if not hasattr(self, "_hash"):
            self._hash = range_codes(self.data, self.start, self.end)
        return self._hash

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.texts.n), self.counts)

    def windows(self, size: int) -> np.ndarray:
        """Numbers of the words at which a window of ``size`` words of one text starts."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.start))
        return np.flatnonzero(left >= size)

    def window_hashes(self, at: np.ndarray, size: int, which: int = 1) -> np.ndarray:
        sums = prefix_sums(mix(self.hash + _U(which)), which)
        return range_hashes(sums, at, at + size, which)


def steps(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each part stay within STEP_BYTES, or are one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            before = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, before + STEP_BYTES, side="right")))
            yield batch.slice(low, high - low)
            low = high


def strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Texts from their bytes together and the place where each ends."""
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.string())


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks of the places that some range ``starts[i]:ends[i]`` covers."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, starts, 1)
    np.subtract.at(change, ends, 1)
    return np.cumsum(change[:-1]) > 0
