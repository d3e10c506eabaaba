"""Bitmaps of hashes, of a fixed size, for dropping rows before a shuffle; exact joins follow."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap, as a power of two: 16 MB, whatever the data.
BITS = 27


def bits_for(n: int) -> int:
    """Bits, as a power of two, of a bitmap for ``n`` hashes: eight or more each, 2**30 at most.

    Beyond that, at 128 MB, more rows pass than need to; what is exact follows.
    """
    return min(max((8 * n).bit_length(), 10), 30)


def bitmap(cells: DataFrame, bits: int = BITS) -> np.ndarray:
    """Bytes of a bitmap in which the bits numbered by column ``cell`` are set.

    Bits are gathered into 64-bit words on the executors, so at most 2**bits / 64 rows arrive.
    """
    words = (
        cells.groupBy(F.shiftright("cell", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(cell & 63 as int)))").alias("set"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy()] = words["set"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


def holds(bitmap_bytes: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (bitmap_bytes[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0
