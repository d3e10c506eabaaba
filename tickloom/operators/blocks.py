"""Ordered operators that never hold a whole key in one task.

A plain ``Window.partitionBy(symbol)`` puts every row of a hot symbol into one task, and a window
without keys puts the whole table there. The helpers below cut the ordering column into blocks,
work inside each (key, block), and pass only one or two rows per block on to the next level.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 20

_COMBINE = {
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
}


class Earlier(NamedTuple):
    """The max, min or sum (``kind``) of ``value`` over all earlier rows with the same keys."""

    name: str
    kind: str
    value: str
    keys: tuple[str, ...] = ()


def even_cuts(df: DataFrame, order: str, *, rows: int = BLOCK, most: int = 10_000) -> list[float]:
    """Positions that cut the order into blocks of about ``rows`` rows, ``most`` cuts at most.

    For orders with gaps, such as ids made from a clock or a partition number before an offset:
    blocks of a fixed width would hold a row or two of them. The quantiles take one pass over the
    order column; the driver gets the cuts alone.
    """
    cuts = min(most, df.count() // rows)
    if not cuts:
        return []
    shares = [i / (cuts + 1) for i in range(1, cuts + 1)]
    return sorted(set(df.approxQuantile(order, shares, 1 / (4 * (cuts + 1)))))


def _in_blocks(df: DataFrame, order: str, block: int | list[float]) -> DataFrame:
    """``df`` with ``_block``, which never falls along the order: by width, or between cuts."""
    if isinstance(block, int):
        position = F.col(order)
        return df.withColumn("_block", position - F.pmod(position, F.lit(block).cast("long")))
    if not block:
        return df.withColumn("_block", F.lit(0).cast("long"))
    ends = [float("-inf"), *block, float("inf")]
    cut = Bucketizer(splits=ends, inputCol=order, outputCol="_block").transform(df)
    return cut.withColumn("_block", F.col("_block").cast("long"))


def with_earlier(
    df: DataFrame, *specs: Earlier, order: str, block: int | list[float] = BLOCK, levels: int = 1
) -> DataFrame:
    """Add a column per spec. ``order`` is a unique integer position, ``block`` the width of a
    block or the cuts between blocks (see ``even_cuts``).

    Rows are windowed per (block, keys). The totals of whole blocks, ``block`` times fewer, are
    accumulated on their own and joined back. One aggregate makes the totals of all specs, so the
    source is read twice, however many there are; their values have one type. Give specs with fewer
    keys first: their shuffle by block serves those that follow. Each further level puts the block
    totals through the same step again; with one level and the default block, a trillion positions
    leave the last window a million rows.
    """
    rows = blocked = _in_blocks(df, order, block)
    for spec in specs:
        inside = (
            Window.partitionBy("_block", *spec.keys)
            .orderBy(order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        rows = rows.withColumn(spec.name, _COMBINE[spec.kind][0](spec.value).over(inside))
    totals = _totals(blocked, specs)
    for i, spec in enumerate(specs):
        carry = f"_carry_{levels}_{i}"
        carried = _carried(totals.filter(F.col("_spec") == i), spec, carry, block, levels)
        rows = (
            rows.join(carried, ["_block", *spec.keys], "left")
            .withColumn(spec.name, _COMBINE[spec.kind][1](F.col(spec.name), F.col(carry)))
            .drop(carry)
        )
    return rows.drop("_block")


def _totals(blocked: DataFrame, specs: tuple[Earlier, ...]) -> DataFrame:
    """``_spec, _total`` per block and all keys that any spec has: one row for each spec.

    The rows of all specs come out of one generator with their keys, so every branch that takes
    those of one spec reads the same aggregate and Spark makes it once; a column per spec would be
    pruned apart, and a key outside would take the filters of its branch below the aggregate.
    """
    keys = list(dict.fromkeys(k for spec in specs for k in spec.keys))
    made = [_COMBINE[spec.kind][0](spec.value).alias(f"_total_{i}") for i, spec in enumerate(specs)]
    each = [
        F.struct(F.lit(i).alias("_spec"), F.col("_block"), *keys, F.col(f"_total_{i}").alias("_total"))
        for i in range(len(specs))
    ]
    return blocked.groupBy("_block", *keys).agg(*made).select(F.inline(F.array(*each)))


def _carried(totals: DataFrame, spec: Earlier, carry: str, block: int | list[float], levels: int) -> DataFrame:
    """Per (block, keys): the total of all earlier blocks."""
    aggregate = _COMBINE[spec.kind][0]
    totals = totals.groupBy("_block", *spec.keys).agg(aggregate("_total").alias("_total"))
    if levels > 1:
        inner = Earlier(carry, spec.kind, "_total", spec.keys)
        positions = totals.withColumnRenamed("_block", "_position")
        wider = block * block if isinstance(block, int) else BLOCK  # blocks between cuts are numbered
        carried = with_earlier(
            positions, inner, order="_position", block=wider, levels=levels - 1
        ).withColumnRenamed("_position", "_block")
    else:
        before = (
            Window.partitionBy(*spec.keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = totals.withColumn(carry, aggregate("_total").over(before))
    return carried.select("_block", *spec.keys, carry)


def with_neighbour(
    df: DataFrame,
    name: str,
    value: str,
    *,
    order: str,
    keys: tuple[str, ...],
    offset: int,
    block: int | list[float] = BLOCK,
) -> DataFrame:
    """Add ``name``: ``value`` of the next (offset 1) or previous (-1) row of the same keys.

    Inside a block this is ``lead`` or ``lag``. The first and last row of every block then meet
    in a second window per key, where the row that lacked a neighbour finds it. All other rows
    stay partitioned by block there.
    """
    neighbour = F.lead(value, offset) if offset > 0 else F.lag(value, -offset)
    blocked = _in_blocks(df, order, block)
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    first = F.lag(F.lit(1), 1).over(inside).isNull()
    last = F.lead(F.lit(1), 1).over(inside).isNull()
    marked = (
        blocked.withColumn(name, neighbour.over(inside))
        .withColumn("_first", first)
        .withColumn("_last", last)
    )
    edge = F.col("_first") | F.col("_last")
    spread = marked.withColumn("_part", F.when(~edge, F.col("_block")))
    across = Window.partitionBy(*keys, "_part").orderBy(order)
    open_side = F.col("_last") if offset > 0 else F.col("_first")
    return (
        spread.withColumn(
            name, F.when(open_side, neighbour.over(across)).otherwise(F.col(name))
        )
        .drop("_block", "_first", "_last", "_part")
    )
