"""N-gram Jaccard join by vertical partitioning.

Shingles have one global order, that of their hashes. The order is cut into fragments, and with it
every document's set into segments. Two sets with a Jaccard similarity of t or more differ in few
shingles, so with more fragments than that at least one segment is the same in both: documents
meet only where a whole segment is equal. For each pair that meets, overlaps are counted fragment
by fragment, one row each, and Spark sums the rows of a pair.

Sets that are similar have more than one segment in common: of the f segments of a set that are not
empty, all but the d that the shingles of one set alone can spoil. With the segments of every set
in one order, the least common one is thus among the first f - (f - d) + 1 of both. That order
is by the number of documents that have a segment, so documents meet under their rarest ones, and
those with few segments of others, such as phrases that many texts have, do not meet at all.

Every set also has the parities of its sizes in 1,024 fine fragments. Where these differ, the sets
differ in a shingle of that fragment, so the number of such fragments is at most the number of
shingles that only one of them has: pairs with too many are no links, and their texts stay put.

A segment shared by very many documents makes no pairs among them all: each document is paired
with the smallest one that has the segment, and only documents that this leaves in different
components are paired further: these by what sets them apart from the smallest one. Near copies
differ from it in few shingles, and two of them that do not both link with it are similar only if
they share many of these differences, so few pairs of even a very large group come into question.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.bits import bitmap, bits_for, holds
from tickloom.llm.graph import components
from tickloom.llm.store import keyed, stored
from tickloom.llm.words import GRAPHIC, Texts, Words, mix, steps

_U = np.uint64
#: Sizes of one level of fragments grow up to this factor.
_RATIO = 1.5
#: Fragments whose overlaps are counted separately for a pair, as a power of two.
_COUNTED_BITS = 4
#: Fine fragments whose parities a set carries, as a power of two.
_PARITY_BITS = 10
#: Cells in which shingles are counted for their rarity, as a power of two.
_COUNT_BITS = 20


def _order(owner: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places in order of owner, then code; owners of a step are few, so the second sort is by digits."""
    order = np.argsort(codes)
    own = owner[order]
    return order[np.argsort(own.astype(np.uint16) if len(own) and own.max() < 1 << 16 else own, kind="stable")]


def _sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray, Words]:
    """(owner, hash) of the distinct shingles of each text, in order of both."""
    words = Words(texts, GRAPHIC, lower=True)
    at = words.windows(size)
    owner, codes = words.owner()[at], words.window_hashes(at, size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    for length in range(1, size):
        own = short[words.counts[short] == length]
        owner = np.concatenate([owner, own])
        codes = np.concatenate([codes, words.window_hashes(words.first[own], length)])
    order = _order(owner, codes)
    owner, codes = owner[order], codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (codes[1:] != codes[:-1])
    return owner[new], codes[new], words


class _Levels:
    """Fragments for sets of each size: all sets up to ``top[level]`` share a cut."""

    def __init__(self, num: int, den: int, largest: int):
        self.num, self.den = num, den
        top, cuts = [1], [1]
        while top[-1] < largest * den // num + 1:
            bottom = top[-1] + 1
            size = max(bottom, int(bottom * _RATIO))
            differ = (den - num) * 2 * size // (den + num)
            slack = 4
            for _ in range(8):  # room for segments that are empty in a small set of the level
                k = differ + 1 + slack
                empty = k * float(np.exp(-bottom * num / den / k))
                slack = ceil(empty + 6 * sqrt(empty) + 4)
            top.append(size)
            cuts.append(differ + 1 + slack)
        self.top = np.array(top)
        self.cuts = np.array(cuts)
        self.slack = self.cuts - 1 - (den - num) * 2 * self.top // (den + num)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.top, sizes)


def _segments(
    owner: np.ndarray, codes: np.ndarray, n: int, levels: _Levels
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, hash, upper, need) of the segments under which each set may meet a similar, different one:
    whether they are cut for larger sets than its own, and how many of those of this cut it has in
    common with any similar set at least."""
    sizes = np.bincount(owner, minlength=n)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    partner = sizes * levels.den // levels.num
    alone = (partner == sizes) & ((levels.den - levels.num) * 2 * sizes // (levels.den + levels.num) < 2)
    own, upper = levels.of(sizes), levels.of(partner)
    value = mix(codes)
    owners, hashes, uppers, needs = [], [], [], []
    for level, keep in ((own, ~alone & (sizes > 0)), (upper, ~alone & (sizes > 0) & (upper > own))):
        chosen = keep[owner]
        o, c, v = owner[chosen], codes[chosen], value[chosen]
        if not len(o):
            continue
        k = levels.cuts[level].astype(_U)
        fragment = ((c >> _U(32)) * k[o]) >> _U(32)
        starts = np.ones(len(o), bool)
        starts[1:] = (o[1:] != o[:-1]) | (fragment[1:] != fragment[:-1])
        starts = np.flatnonzero(starts)
        o, fragment = o[starts], fragment[starts]
        place = mix((level[o].astype(_U) << _U(40)) | fragment)
        owners.append(o)
        hashes.append(mix(np.add.reduceat(v, starts) ^ place))
        # a set with more empty segments than the slack allows for also meets others in those
        filled = np.bincount(o, minlength=n)
        # the shingles that one of two similar sets of this level has alone spoil a segment each
        spoilt = (levels.den - levels.num) * (sizes + np.minimum(levels.top[level], partner)) // (levels.den + levels.num)
        need = np.maximum(1, filled - spoilt)
        mark = len(owners)
        for d in np.flatnonzero(keep & (levels.cuts[level] - filled > levels.slack[level])):
            present = fragment[o == d].astype(np.int64)
            empty = np.setdiff1d(np.arange(levels.cuts[level[d]]), present).astype(_U)
            owners.append(np.full(len(empty), d))
            hashes.append(mix(mix((_U(level[d]) << _U(40)) | empty) ^ _U(0x5E67E47)))
        for of in owners[mark - 1 :]:
            uppers.append(np.full(len(of), level is upper))
            needs.append(need[of])
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, bool), np.zeros(0, np.int64)
    return tuple(map(np.concatenate, (owners, hashes, uppers, needs)))


def _totals(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 of the values of each owner, which come in order."""
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    bounds = np.searchsorted(owner, np.arange(n + 1))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _parities(owner: np.ndarray, codes: np.ndarray, n: int) -> pa.Array:
    """A list of longs for each set, whose bits tell which fragments hold an odd number of its shingles."""
    at = (owner << _PARITY_BITS) + (codes >> _U(64 - _PARITY_BITS)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
    odd = np.diff(np.append(starts, len(at))) % 2 == 1
    marks = np.zeros(n << _PARITY_BITS, bool)
    marks[at[starts[odd]]] = True
    longs = np.packbits(marks).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * ((1 << _PARITY_BITS) // 64)), pa.array(longs))


def _summaries(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            owner, codes, _ = _sets(Texts(batch["text"]), size)
            n = batch.num_rows
            sums = [_totals(owner, mix(codes + _U(salt)), n).view(np.int64) for salt in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    batch["id"],
                    pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                    *map(pa.array, sums),
                    _parities(owner, codes, n),
                ],
                ["key", "id", "n", "s1", "s2", "parities"],
            )

    return run


def _segment_rows(size: int, levels: _Levels, known=None, bits: int = 0):
    """(segment, key) rows; with a bitmap, also ``upper`` and ``need``, and only those whose segment may be
    known, without one at most two of a segment and step, those with its smallest and largest key,
    which tell as much about whether it is shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            owner, codes, _ = _sets(Texts(batch["text"]), size)
            owner, segment, upper, need = _segments(owner, codes, batch.num_rows, levels)
            if known is not None:
                near = holds(known.value, segment >> _U(64 - bits))
                owner, segment, upper, need = owner[near], segment[near], upper[near], need[near]
            key = batch["key"].to_numpy()[owner]
            if known is None:
                order = np.argsort(segment)
                segment, key = segment[order], key[order]
                begin = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])[: len(segment)])
                many = np.diff(np.append(begin, len(segment))) > 1
                segment = segment[begin]
                segment = np.concatenate([segment, segment[many]])
                if len(begin):
                    key = np.concatenate([np.minimum.reduceat(key, begin), np.maximum.reduceat(key, begin)[many]])
            columns = [segment.view(np.int64), key] if known is None else [segment.view(np.int64), key, upper, need.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["segment", "key", "upper", "need"][: len(columns)])
        # workers live on after their task: what they no longer need goes back
        pa.default_memory_pool().release_unused()

    return run


def _differences(size: int, num: int, den: int):
    """(key, hub, n, x, m, d, apart, tokens): sizes of a set and its hub's set, the number of
    shingles that only one of them has, whether they do not link, and, unless there are more than
    the hub has itself, these shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for half in steps(iter([whole]), "ta"):
                for batch in steps(iter([half]), "tb"):
                    rows = batch.num_rows
                    sides = [_sets(Texts(batch[c]), size)[:2] for c in ("ta", "tb")]
                    owner = np.concatenate([s[0] for s in sides])
                    codes = np.concatenate([s[1] for s in sides])
                    order = _order(owner, codes)
                    owner, codes = owner[order], codes[order]
                    alone = np.ones(len(owner), bool)
                    same = (owner[1:] == owner[:-1]) & (codes[1:] == codes[:-1])
                    alone[1:] &= ~same
                    alone[:-1] &= ~same
                    owner, codes = owner[alone], codes[alone]
                    n, m = (np.bincount(s[0], minlength=rows) for s in sides)
                    d = np.bincount(owner, minlength=rows)
                    apart = den * (n + m - d) < num * (n + m + d)
                    codes = codes[(d <= m)[owner]]
                    offsets = np.concatenate([[0], np.cumsum(np.where(d <= m, d, 0))]).astype(np.int32)
                    tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.view(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [batch["key"], batch["hub"], batch["n"], batch["x"], pa.array(m), pa.array(d), pa.array(apart), tokens],
                        ["key", "hub", "n", "x", "m", "d", "apart", "tokens"],
                    )

    return run


def _rarest_differences(num: int, den: int, counts):
    """(token, key, n, x, d, place, short, apart): the rarest differences from a hub.

    With c = (den - num) / (den + num), sets A and B link if at most c (n_A + n_B) shingles are in
    one of them only, so they share at least (d_A + d_B - c (n_A + n_B)) / 2 differences. If B does
    not link with the hub, d_B > c (n_B + m), and if A does not, d_A > c (n_A + m); in any case d_B
    is at least what n_B and m differ by. That leaves at least (d_A + c (m - n_A)) / 2 for a set
    whose partner does not link with the hub (``short``), and (d_A - c (n_A + m)) / 2 for one that
    itself does not, whatever its partner. Of two sets in different components one does not.
    """
    wide, gap = den + num, den - num

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, d, hub = (batch[c].to_numpy() for c in ("n", "m", "d", "hub"))
            apart = batch["apart"].to_numpy(zero_copy_only=False)
            lists = batch["tokens"]
            sizes = lists.value_lengths().to_numpy()
            codes = lists.flatten().to_numpy().view(_U)
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            order = np.lexsort((codes, counts.value[codes >> _U(64 - _COUNT_BITS)], owner))
            codes = codes[order]
            place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            few = d - np.maximum(1, -(-(d * wide + gap * (m - n)) // (2 * wide))) + 1
            long = d - np.maximum(1, -(-(d * wide - gap * (n + m)) // (2 * wide))) + 1
            short = place < few[owner]
            taken = np.flatnonzero(short | (apart[owner] & (place < long[owner])))
            own = owner[taken]
            token = mix(codes[taken] ^ mix(hub[own].view(_U)))
            rows = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(token.view(np.int64)),
                    *(batch[c].take(rows) for c in ("key", "n", "x", "d")),
                    pa.array(place[taken]),
                    pa.array(short[taken]),
                    batch["apart"].take(rows),
                ],
                ["token", "key", "n", "x", "d", "place", "short", "apart"],
            )

    return run


def _cell_counts(size: int | None = None):
    """(cell, n): how many sets have a shingle in each of a fixed number of cells; sets of texts,
    or without a size the given ``tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _COUNT_BITS, np.int64)
        for batch in steps(batches) if size else batches:
            codes = _sets(Texts(batch["text"]), size)[1] if size else batch["tokens"].flatten().to_numpy().view(_U)
            total += np.bincount(codes >> _U(64 - _COUNT_BITS), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["cell", "n"])

    return run


def _counted(sets: DataFrame, size: int | None = None):
    """The counts of all cells, a broadcast of fixed size."""
    total = np.zeros(1 << _COUNT_BITS, np.int64)
    cells = sets.mapInArrow(_cell_counts(size), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return sets.sparkSession.sparkContext.broadcast(total)


def _rarest(size: int, num: int, den: int, counts):
    """(token, key, n, x, place): the shingles of each set of which a similar set must have one.

    Shingles are taken in order of the count of their cell, then of their hash: one order for all
    sets, whatever the counts, so two sets that are similar meet in the first ones of both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            owner, codes, _ = _sets(Texts(batch["text"]), size)
            rarity = counts.value[codes >> _U(64 - _COUNT_BITS)]
            order = np.lexsort((codes, rarity, owner))
            owner, codes = owner[order], codes[order]
            n = np.bincount(owner, minlength=batch.num_rows)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            taken = place < (n - -(-n * num // den) + 1)[owner]
            owner = pa.array(owner[taken])
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[taken].view(np.int64)), *(batch[c].take(owner) for c in ("key", "n", "x")), pa.array(place[taken])],
                ["token", "key", "n", "x", "place"],
            )

    return run


def _held_keys(known):
    """The rows whose key may be a known one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch["cell"].to_numpy().astype(_U)
            yield batch.select(["key", "text"]).filter(pa.array(holds(known.value, cell)))

    return run


def _partial_overlaps(size: int):
    """(a, b, fragment, common, total) of the texts ``ta`` and ``tb``: one row per pair and fragment that
    holds a shingle of either, with the shingles that both have there and the sum of both sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for half in steps(iter([whole]), "ta"):
                for batch in steps(iter([half]), "tb"):
                    cells = batch.num_rows << _COUNTED_BITS
                    sides = [_sets(Texts(batch[c]), size)[:2] for c in ("ta", "tb")]
                    owner = np.concatenate([s[0] for s in sides])
                    codes = np.concatenate([s[1] for s in sides])
                    order = _order(owner, codes)
                    owner, codes = owner[order], codes[order]
                    cell = (owner << _COUNTED_BITS) + (codes >> _U(64 - _COUNTED_BITS)).astype(np.int64)
                    both = np.flatnonzero((owner[1:] == owner[:-1]) & (codes[1:] == codes[:-1]))
                    common = np.bincount(cell[both], minlength=cells)
                    total = np.bincount(cell, minlength=cells)
                    seen = np.flatnonzero(total)
                    pair = pa.array(seen >> _COUNTED_BITS)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["a"].take(pair),
                            batch["b"].take(pair),
                            pa.array((seen & ((1 << _COUNTED_BITS) - 1)).astype(np.int32)),
                            pa.array(common[seen]),
                            pa.array(total[seen]),
                        ],
                        ["a", "b", "fragment", "common", "total"],
                    )

    return run


def linked(partial: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link, from their partial overlaps (a, b, fragment, common, total)."""
    sums = partial.groupBy("a", "b").agg(F.sum("common").alias("common"), F.sum("total").alias("total"))
    return sums.filter(F.col("common") * den >= (F.col("total") - F.col("common")) * num).select("a", "b")


def _odd_fragments(left: str, right: str) -> Column:
    """The number of fragments whose parities differ: never more than the shingles that one set alone has."""
    return F.aggregate(F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def jaccard_components(
    docs: DataFrame,
    size: int = 5,
    similarity: tuple[int, int] = (8, 10),
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 1,
) -> DataFrame:
    """One row per document: ``key, id, n_shingles, component, component_id``.

    Pairs meet with their texts in up to ``rounds`` parts, of more than an eighth as many pairs as
    there are documents: more parts read the texts more often and hold fewer of them on disk at a time.

    Words are runs without white space after lower-casing A-Z; a set has the distinct shingles of
    ``size`` words, or the whole sequence where there are fewer. Documents link when the overlap
    is at least ``similarity`` (numerator, denominator) of the union. ``component`` is the
    smallest key that links reach, ``component_id`` its id. Null and empty texts link with
    nothing. Where ids repeat or are null, rows are told apart by id and text (see ``keyed``).
    """
    spark = docs.sparkSession
    num, den = similarity
    base = keyed(docs, id_col, text_col)
    small = stored(
        base.mapInArrow(_summaries(size), "key long, id long, n long, s1 long, s2 long, parities array<long>"), "sets"
    )
    # sets equal in size and in both sums of hashes are one class; its smallest key stands for it
    classes = small.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("key").alias("rep"))
    members = stored(
        small.join(classes, ["n", "s1", "s2"], "left").select("key", "id", "n", F.coalesce("rep", "key").alias("rep")),
        "members",
    )
    largest, total = members.agg(F.max("n"), F.count("*")).first()
    levels = _Levels(num, den, largest or 1)
    texts = base.select("key", "text")
    # most segments are met once: combining them again before the shuffle would only take memory
    rows = texts.mapInArrow(_segment_rows(size, levels), "segment long, key long").repartition("segment")
    shared = stored(rows.groupBy("segment").agg(F.count("*").alias("many")).filter("many > 1"), "segments")
    bits = bits_for(shared.count())
    known = spark.sparkContext.broadcast(bitmap(shared.select(F.shiftrightunsigned("segment", 64 - bits).alias("cell")), bits))
    again = texts.mapInArrow(_segment_rows(size, levels, known, bits), "segment long, key long, upper boolean, need int")
    reps = members.filter("key = rep").select("key", "n")
    # each representative under the rarest of its shared segments, and the segment's smallest representative
    held = again.join(shared, "segment").join(reps, "key")
    of = Window.partitionBy("key", "upper")
    held = held.withColumn("place", F.row_number().over(of.orderBy("many", "segment"))).withColumn("all", F.count("*").over(of))
    held = stored(held.filter("place <= all - need + 1").select("segment", "key", "n"), "held")
    known.destroy()
    hubs = held.groupBy("segment").agg(F.min("key").alias("hub"), F.max("key").alias("last")).filter("hub < last").drop("last")
    held = stored(held.join(hubs, "segment"), "meetings")

    def with_parities(pairs: DataFrame, left: str, right: str) -> DataFrame:
        """``pairs`` with ``m``, the size of the right set, and ``odd``, the least by which both differ."""
        own = small.select(F.col("key").alias(left), F.col("parities").alias("p"))
        other = small.select(F.col("key").alias(right), F.col("n").alias("m"), F.col("parities").alias("q"))
        return pairs.join(own, left).join(other, right).withColumn("odd", _odd_fragments("p", "q")).drop("p", "q")

    def texts_of(keys: DataFrame):
        """Texts of the keys in column ``key``, those of other documents, but for few, left out, and the
        broadcast to destroy after use. The keys are counted, so few of them make a small bitmap."""
        bits = bits_for(keys.count())
        cell = F.shiftrightunsigned(F.xxhash64("key"), 64 - bits)
        wanted = spark.sparkContext.broadcast(bitmap(keys.select(cell.alias("cell")), bits))
        return texts.withColumn("cell", cell).mapInArrow(_held_keys(wanted), "key long, text string"), wanted

    def with_texts(pairs: DataFrame, left: str, right: str, work, name: str) -> DataFrame:
        """``work`` on ``pairs`` with both texts as ``ta`` and ``tb``, in rounds: the shuffles of a round,
        in which texts move, are gone before the next one."""
        parts, needed = [], min(rounds, 1 + 8 * pairs.count() // (total + 1)) if rounds > 1 else 1
        for i in range(needed):
            some = pairs.filter(F.pmod(F.xxhash64(right), F.lit(needed)) == i)
            held, wanted = texts_of(some.select(F.explode(F.array(left, right)).alias("key")))
            ta = held.select(F.col("key").alias(left), F.col("text").alias("ta"))
            tb = held.select(F.col("key").alias(right), F.col("text").alias("tb"))
            parts.append(stored(work(some.join(ta, left).join(tb, right)), name))
            wanted.destroy()
        out = parts[0]
        for part in parts[1:]:
            out = out.union(part)
        return out

    def verify(pairs: DataFrame) -> DataFrame:
        """The links among pairs (a, b, n) of representatives; n is the size of a."""
        fit = with_parities(pairs, "a", "b").filter(
            f"least(n, m) * {den} >= greatest(n, m) * {num} and odd * {den + num} <= (n + m) * {den - num}"
        )
        fit = stored(fit.select("a", "b"), "fit")

        def links_of(rows: DataFrame) -> DataFrame:
            partial = rows.select("a", "b", "ta", "tb").mapInArrow(
                _partial_overlaps(size), "a long, b long, fragment int, common long, total long"
            )
            return linked(partial, num, den)

        return with_texts(fit, "a", "b", links_of, "links")

    def labelled(frame: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
        own = labels.select(F.col("node").alias(column), F.col("label").alias("_label"))
        return frame.join(own, column, "left").withColumn(out, F.coalesce("_label", column)).drop("_label")

    # every representative with the smallest hub it meets
    first = held.filter("key != hub").groupBy(F.col("key").alias("a"), "n").agg(F.min("hub").alias("b"))
    first = stored(first.select("a", "b", "n"), "pairs")
    links = verify(first)
    labels = components(links)
    # with every other hub from which links do not lead to it yet
    met = labelled(labelled(held.select("key", "n", "hub").filter("key != hub").distinct(), labels, "key", "x"), labels, "hub", "y")
    second = stored(
        met.filter("x != y").select(F.col("key").alias("a"), F.col("hub").alias("b"), "n").join(first.select("a", "b"), ["a", "b"], "left_anti"),
        "pairs",
    )
    links = links.union(verify(second))
    labels = components(links)
    # and those still under one segment with another component by their differences from its hub
    split = labelled(held, labels, "key", "x")
    mixed = split.groupBy("segment").agg(F.min("x").alias("low"), F.max("x").alias("high")).filter("low < high").select("segment")
    met = stored(
        with_parities(split.join(mixed, "segment").filter("key != hub").select("key", "hub", "n", "x").distinct(), "key", "hub"), "met"
    )

    def differing(rows: DataFrame) -> DataFrame:
        return rows.select("key", "hub", "n", "x", "ta", "tb").mapInArrow(
            _differences(size, num, den), "key long, hub long, n long, x long, m long, d long, apart boolean, tokens array<long>"
        )

    # where parities tell that more differs than the hub has, the differences themselves do not matter
    differ = with_texts(met.filter("odd <= m").select("key", "hub", "n", "x"), "key", "hub", differing, "differences")

    def crossing(tokens: DataFrame) -> DataFrame:
        """The tokens that sets of different components have."""
        of = tokens.groupBy("token").agg(F.min("x").alias("low"), F.max("x").alias("high")).filter("low < high").select("token")
        return stored(tokens.join(of, "token"), "tokens")

    close = differ.filter("d <= m")
    counts = _counted(close.select("tokens"))
    tokens = crossing(
        close.mapInArrow(
            _rarest_differences(num, den, counts),
            "token long, key long, n long, x long, d long, place long, short boolean, apart boolean",
        )
    )
    counts.destroy()
    left = tokens.filter("short").select("token", *(F.col(c).alias(f"{c}_a") for c in ("key", "n", "x", "d", "place")))
    right = tokens.filter("apart").select("token", *(F.col(c).alias(f"{c}_b") for c in ("key", "n", "x", "d", "place")))
    wide, gap = den + num, den - num
    # at the first difference that both have, enough others must follow
    enough = f"2 * {wide} * least(d_a - place_a, d_b - place_b) >= {wide} * (d_a + d_b) - {gap} * (n_a + n_b)"
    third = left.join(right, "token").filter(f"key_a != key_b and x_a != x_b and {enough}").select(
        F.greatest("key_a", "key_b").alias("a"), F.least("key_a", "key_b").alias("b"), F.expr("if(key_a > key_b, n_a, n_b)").alias("n")
    )
    # sets that have little in common with the hub, or may be similar to such: with all that share
    # one of their rarest shingles, as two sets with this similarity must
    distant = differ.filter(f"d + {gap} * (n + n * {den} / {num}) / {wide} + 1 >= m").select("key", "n", "x")
    distant = distant.union(met.filter("odd > m").select("key", "n", "x")).distinct()
    distant = stored(distant, "distant")
    held, wanted = texts_of(distant)
    own = stored(distant.join(held, "key"), "distant_texts")
    wanted.destroy()
    counts = _counted(own.select("text"), size)
    tokens = crossing(own.mapInArrow(_rarest(size, num, den, counts), "token long, key long, n long, x long, place long"))
    counts.destroy()
    left = tokens.select("token", F.col("key").alias("a"), "n", F.col("x").alias("xa"), F.col("place").alias("pa"))
    right = tokens.select("token", F.col("key").alias("b"), F.col("x").alias("xb"), F.col("n").alias("nb"), F.col("place").alias("pb"))
    fourth = left.join(right, "token").filter(
        f"a > b and xa != xb and {wide} * least(n - pa, nb - pb) >= {num} * (n + nb)"
    )
    third = (
        third.union(fourth.select("a", "b", "n"))
        .distinct()
        .join(first.select("a", "b"), ["a", "b"], "left_anti")
        .join(second.select("a", "b"), ["a", "b"], "left_anti")
    )
    third = stored(third, "pairs")
    if not third.isEmpty():
        links = links.union(verify(third))
        labels = components(links)
    named = labelled(members.withColumnRenamed("rep", "node_rep"), labels, "node_rep", "component")
    ids = members.select(F.col("key").alias("component"), F.col("id").alias("component_id")).distinct()
    return named.join(ids, "component", "left").select(
        "key", "id", F.col("n").alias("n_shingles"), "component", "component_id"
    )


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Documents with their component under links of nine tenths on three-word shingles."""
    found = jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, (9, 10))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


SQL = r"""
with recursive w as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as ws from documents),
s as materialized (select distinct doc_id, array_to_string(ws[k:k + 2], ' ') as sh
    from w, unnest(range(1, greatest(1, len(ws) - 2) + 1)) as u(k) where len(ws) > 0),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as i from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
links as materialized (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 90 * (x.n + y.n - i)),
edges as materialized (select a, b from links union select b, a from links),
reach(a, b) as (select doc_id, doc_id from w union select r.a, e.b from reach r join edges e on r.b = e.a)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.component_id
from w left join n using (doc_id) join (select a as doc_id, min(b) as component_id from reach group by a) m using (doc_id)
"""
