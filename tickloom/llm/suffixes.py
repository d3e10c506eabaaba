"""Suffix arrays of many short texts at once, by grouping suffixes under their Lyndon prefixes.

The first phase groups suffixes by their longest Lyndon prefix. Groups are taken in descending
order; each suffix of the group looks for the nearest suffix before it in a lower group, along
pointers already set, and the suffixes found move into new groups right above their old ones. The
second phase reads the order off: every suffix placed puts the one before it, and those it points
to, at the next free place of their groups. Nothing is renamed and no text is solved recursively.

Each step takes one group of every text, so its cost is shared by all of them.
"""

from __future__ import annotations

import numpy as np


def suffix_arrays(symbols: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Sorted suffixes of every text; text b is ``symbols[base[b]:base[b + 1]]``.

    Each text must end with a symbol that is smaller than all its others. The result holds places
    in ``symbols``, those of text b at ``base[b]:base[b + 1]``.
    """
    link, prev = _lyndon_groups(symbols, base)
    return _emit(link, prev, base)


def _lyndon_groups(symbols: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each suffix: the first place of its group in the order, and the nearest suffix before it
    in a lower group (before the text's start: none)."""
    n, texts = len(symbols), len(base) - 1
    sizes = np.diff(base)
    owner = np.repeat(np.arange(texts), sizes)
    first_of = base[:-1][owner]
    order = np.lexsort((symbols, owner))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    fresh = np.ones(n, bool)
    fresh[1:] = (owner[order][1:] != owner[order][:-1]) | (symbols[order][1:] != symbols[order][:-1])
    starts = np.flatnonzero(fresh)
    size = np.zeros(n, np.int64)
    size[starts] = np.diff(np.append(starts, n))
    link = np.empty(n, np.int64)
    link[order] = np.repeat(starts, size[starts])
    prev = np.arange(n) - 1
    moving = np.zeros(n, bool)
    end = base[1:].copy()
    active = np.flatnonzero(sizes > 1)
    while len(active):
        low = link[order[end[active] - 1]]
        many = end[active] - low
        members = order[_ranges(low, many)]
        group = np.repeat(low, many)
        # the nearest suffix before each member in a lower group
        todo = np.arange(len(members))
        at = prev[members]
        while len(todo):
            p = at[todo]
            higher = p >= first_of[members[todo]]
            higher[higher] = link[p[higher]] >= group[todo[higher]]
            todo = todo[higher]
            at[todo] = prev[at[todo]]
            prev[members[todo]] = at[todo]
        found = at[at >= first_of[members]]
        found, times = np.unique(found, return_counts=True)
        if len(found):
            _move(found, times, link, size, order, place, moving)
        end[active] = low
        active = active[low > base[active]]
    return link, prev


def _move(found, times, link, size, order, place, moving) -> None:
    """Takes suffixes out of their groups into new ones right above, fewer ``times`` below more."""
    old = link[found]
    by = np.lexsort((times, old))
    found, times, old = found[by], times[by], old[by]
    first = np.ones(len(old), bool)
    first[1:] = old[1:] != old[:-1]
    heads = np.flatnonzero(first)
    count = np.diff(np.append(heads, len(old)))
    groups = old[heads]
    tail = groups + size[groups] - count
    target = np.repeat(tail, count) + np.arange(len(old)) - np.repeat(heads, count)
    # what stands in the tail and stays goes where the movers come from
    moving[found] = True
    there = order[target]
    staying = there[~moving[there]]
    vacated = place[found][place[found] < np.repeat(tail, count)]
    order[vacated] = staying
    place[staying] = vacated
    moving[found] = False
    order[target] = found
    place[found] = target
    size[groups] -= count
    fresh = first.copy()
    fresh[1:] |= times[1:] != times[:-1]
    begin = np.flatnonzero(fresh)
    width = np.diff(np.append(begin, len(old)))
    size[target[begin]] = width
    link[found] = np.repeat(target[begin], width)


def _emit(link: np.ndarray, prev: np.ndarray, base: np.ndarray) -> np.ndarray:
    """The order of all suffixes from their groups, read in ascending order."""
    n = len(link)
    out = np.full(n, -1, np.int64)
    free = np.arange(n)
    done = np.zeros(n, bool)
    last = base[1:] - 1
    out[base[:-1]] = last
    done[last] = True
    sizes = np.diff(base)
    lanes = np.argsort(-sizes, kind="stable")
    ordered = -sizes[lanes]
    for step in range(int(sizes.max(initial=0))):
        live = lanes[: np.searchsorted(ordered, -step, side="left")]  # texts longer than step
        at = out[base[live] + step] - 1
        low = base[live]
        while True:
            keep = at >= low
            keep[keep] = ~done[at[keep]]
            at, low = at[keep], low[keep]
            if not len(at):
                break
            group = link[at]
            out[free[group]] = at
            free[group] += 1
            done[at] = True
            at = prev[at]
    return out


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of several ranges one after the other."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)
