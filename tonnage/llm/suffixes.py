"""Suffix arrays by linear grouping, for many texts at once.

Suffixes are grouped by the longest Lyndon word known to start them.  Groups are processed in
descending order: each member points to the nearest earlier suffix of a lower group, and the suffixes
pointed to, sorted by how often they are, move into higher groups of their own, since their Lyndon
prefix is longer.  The groups that result are in order and each is put in order by one ascending
pass along the same pointers; names are never assigned anew.

The steps of one text depend on each other, those of different texts do not: numpy takes one group
of every text at a time.
"""

from __future__ import annotations

import numpy as np


def suffix_arrays(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The suffix array of each of ``texts`` (values of 1 and more; an end smaller than all is understood and left out)."""
    if not texts:
        return []
    lengths = np.array([len(t) + 1 for t in texts], np.int64)  # with the end
    first = np.cumsum(lengths + 1) - lengths  # a guard slot goes before every text
    last = first + lengths - 1
    total = int(last[-1]) + 1
    symbols = np.full(total, -1, np.int32)
    owner = np.zeros(total, np.int64)
    for k, text in enumerate(texts):
        symbols[first[k] : last[k]] = text
        symbols[last[k]] = 0
        owner[first[k] - 1 : last[k] + 1] = k
    group, size, prev, order = _group(symbols, owner, first, last)
    ranked = _emit(group, prev, first, last)
    return [ranked[a + 1 : z + 1] - a for a, z in zip(first.tolist(), last.tolist())]


def _group(symbols: np.ndarray, owner: np.ndarray, first: np.ndarray, last: np.ndarray):
    total = len(symbols)
    inside = np.flatnonzero(symbols >= 0)
    width = int(symbols.max()) + 1
    order = np.full(total, -1, np.int32)
    order[inside] = inside[np.argsort(owner[inside] * width + symbols[inside], kind="stable")]
    position = np.empty(total, np.int32)
    position[order[inside]] = inside
    key = owner[order[inside]] * width + symbols[order[inside]]
    opens = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    starts = inside[opens]
    size = np.zeros(total, np.int32)
    size[starts] = np.diff(np.concatenate((opens, [len(inside)])))
    group = np.full(total, -1, np.int32)
    group[order[inside]] = np.repeat(starts, size[starts])
    prev = np.arange(-1, total - 1, dtype=np.int32)
    marked = np.zeros(total, bool)
    current = group[order[last]]  # the highest group of every text
    while len(current):
        n = size[current]
        at = np.repeat(current, n)
        members = order[at + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
        # previous smaller: over suffixes of this group or a higher one
        rest, mine = members, at
        while len(rest):
            back = prev[rest]
            high = group[back] >= mine
            rest, mine = rest[high], mine[high]
            prev[rest] = prev[back[high]]
        targets, counts = np.unique(prev[members], return_counts=True)
        real = group[targets] >= 0
        targets, counts = targets[real], counts[real]
        if len(targets):
            old = group[targets]
            rank = np.lexsort((counts, old))
            targets, counts, old = targets[rank], counts[rank], old[rank]
            opens = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
            moved = np.diff(np.concatenate((opens, [len(old)])))
            zone = old[opens] + size[old[opens]] - moved  # they take the last places of their group
            slots = np.repeat(zone - opens, moved) + np.arange(len(old))
            marked[targets] = True
            occupants = order[slots]
            displaced = occupants[~marked[occupants]]
            marked[targets] = False
            where = position[targets]
            vacated = where[where < np.repeat(zone, moved)]
            order[vacated], position[displaced] = displaced, vacated
            order[slots], position[targets] = targets, slots
            size[old[opens]] -= moved
            heads = np.flatnonzero(np.concatenate(([True], (old[1:] != old[:-1]) | (counts[1:] != counts[:-1]))))
            held = np.diff(np.concatenate((heads, [len(old)])))
            group[targets] = np.repeat(slots[heads], held)
            size[slots[heads]] = held
        more = symbols[current - 1] >= 0  # not at the guard
        current = group[order[current[more] - 1]]
    return group, size, prev, order


def _emit(group: np.ndarray, prev: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    total = len(group)
    ranked = np.full(total, -1, np.int32)
    placed = group < 0  # the guards
    filled = np.zeros(total, np.int32)
    ranked[first] = last
    placed[last] = True
    step, active = 0, np.arange(len(first))
    while len(active):
        at = ranked[first[active] + step] - 1
        while True:
            at = at[~placed[at]]
            if not len(at):
                break
            placed[at] = True
            home = group[at]
            ranked[home + filled[home]] = at
            filled[home] += 1
            at = prev[at]
        step += 1
        active = active[first[active] + step <= last[active]]
    return ranked
