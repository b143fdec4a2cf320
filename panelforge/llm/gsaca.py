"""Suffix array by linear grouping (no recursion, no renaming).

Suffixes are grouped by ever longer common prefixes until each group shares its
Lyndon prefix (the longest Lyndon word that starts there).  Groups are taken in
descending order; for each member the pointer to the previous suffix of a
smaller group is found along pointers found before, and the suffixes pointed at
move behind their old group, the farther the more members point at them.  In
the second phase one pass over the array emits the order within the groups.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of an integer sequence (a shorter one first when it
    is a prefix of the other)."""
    n = len(text) + 1
    if n == 1:
        return np.empty(0, np.int64)
    symbols = np.concatenate((np.asarray(text, np.int64), [int(np.min(text)) - 1]))  # ends with the smallest
    first = np.argsort(symbols, kind="stable")
    ordered = symbols[first]
    starts = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    begin = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    order = first.tolist()  # suffixes by group
    place = np.argsort(first).tolist()  # where a suffix stands in it
    group = begin[place].tolist()  # begin of a suffix's group
    size = np.bincount(begin, minlength=n).tolist()  # by the group's begin
    prev = [-1] * n

    end = n
    while end > 1:
        begin_ = group[order[end - 1]]
        if end - begin_ == 1:  # one member: one pointer, counted once
            s = order[begin_]
            p = s - 1
            while p >= 0 and group[p] >= begin_:
                p = prev[p]
            prev[s] = p
            if p >= 0 and size[g := group[p]] > 1:
                size[g] = left = size[g] - 1
                to = g + left
                at, other = place[p], order[to]
                order[at], place[other] = other, at
                order[to], place[p] = p, to
                group[p], size[to] = to, 1
        else:
            counts: dict[int, int] = defaultdict(int)
            for s in sorted(order[begin_:end]):
                p = s - 1
                while p >= 0 and group[p] >= begin_:
                    p = prev[p]
                prev[s] = p
                if p >= 0:
                    counts[p] += 1
            alike: dict[tuple[int, int], list[int]] = defaultdict(list)
            for p, c in counts.items():
                alike[c, group[p]].append(p)
            for (_, g), ps in sorted(alike.items(), key=lambda item: -item[0][0]):
                if size[g] == len(ps):
                    continue
                to = g + size[g]
                for p in ps:
                    to -= 1
                    at, other = place[p], order[to]
                    order[at], place[other] = other, at
                    order[to], place[p] = p, to
                size[g] -= len(ps)
                size[to] = len(ps)
                for p in ps:
                    group[p] = to
        end = begin_

    free = list(range(n))  # next place of the group that begins here
    done = bytearray(n)
    out = [0] * n
    out[0] = n - 1
    done[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            done[s] = 1
            s = prev[s]
    return np.array(out[1:], np.int64)
