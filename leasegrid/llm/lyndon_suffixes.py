"""Suffix sorting by Lyndon-prefix groups, linear in the length of the text.

First every suffix is put into the group of its longest Lyndon prefix: groups
are processed from the greatest to the smallest, and each hands its prefix on
to the previous smaller suffixes of its members, which splits their groups.
Then one pass over the order found so far emits the members of each group; no
renamed string is ever sorted.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in ascending order; ``text`` are integers, a shorter suffix sorts first."""
    n = len(text) + 1  # one more sign at the end, smaller than all
    if n == 1:
        return np.zeros(0, np.int64)
    signs = np.concatenate([np.asarray(text, np.int64), [np.iinfo(np.int64).min]])
    order = np.argsort(signs, kind="stable")
    ranked = signs[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    starts = np.flatnonzero(fresh)
    begin = starts[np.cumsum(fresh) - 1]
    group_of, place_of = np.empty(n, np.int64), np.empty(n, np.int64)
    group_of[order], place_of[order] = begin, np.arange(n)
    count = np.zeros(n, np.int64)
    count[starts] = np.diff(np.concatenate([starts, [n]]))
    order, group, place, count = order.tolist(), group_of.tolist(), place_of.tolist(), count.tolist()
    previous = [-1] * n

    end = n
    while end > 1:
        start = group[order[end - 1]]
        if end - start == 1:
            s = order[start]
            p = s - 1
            while p >= 0 and group[p] > start:
                p = previous[p]
            previous[s] = p
            if p >= 0:  # p alone moves to the end of its group
                g = group[p]
                c = count[g] - 1
                if c:
                    at, last = place[p], g + c
                    o = order[last]
                    order[at], place[o] = o, at
                    order[last], place[p] = p, last
                    count[g], count[last], group[p] = c, 1, last
            end = start
            continue
        members = order[start:end]
        chained = False
        for s in members:
            p = s - 1
            while p >= 0 and group[p] > start:
                p = previous[p]
            previous[s] = p
            if p >= 0 and group[p] == start:
                chained = True
        if chained:  # prefixes that follow each other directly: count how often they repeat
            members.sort()
            times = dict.fromkeys(members, 1)
            for s in reversed(members):
                p = previous[s]
                if p >= 0 and group[p] == start:
                    times[p] = times[s] + 1
            batches: dict[int, list[int]] = {}
            for s in members:
                p = previous[s]
                if p >= 0:
                    if group[p] == start:
                        previous[s] = previous[p]
                    else:
                        batches.setdefault(times[s], []).append(p)
            todo = [batches[k] for k in sorted(batches, reverse=True)]
        else:
            todo = [[previous[s] for s in members if previous[s] >= 0]]
        for moved in todo:  # more repetitions sort later
            for p in moved:
                g = group[p]
                c = count[g] = count[g] - 1
                at, last = place[p], g + c
                o = order[last]
                order[at], place[o] = o, at
                order[last], place[p] = p, last
            into = [group[p] + count[group[p]] for p in moved]
            for p, g in zip(moved, into):
                group[p] = g
                count[g] += 1
        end = start

    free, out = list(range(n)), [-1] * n
    placed = bytearray(n)
    out[0] = n - 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            placed[s] = 1
            g = group[s]
            at = free[g]
            out[at], free[g] = s, at + 1
            s = previous[s]
    return np.array(out[1:], np.int64)
