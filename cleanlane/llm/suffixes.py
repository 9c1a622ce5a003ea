"""Suffix arrays by linear grouping construction.

First all suffixes are grouped by the longest Lyndon prefix that they have.
Groups are processed in descending order.  A processed suffix i points to the
last place before it that is still in a lower group, its previous smaller one;
a suffix that l suffixes of the processed group point to takes their prefix l
times into its own, and so moves to a new group just above its old one.  Then
one pass over the growing result puts each suffix to the next free place of its
group.  Symbols are never renamed and there is no recursion.
"""

from __future__ import annotations

import numpy as np

from .common import ship

ship(__name__)


def _lyndon_groups(symbols: list[int]) -> tuple[list[list[int]], list[int]]:
    """The groups in descending order, and the previous smaller place of each suffix (0 where there is none), all counted from 1."""
    n = len(symbols)
    # places are moved up by one: place 0 stands before the text and is in no group
    group, members = [-1] * (n + 1), []
    order = np.argsort(np.asarray(symbols), kind="stable")
    values = np.asarray(symbols)[order]
    for part in np.split(order + 1, np.flatnonzero(np.diff(values)) + 1) if n else []:
        for i in part.tolist():
            group[i] = len(members)
        members.append(part.tolist())
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    back = list(range(-1, n))  # the place before, then shortcuts over processed places
    before = [0] * (n + 1)
    done = bytearray(n + 1)
    found = []
    at = len(members) - 1
    while at >= 0:
        own = [i for i in members[at] if group[i] == at]  # others have moved on
        members[at] = ()
        if own:
            found.append(own)
            for i in own:
                done[i] = 1
            hits: dict[int, int] = {}
            for i in own:
                p = back[i]
                if done[p]:
                    path = [i]
                    while done[p]:
                        path.append(p)
                        p = back[p]
                    for x in path:
                        back[x] = p
                before[i] = p
                if p:
                    hits[p] = hits.get(p, 0) + 1
            by_times: dict[int, list[int]] = {}
            for p, times in hits.items():
                by_times.setdefault(times, []).append(p)
            for times in sorted(by_times, reverse=True):
                new: dict[int, int] = {}
                for p in by_times[times]:
                    old = group[p]
                    to = new.get(old)
                    if to is None:
                        to = new[old] = len(members)
                        members.append([])
                        over = above[old]
                        below.append(old)
                        above.append(over)
                        above[old] = to
                        below[over] = to
                    members[to].append(p)
                    group[p] = to
        at = below[at]
    return found, before


def suffix_array(symbols: list[int]) -> list[int]:
    """The places of all suffixes in ascending order; the last symbol must be the smallest and stand there alone."""
    n = len(symbols)
    if n < 2:
        return list(range(n))
    groups, before = _lyndon_groups(symbols)
    free, start = [0] * (n + 1), 0  # the next free place of each suffix's group, kept with the group's first member
    leader = [0] * (n + 1)
    for own in reversed(groups):
        first = own[0]
        free[first] = start
        start += len(own)
        for i in own:
            leader[i] = first
    out, placed = [0] * n, bytearray(n + 1)
    out[0], placed[n] = n, 1
    placed[0] = 1
    for k in range(n):
        j = out[k] - 1
        while not placed[j]:
            g = leader[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = before[j]
    return [i - 1 for i in out]
