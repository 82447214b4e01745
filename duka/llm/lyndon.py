"""Suffix arrays by linear grouping over Lyndon prefixes, without renaming."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative integers (a shorter suffix that is a
    prefix of another comes first).

    Phase 1 keeps the suffixes in groups with a common prefix, groups in
    ascending order, and takes the groups in descending order. For a suffix i
    of the group, prev[i] is the nearest position to the left whose group is
    lower; its prefix ends where i starts, so it is prolonged by the group's
    prefix, once for each member that points to it. Those of one group that are
    prolonged equally often become a group of their own, just above the rest
    of the old one. In the end every group holds the suffixes with one longest
    Lyndon prefix.

    Phase 2 takes the suffixes in ascending order. The suffixes whose Lyndon
    prefix ends where the current one starts are its left neighbour and the chain of
    previous-smaller pointers from there, as far as they have no place yet;
    each takes the next free place of its group.
    """
    n = len(symbols) + 1
    text = np.zeros(n, np.int64)
    text[:-1] = np.asarray(symbols, np.int64) + 1
    order = np.argsort(text, kind="stable")
    sa = order.tolist()
    ranked = text[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    starts = np.empty(n, np.int64)
    starts[order] = np.repeat(first, np.diff(np.r_[first, n]))
    group = starts.tolist()             # first place of a suffix's group
    last = [0] * n                      # group's first place -> its last place
    for a, b in zip(first.tolist(), np.r_[first[1:], n].tolist()):
        last[a] = b - 1
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    place = place.tolist()
    prev = [-1] * n

    def lift(members: list[int]) -> None:
        """Members (of any lower groups) leave their groups upwards."""
        taken: dict[int, int] = {}
        for p in members:
            g = group[p]
            k = taken.get(g, 0)
            taken[g] = k + 1
            at, to = place[p], last[g] - k
            if at != to:
                q = sa[to]
                sa[at], sa[to] = q, p
                place[q], place[p] = at, to
        for g, k in taken.items():
            end = last[g]
            new = end - k + 1
            if new > g:
                last[g], last[new] = new - 1, end
                for p in sa[new:end + 1]:
                    group[p] = new

    end = n - 1
    while end > 0:
        start = group[sa[end]]
        if start == end:        # a group of one prolongs one suffix at most
            i = sa[end]
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                g = group[p]
                to = last[g]
                if to > g:      # it leaves its group upwards
                    at = place[p]
                    if at != to:
                        q = sa[to]
                        sa[at], sa[to] = q, p
                        place[q], place[p] = at, to
                    last[g], last[to] = to - 1, to
                    group[p] = to
            end -= 1
            continue
        members = sa[start:end + 1]
        members.sort()
        times: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        if len(times) == len(members) or max(times.values(), default=1) == 1:
            lift(list(times))
        else:
            for k in sorted(set(times.values()), reverse=True):
                lift([p for p, t in times.items() if t == k])
        end = start - 1

    free = [-1] * n                     # next free place of a group
    out = [0] * n
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for k in range(n):
        e = out[k] - 1
        while e >= 0 and not placed[e]:
            g = group[e]
            at = free[g]
            if at < 0:
                at = g
            out[at] = e
            free[g] = at + 1
            placed[e] = 1
            e = prev[e]
    return np.array(out[1:], np.int64)
