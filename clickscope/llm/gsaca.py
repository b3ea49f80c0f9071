"""Suffix sorting by Lyndon groups, in two linear passes and without recursive renaming.

First pass: suffixes are grouped by their first symbol. Groups are taken in descending order; for every member the
previous-smaller pointer (the nearest position to its left that lies in a lower group) is found by following pointers
already set. The positions so reached are lifted out of their group into new groups right above it, the higher the more
members point at them. At the end a group holds the suffixes that begin with the same Lyndon word.

Second pass: the suffix array is filled from the left; each suffix that is emitted puts the position before it, and
then the chain of previous-smaller pointers from there, at the front of their groups.
"""

from __future__ import annotations


def lyndon_groups(t: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(group number per position, ascending; group start in the suffix array; previous-smaller pointers)."""
    n = len(t)
    symbols = sorted(set(t))
    rank = {s: g for g, s in enumerate(symbols)}
    group = [rank[s] for s in t]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    above = [*range(1, len(symbols)), -1]   # doubly linked order of the groups
    below = [-1, *range(len(symbols) - 1)]
    prev, done = [-1] * n, [False] * n
    order: list[int] = []
    g = len(symbols) - 1
    while g >= 0:
        mine = [i for i in members[g] if group[i] == g]
        members[g] = mine
        if mine:
            order.append(g)
        for i in mine:
            done[i] = True
            prev[i] = i - 1
        pointed: dict[int, int] = {}
        for i in mine:
            p = prev[i]
            while p >= 0 and done[p]:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        lifted: dict[int, dict[int, list[int]]] = {}
        for p, k in pointed.items():
            lifted.setdefault(group[p], {}).setdefault(k, []).append(p)
        for h, by_count in lifted.items():
            at = h
            for k in sorted(by_count):
                new = len(members)
                members.append(by_count[k])
                for p in by_count[k]:
                    group[p] = new
                up = above[at]
                above.append(up)
                below.append(at)
                above[at] = new
                if up >= 0:
                    below[up] = new
                at = new
        g = below[g]
    number, start, filled = {}, [], 0
    for r, g in enumerate(reversed(order)):
        number[g] = r
        start.append(filled)
        filled += len(members[g])
    return [number[g] for g in group], start, prev


def suffix_array(t: list[int]) -> list[int]:
    """Suffix array of ``t``, whose last symbol is its only smallest one."""
    n = len(t)
    if not n:
        return []
    group, front, prev = lyndon_groups(t)
    sa, placed = [-1] * n, [False] * n
    sa[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        j = sa[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            sa[front[g]] = j
            front[g] += 1
            placed[j] = True
            j = prev[j]
    return sa


def lcp_array(t: list[int], sa: list[int]) -> list[int]:
    """Common prefix (in symbols) of each suffix with the one before it in the suffix array."""
    n = len(t)
    rank, lcp, h = [0] * n, [0] * n, 0
    for r, i in enumerate(sa):
        rank[i] = r
    for i in range(n):
        if not rank[i]:
            h = 0
            continue
        j = sa[rank[i] - 1]
        while i + h < n and j + h < n and t[i + h] == t[j + h]:
            h += 1
        lcp[rank[i]] = h
        h = max(0, h - 1)
    return lcp
