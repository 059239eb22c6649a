"""Suffix array by linear grouping.

First the suffixes are put into groups by their first letter. Groups are
processed in descending order: every suffix of a group points to the nearest
one before it that is in a lower group (previous smaller); the suffixes
pointed at have their group's Lyndon prefix extended by the processed one, so
they leave their group and form a new one right above it, those pointed at
more often higher up. In the end suffixes of a group share their Lyndon
prefix. Then one pass in ascending order emits each group's suffixes by
following the pointers from the suffix after the one just placed. Nothing is
renamed or sorted recursively.
"""

from __future__ import annotations


def suffix_array(text: bytes) -> list[int]:
    """Start positions of the suffixes of ``text`` in lexicographic order."""
    n = len(text)
    order, place, link, size = _letter_groups(text)
    before = _lyndon_groups(n, order, place, link, size)
    return _emit(n, link, before)


def _letter_groups(text: bytes):
    """Groups by first letter; position n, the empty suffix, is below all."""
    n = len(text)
    count = [0] * 257
    for c in text:
        count[c + 1] += 1
    start = [1] * 256
    for c in range(1, 256):
        start[c] = start[c - 1] + count[c]
    order, place, link, size = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [0] * (n + 2)
    free = start[:]
    for i, c in enumerate(text):
        at = free[c]
        free[c] = at + 1
        order[at], place[i], link[i] = i, at, start[c]
    for c in range(256):
        if count[c + 1]:
            size[start[c]] = count[c + 1]
    order[0], place[n], size[0] = n, 0, 1
    return order, place, link, size


def _lyndon_groups(n: int, order: list[int], place: list[int], link: list[int], size: list[int]) -> list[int]:
    """Refine the groups, highest first; returns the previous-smaller pointers.
    ``order`` lists the suffixes by group, ``place`` is its inverse, ``link``
    a suffix's group (where it starts in ``order``), ``size`` a group's size."""
    before, hits = [-1] * (n + 1), [0] * (n + 1)
    end = n
    while end > 0:
        first = link[order[end]]
        if first == end:
            s = order[end]
            p = s - 1
            while p >= 0 and link[p] >= first:
                p = before[p]
            before[s] = p
            if p >= 0:
                g = link[p]
                left = size[g] - 1
                if left:                     # else p is its whole group already
                    t = g + left
                    q, a = order[t], place[p]
                    order[a], place[q] = q, a
                    order[t], place[p] = p, t
                    size[g], link[p], size[t] = left, t, 1
            end = first - 1
            continue
        seen = []
        for s in sorted(order[first:end + 1]):
            p = s - 1
            while p >= 0 and link[p] >= first:
                p = before[p]
            before[s] = p
            if p >= 0:
                if not hits[p]:
                    seen.append(p)
                hits[p] += 1
        end = first - 1
        if not seen:
            continue
        by_hits: dict[int, list[int]] = {}
        for p in seen:
            by_hits.setdefault(hits[p], []).append(p)
            hits[p] = 0
        for times in sorted(by_hits, reverse=True):
            part, moved = by_hits[times], {}
            for p in part:                   # to the upper end of their groups
                g = link[p]
                left = size[g] - 1
                size[g] = left
                moved[g] = moved.get(g, 0) + 1
                t = g + left
                q, a = order[t], place[p]
                order[a], place[q] = q, a
                order[t], place[p] = p, t
            for g, n_moved in moved.items():
                if size[g]:                  # what moved out of a group is a new one
                    size[g + size[g]] = n_moved
            for p in part:
                g = link[p]
                if size[g]:
                    link[p] = g + size[g]
            for g, n_moved in moved.items():
                if not size[g]:              # a group that moved as a whole stays as it was
                    size[g] = n_moved
    return before


def _emit(n: int, link: list[int], before: list[int]) -> list[int]:
    """Suffixes in order, group by group."""
    out, free, placed = [-1] * (n + 1), list(range(n + 1)), bytearray(n + 1)
    out[0], placed[n] = n, 1
    for i in range(n + 1):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = link[s]
            at = free[g]
            free[g] = at + 1
            out[at], placed[s] = s, 1
            s = before[s]
    return out[1:]
