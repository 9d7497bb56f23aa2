"""Suffix sorting by linear grouping.

The longest Lyndon prefix of a suffix ends where the next smaller suffix begins. Suffixes with the same Lyndon prefix form a
group, groups are in the order of their prefixes, and the order of a group's suffixes is that of their next smaller suffixes.

Phase 1 finds the groups. At first a group is a symbol. Groups are processed in descending order; when a group is reached its
prefix u is final. Each of its suffixes points to the previous position in a smaller group (pointers of positions already
passed are followed, so every step jumps over what is larger). A position that k suffixes of the group point to is followed
by k times u: its prefix grows by them, and it leaves its group for a new one right behind, those with larger k further up.

Phase 2 goes through the suffixes from the smallest on: whatever has the current suffix as its next smaller one is reached by
the pointers from the position before it, up to one that already has its place, and gets the next place of its group. No
symbols are renamed and nothing recurs.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in order. Symbols are non-negative integers; the last one is smaller than all others."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    sorted_text = text[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_text[1:] != sorted_text[:-1])))
    sizes = np.zeros(n, dtype=np.int64)
    sizes[starts] = np.diff(np.append(starts, n))
    first = np.zeros(n, dtype=np.int64)
    first[order] = np.repeat(starts, sizes[starts])
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    sa, group, size, place = order.tolist(), first.tolist(), sizes.tolist(), place.tolist()
    before = _grouped(sa, group, size, place)
    return np.array(_emitted(group, before, n), dtype=np.int64)


def _grouped(sa: list[int], group: list[int], size: list[int], place: list[int]) -> list[int]:
    """Phase 1: refines ``group`` (each suffix's group, named by its first place) and returns the pointers."""
    n = len(sa)
    before = [-1] * n
    end = n
    while end:
        start = group[sa[end - 1]]
        if end - start == 1:
            i = sa[start]
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                g = group[p]
                left = size[g] - 1
                if left:
                    last, at = g + left, place[p]
                    other = sa[last]
                    sa[at], place[other] = other, at
                    sa[last], place[p] = p, last
                    size[g], size[last], group[p] = left, 1, last
        else:
            times: dict[int, int] = {}
            for i in sorted(sa[start:end]):
                p = i - 1
                while p >= 0 and group[p] >= start:
                    p = before[p]
                before[i] = p
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            levels: dict[int, list[int]] = {}
            for p, k in times.items():
                levels.setdefault(k, []).append(p)
            for k in sorted(levels, reverse=True):
                moved: dict[int, int] = {}
                for p in levels[k]:
                    g = group[p]
                    gone = moved[g] = moved.get(g, 0) + 1
                    last, at = g + size[g] - gone, place[p]
                    other = sa[last]
                    sa[at], place[other] = other, at
                    sa[last], place[p] = p, last
                for g, gone in moved.items():
                    left = size[g] - gone
                    if left:
                        new = g + left
                        size[g], size[new] = left, gone
                        for p in sa[new : new + gone]:
                            group[p] = new
        end = start
    return before


def _emitted(group: list[int], before: list[int], n: int) -> list[int]:
    """Phase 2: every suffix at its place."""
    out, free = [-1] * n, list(range(n))
    placed = [False] * n
    out[0], placed[n - 1] = n - 1, True
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = before[j]
    return out
