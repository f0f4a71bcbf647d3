"""Linear suffix array construction by grouping (no recursive renaming)."""

from __future__ import annotations

from array import array
from collections.abc import Sequence

import numpy as np


def _places(n: int) -> array:
    """n zeros that can become places in a text of about n symbols."""
    return _as_places(np.zeros(n, np.int64), n)


def _as_places(values: np.ndarray, n: int) -> array:
    wide = n >= 1 << 31
    out = array("q" if wide else "i")
    out.frombytes(values.astype(np.int64 if wide else np.int32).tobytes())
    return out


def suffix_array(text: Sequence[int]) -> Sequence[int]:
    """Suffixes of ``text`` (integers) in ascending order.

    Suffixes are grouped by their first symbol and the groups refined from
    the greatest down: when a group, whose members share a Lyndon prefix u, is
    taken, each member's pointer goes to the nearest position before it that
    lies in a lesser group, whose prefix v then becomes v u, v u u, ... by the
    number of members that point to it. Those positions leave their group for
    a new one just above it. At the end, groups are in the order of their
    Lyndon prefixes; one ascending pass emits each group's order: after a
    suffix come, at the front of their groups, the positions whose Lyndon
    prefix ends just before it, found along the pointers.
    """
    n = len(text)
    order = _as_places(np.argsort(np.asarray(text, np.int64), kind="stable"), n)
    place, first, size = _places(n), _places(n), _places(n)  # size: by a group's first place
    start = 0
    for i, s in enumerate(order):
        if i and text[s] != text[order[i - 1]]:
            start = i
        place[s], first[s] = i, start
        size[start] += 1

    before = _places(n)
    skip = _as_places(np.arange(-1, n), n)  # skip[i + 1]: i if untaken, else somewhere before it
    count = _places(n)
    at = n - 1
    while at >= 0:
        start = first[order[at]]
        members = order[start:at + 1]
        for m in members:
            skip[m + 1] = m - 1
        parents = []
        for m in members:
            p = m - 1
            while skip[p + 1] != p:
                skip[p + 1] = skip[skip[p + 1] + 1]
                p = skip[p + 1]
            before[m] = p
            if p >= 0:
                if not count[p]:
                    parents.append(p)
                count[p] += 1
        while parents:
            moved: dict[int, int] = {}
            for p in parents:  # to the end of its group
                g = first[p]
                k = moved.get(g, 0) + 1
                moved[g] = k
                end = g + size[g] - k
                q, here = order[end], place[p]
                order[end], order[here] = p, q
                place[p], place[q] = end, here
            for g, k in moved.items():
                if k < size[g]:
                    size[g] -= k
                    new = g + size[g]
                    size[new] = k
                    for i in range(new, new + k):
                        first[order[i]] = new
            rest = []
            for p in parents:
                count[p] -= 1
                if count[p]:
                    rest.append(p)
            parents = rest
        at = start - 1

    out, placed = _places(n + 1), bytearray(n)
    front = _as_places(np.arange(n + 1), n)  # next free place of a group, by its first place
    for i in range(-1, n):
        p = (out[i] if i >= 0 else n) - 1  # the empty suffix is the least of all
        while p >= 0 and not placed[p]:
            g = first[p]
            out[front[g]] = p
            front[g] += 1
            placed[p] = 1
            p = before[p]
    return out[:n]


def longest_matches(text: Sequence[int], weight: Sequence[int]) -> Sequence[int]:
    """For each suffix, the weight of the longest prefix it shares with another.

    The neighbours in suffix order share most; their common prefixes are found
    in text order, each at most one symbol shorter than the one before.
    """
    n = len(text)
    order = suffix_array(text)
    rank = _places(n)
    for i, s in enumerate(order):
        rank[s] = i
    total = array("q", np.r_[0, np.cumsum(np.asarray(weight, np.int64))].tobytes())
    best = array("q", bytes(8 * n))
    h = 0
    for s in range(n):
        if not rank[s]:
            h = 0
            continue
        t = order[rank[s] - 1]
        while s + h < n and t + h < n and text[s + h] == text[t + h]:
            h += 1
        both = total[s + h] - total[s]
        best[s] = max(best[s], both)
        best[t] = max(best[t], both)
        h = max(0, h - 1)
    return best
