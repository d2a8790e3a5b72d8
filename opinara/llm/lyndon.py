"""Suffix sorting in linear grouping steps, without recursion and renaming.

First the suffixes are grouped by their Lyndon prefix: groups start as the symbols and are taken from
the highest down. Every suffix of a group points to the nearest place before it whose group is still
lower (found by hopping along the pointers of higher groups); those places are moved, by how often the
group follows them, into new groups right above their old one. Then each group's order is emitted:
suffixes are taken in ascending order, and the places before them, along the pointers, go to the front
of their groups.
"""

from __future__ import annotations

import numpy as np


def _grouped(symbols: np.ndarray) -> tuple[list[int], list[int], list[list[int]], list[int], int, list[int]]:
    """Group and pointer of each suffix; members and next lower group of each group; top; sizes."""
    order = np.argsort(symbols, kind="stable")
    kinds, starts = np.unique(symbols[order], return_index=True)
    bounds = [*starts.tolist(), len(order)]
    members = [order[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    group = np.searchsorted(kinds, symbols).tolist()
    lower = list(range(-1, len(members) - 1))
    upper = [*range(1, len(members)), -1]
    size = [len(m) for m in members]
    done = [False] * len(members)
    before = [-1] * len(group)
    top = current = len(members) - 1

    def lifted(places: list[int], old: int) -> int:
        """A new group of some places of an old one, right above it; returns the new top."""
        new, above = len(members), upper[old]
        members.append(places)
        size.append(len(places))
        size[old] -= len(places)
        done.append(False)
        lower.append(old)
        upper.append(above)
        upper[old] = new
        for p in places:
            group[p] = new
        if above < 0:
            return new
        lower[above] = new
        return top

    while current >= 0:
        done[current] = True
        own = members[current]
        if len(own) != size[current]:
            own = members[current] = [s for s in own if group[s] == current]
        if len(own) == 1:
            s = own[0]
            p = s - 1
            while p >= 0 and done[group[p]]:
                p = before[p]
            before[s] = p
            # A group all of whose places would move stays as it is.
            if p >= 0 and size[group[p]] > 1:
                top = lifted([p], group[p])
        elif own:
            own.sort()
            follows: dict[int, int] = {}
            for s in own:
                p = s - 1
                while p >= 0 and done[group[p]]:
                    p = before[p]
                before[s] = p
                if p >= 0:
                    follows[p] = follows.get(p, 0) + 1
            # By old group and by how often this group follows; more often means higher.
            moved: dict[tuple[int, int], list[int]] = {}
            for p, times in follows.items():
                moved.setdefault((group[p], -times), []).append(p)
            for old, times in sorted(moved):
                if len(moved[old, times]) < size[old]:
                    top = lifted(moved[old, times], old)
        current = lower[current]
    return group, before, members, lower, top, size


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in ascending order; a suffix that is a prefix of another comes first."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    group, before, members, lower, top, size = _grouped(symbols)
    # Where each group begins, from the lowest up.
    chain = []
    while top >= 0:
        chain.append(top)
        top = lower[top]
    front, at = [0] * len(members), 0
    for g in reversed(chain):
        front[g] = at
        at += size[g]
    out, placed = [-1] * n, [False] * n

    def emit(s: int) -> None:
        while s >= 0 and not placed[s]:
            placed[s] = True
            g = group[s]
            out[front[g]] = s
            front[g] += 1
            s = before[s]

    emit(n - 1)
    for i in range(n):
        emit(out[i] - 1)
    return np.array(out, np.int64)
