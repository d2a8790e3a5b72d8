"""Sets of character shingles of many lines at a time: MinHash bands and exact similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from opinara.llm.shingles import mixed

NARROW = 5
BANDS = 20
ROWS = 6
CHUNK_CHARS = 1 << 16
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0x27D4EB2F165667C5]
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def line_shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and line number of every shingle, repeated ones too; a shorter line is its own shingle."""
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(x) for x in lines], np.int64)
    starts = np.cumsum(sizes) - sizes
    counts = np.maximum(sizes - NARROW + 1, 0)
    owner = np.repeat(np.arange(len(lines)), counts)
    found = np.zeros(max(0, len(code) - NARROW + 1), np.uint64)
    for i in range(NARROW):
        found *= np.uint64(_ODD[1])
        found += code[i : i + len(found)]
    # Of the shingles at all places, those that lie within a line.
    inside = np.ones(len(found), bool)
    for back in range(1, NARROW):
        cut = starts - back
        inside[cut[(cut >= 0) & (cut < len(found)) & (sizes > 0)]] = False
    short = np.flatnonzero(counts == 0)
    for line in short.tolist():
        inside[starts[line] : starts[line] + sizes[line]] = False
    found = mixed(found[inside])
    if len(short):
        own = []
        for line in short.tolist():
            value = int(sizes[line]) << 40
            for c in code[starts[line] : starts[line] + sizes[line]].tolist():
                value = (value * _ODD[1] + c + 1) & 0xFFFFFFFFFFFFFFFF
            own.append(value ^ 0x5555555555555555)
        found = np.append(found, mixed(np.array(own, np.uint64)))
        owner = np.append(owner, short)
    return found, owner


def bands(lines: list[str]) -> np.ndarray:
    """``BANDS`` keys per line. A key joins ``ROWS`` minima, one under each of independent hashes of the
    shingles that fall into the band's stretch; an empty stretch takes the minimum of the next one."""
    hashes, owner = line_shingles(lines)
    base = owner * BANDS
    key = np.zeros((len(lines), BANDS), np.uint64)
    for r in range(ROWS):
        h = (hashes ^ (hashes >> np.uint64(29 + r))) * np.uint64(_ODD[r])
        cell = (h >> np.uint64(44)).view(np.int64) * BANDS >> 20
        cell += base
        least = np.full(len(lines) * BANDS, _NONE)
        np.minimum.at(least, cell, h)
        least = least.reshape(-1, BANDS)
        while True:
            empty = least == _NONE
            if not empty.any():
                break
            least = np.where(empty, np.roll(least, -1, axis=1), least)
        key = mixed(key + least) + np.uint64(r + 1)
    return mixed(key + np.arange(BANDS, dtype=np.uint64) * np.uint64(_ODD[0]))


def chunks(lines: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of lines of a bounded number of characters, one line at least."""
    lo = 0
    while lo < len(lines):
        hi, size = lo, 0
        while hi < len(lines) and (hi == lo or size + len(lines[hi]) < CHUNK_CHARS):
            size += len(lines[hi])
            hi += 1
        yield lo, hi
        lo = hi


def _distinct(lines: list[str]) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """The sets of the lines as sorted numbers, line first and then the hash in the lower bits, how many
    those are (50 or so), the line numbers, and the sizes of the sets."""
    hashes, owner = line_shingles(lines)
    bits = 64 - max(1, len(lines).bit_length())
    keys = hashes >> np.uint64(64 - bits)
    keys |= owner.astype(np.uint64) << np.uint64(bits)
    keys.sort()
    if len(keys):
        keys = keys[np.append(True, keys[1:] != keys[:-1])]
    owner = (keys >> np.uint64(bits)).astype(np.int64)
    return keys, bits, owner, np.bincount(owner, minlength=len(lines))


def pairs_similar(left: list[str], right: list[str], percent: int) -> np.ndarray:
    """Whether the sets of ``left[i]`` and ``right[i]`` have a Jaccard similarity of ``percent``."""
    n = len(left)
    keys, bits, owner, sizes = _distinct(left + right)
    # Under the same line number, a shingle of both lines stands there twice.
    keys[owner >= n] -= np.uint64(n << bits)
    keys.sort()
    twice = keys[1:][keys[1:] == keys[:-1]] >> np.uint64(bits)
    both = np.bincount(twice.astype(np.int64), minlength=n)
    return both * 100 >= (sizes[:n] + sizes[n:] - both) * percent


def links_between(lines: list[str], roots: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join all similar lines of different roots: a forest, no pair twice.

    Lines of ``side`` 0 are compared with those of 1; if there is one side only, all with each other.
    Only shingles that several lines share are counted, as products of incidence matrices.
    """
    keys, bits, owner, sizes = _distinct(lines)
    hashes = keys & np.uint64((1 << bits) - 1)
    _, token, times = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = times[token] > 1
    columns, token = np.unique(token[shared], return_inverse=True)
    owner = owner[shared]
    both = np.zeros((len(lines), len(lines)), np.float32)
    step = max(256, (1 << 23) // max(1, len(lines)))
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    for lo in range(0, len(columns), step):
        a, b = np.searchsorted(token, [lo, lo + step])
        part = np.zeros((len(lines), min(step, len(columns) - lo)), np.float32)
        part[owner[a:b], token[a:b] - lo] = 1
        both += part @ part.T
    near = both * 100 >= (sizes[:, None] + sizes[None, :] - both) * percent
    near &= roots[:, None] != roots[None, :]
    if side.any() and not side.all():
        near &= side[:, None] != side[None, :]
    parent = {r: r for r in roots.tolist()}

    def find(r: int) -> int:
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(near))), strict=True):
        a, b = find(int(roots[i])), find(int(roots[j]))
        if a != b:
            parent[a] = b
            out.append((i, j))
    return out
