"""Sets of five-word shingles as sorted 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
CHUNK_BYTES = 500_000
_ODD = 0x9E3779B97F4A7C15  # fixed odd multiplier of the polynomial
_MASK = (1 << 64) - 1

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word; A-Z lowered, words split at ASCII white space."""
    joined = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[joined]
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = change[0::2], change[1::2]
    up, down = _powers(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((_FOLD[joined].astype(np.uint64) + np.uint64(1)) * up[: len(joined)], out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * down[starts])
    limits = np.cumsum([len(t) + 1 for t in texts])
    return words, np.searchsorted(limits, starts, "right")


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin (one more at the end).

    Fewer words than a shingle has make one shingle of them all; no word, no shingle.
    """
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=n)
    hashes, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(words) >= WORDS:
        last = len(words) - WORDS + 1
        acc = np.zeros(last, np.uint64)
        for k in range(WORDS):
            acc = mixed(acc + words[k : k + last]) + np.uint64(k + 1)
        whole = owner[:last] == owner[WORDS - 1 :]
        hashes, owners = acc[whole], owner[:last][whole]
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        first = np.cumsum(counts) - counts
        extra = np.zeros(len(short), np.uint64)
        for r, t in enumerate(short):
            value = int(counts[t]) << 32
            for w in words[first[t] : first[t] + counts[t]].tolist():
                value = ((value ^ w) * _ODD + 1) & _MASK
            extra[r] = value
        hashes, owners = np.concatenate([hashes, mixed(extra)]), np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[new], owners[new]
    return hashes, np.searchsorted(owners, np.arange(n + 1))


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts a few megabytes at a time, with the place of the first of each chunk."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) < CHUNK_BYTES):
            size += len(texts[hi])
            hi += 1
        yield lo, texts[lo:hi]
        lo = hi


def set_digests(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit name per set, from the sum of its remixed hashes and its size."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mixed(hashes ^ np.uint64(_ODD)), out=sums[1:])
    sizes = np.diff(offsets).astype(np.uint64)
    return mixed((sums[offsets[1:]] - sums[offsets[:-1]]) * np.uint64(_ODD) + sizes)
