"""Content-chosen anchors: every window of a text has one, and equal windows have the same."""

from __future__ import annotations

import numpy as np

from opinara.llm.shingles import mixed

GRAM = 24
_ODD = 0xD6E8FEB86659FD93  # fixed odd multiplier of the polynomial


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed hash of the GRAM bytes from every place on, by doubling the length hashed."""
    spans, h, size = [], data.astype(np.uint64) + np.uint64(1), 1
    parts = [b for b in range(GRAM.bit_length()) if GRAM >> b & 1]
    for b in range(GRAM.bit_length()):
        if b in parts:
            spans.append((h, size))
        step = np.uint64(pow(_ODD, size, 1 << 64))
        if 2 * size <= GRAM:
            h = h[:-size] * step + h[size:]
            size *= 2
    n = len(data) - GRAM + 1
    out, at = np.zeros(n, np.uint64), 0
    for h, size in reversed(spans):
        out = out * np.uint64(pow(_ODD, size, 1 << 64)) + h[at : at + n]
        at += size
    return mixed(out)


def _lowest_last(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the minimum of each run of ``width`` values, the last one of equals."""
    # The low bits give way to the place, later places being smaller, so one minimum does both.
    n, bits = len(values), 24
    place = np.arange(n, dtype=np.uint64) & np.uint64((1 << bits) - 1)
    low = (values >> np.uint64(bits) << np.uint64(bits)) | (np.uint64((1 << bits) - 1) - place)
    size = 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[: n - width + 1], low[width - size :][: n - width + 1])
    return (np.uint64((1 << bits) - 1) - (low & np.uint64((1 << bits) - 1))).astype(np.int64)


def owned_windows(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text (at most 16 million bytes) with hash, place, and first and last window start.

    A window belongs to the anchor at its lowest gram hash, the last one of equals. Every window of
    the text belongs to exactly one anchor, and the windows of an anchor follow one another.
    """
    if len(data) < window:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    hashes = _gram_hashes(data)
    anchor = _lowest_last(hashes, window - GRAM + 1)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([new[1:], [len(anchor)]]) - 1
    return hashes[anchor[new]], anchor[new], new, last
