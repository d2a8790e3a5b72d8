"""Plain versions of the operators, one text or pair at a time."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def shingles(text: str | None, k: int = 5) -> frozenset:
    words = WORD.findall(lower(text))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def groups(nodes, linked) -> dict:
    """Smallest reachable node of each node; ``linked`` gives the pairs."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def near_groups(docs: dict) -> dict:
    """doc_id -> (size, component) by comparing every pair that shares a shingle."""
    sets = {d: shingles(t) for d, t in docs.items()}
    where: dict = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    pairs = {(a, b) for ds in where.values() for i, a in enumerate(ds) for b in ds[i + 1 :]}
    near = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = groups(list(docs), near)
    return {d: (len(sets[d]), comp[d]) for d in docs}


def repeated_bytes(docs: list[tuple], window: int = 100) -> dict:
    """doc_id -> flags of the bytes covered by a window that also starts earlier."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            w = data[i : i + window]
            if w in seen:
                gone[i : i + window] = b"\1" * window
            else:
                seen.add(w)
        out[doc_id] = gone
    return out


def substring_dedup(docs: list[tuple], window: int = 100) -> dict:
    """doc_id -> (bytes, removed, runs, digest of the rest)."""
    out = {}
    texts = {d: (t or "").encode() for d, t in docs}
    for doc_id, gone in repeated_bytes(docs, window).items():
        data = texts[doc_id]
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc_id] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out
