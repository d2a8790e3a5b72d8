"""Removal of repeated substrings through suffix arrays of candidate contexts.

A byte goes if a string of ``WINDOW`` bytes covers it that also starts earlier (in a smaller doc_id,
or earlier in the same document). Finding them loses nothing:

1. Every window belongs to the place of its lowest gram hash (its anchor), and equal windows have
   equal anchors at the same place. The windows of one anchor form its context. Anchors are sorted by
   hash over the cluster; those whose hash occurs once are done.
2. Of equal contexts only the first is looked at further; the others lose all their windows. This is
   done per batch already, so that a passage that many documents share sends one row per batch.
3. Different contexts under one anchor hash meet in a tile. Their bytes are cut, from the anchor on,
   into blocks; the blocks of all contexts of the tile form one string, whose suffix array is built by
   linear grouping (:mod:`opinara.llm.lyndon`). Suffixes that agree in as many blocks as a window has
   are one class, and windows are equal if their whole blocks are of one class and the bytes before
   and behind are the same. All but the first window of a class go.
4. Anchor hashes that occur very often (found by lossy counting over all documents; at most 2^20 of
   them) would make large tiles. Their windows are compared one by one under their own hash instead.

Texts travel compressed. Defined results: null text is empty; a null doc_id counts as the smallest; rows
that share a doc_id (or have none) are documents of their own if their texts differ, in the order of a
hash of the text; rows that repeat doc_id and text are one document, which each of them shows; texts
shorter than a window stay; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.anchors import owned_windows
from opinara.llm.lyndon import suffix_array
from opinara.llm.shared import compressed, scratch, stage, unpacked
from opinara.llm.shingles import _powers, mixed
from opinara.operators.keys import global_position

WINDOW = 100
BLOCK = 8
OFTEN_FROM = 1024
OFTEN_AT_MOST = 1 << 20
TILE = 2048
SEGMENT = 8 << 20
CHUNK_BYTES = 8 << 20
_EXACT, _WINDOW, _GONE = 0, 1, 2  # kinds of rows
_ROW = "a bigint, b bigint, doc_id {0}, place bigint, kind int"
_NAMES = ["a", "b", "doc_id", "place", "kind"]


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def contexts(text: bytes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, anchor place, first and last window start of all contexts, segment by segment."""
    data, parts = np.frombuffer(text, np.uint8), []
    for lo in range(0, max(1, len(data) - window + 1), SEGMENT):
        h, at, first, last = owned_windows(data[lo : lo + SEGMENT + window - 1], window)
        parts.append((h, at + lo, first + lo, last + lo))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _place(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Anchor place and how far before it its windows start, in one number."""
    return at << 16 | (at - first) << 8 | (at - last)


def _unplaced(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = place >> 16
    return at, at - (place >> 8 & 255), at - (place & 255)


def _sums(text: bytes) -> np.ndarray:
    up, _ = _powers(len(text) + 1)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=sums[1:])
    return sums


def _hashed(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _powers(len(sums))
    return mixed((sums[end] - sums[start]) * down[start])


def _batch(kind: pa.DataType, parts: list[tuple]) -> pa.RecordBatch:
    """Rows from parts of (a, b, doc_ids, place, kind)."""
    if not parts:
        return pa.RecordBatch.from_arrays(
            [pa.array([], t) for t in (pa.int64(), pa.int64(), kind, pa.int64(), pa.int32())], names=_NAMES
        )
    a, b, place = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 3))
    docs = pa.chunked_array([p[2] for p in parts]).combine_chunks()
    flags = np.concatenate([np.full(len(p[0]), p[4], np.int32) for p in parts])
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), docs, pa.array(place), pa.array(flags)],
        names=_NAMES,
    )


def often_anchors(docs: DataFrame, window: int) -> np.ndarray:
    """Sorted hashes of the anchors that occur very often, by lossy counting over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [contexts(t, window)[0] for t in _bytes(batch) if len(t) >= window]
            hashes, times = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
            keep = times > 3
            rows = np.append(hashes[keep].view(np.int64), 0), np.append(times[keep], 0)
            totals = np.zeros(len(rows[0]), np.int64)
            totals[-1] = times.sum()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*rows, totals)], names=["a", "n", "total"])

    counted = stage(docs.select("text").mapInArrow(count, "a bigint, n bigint, total bigint"))
    total = counted.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    least = max(OFTEN_FROM, -(-total // OFTEN_AT_MOST))
    often = counted.where("n > 0").groupBy("a").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    found = np.array([r[0] for r in often.select("a").collect()], np.int64).view(np.uint64)
    found.sort()
    return found


def anchored(docs: DataFrame, window: int, often: np.ndarray) -> DataFrame:
    """One row per context (or window of a frequent anchor), and per context known to be a repeat.

    ``a, b`` name anchor and context, or the window twice over.
    """
    kind = dict(docs.dtypes)["doc_id"]
    shipped = docs.sparkSession.sparkContext.broadcast(often)  # at most 2^20 hashes

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shipped.value
        for batch in batches:
            ids, parts, size = batch.column("doc_id"), [], 0
            for number, text in enumerate(_bytes(batch)):
                if size > CHUNK_BYTES:  # a bounded part of the batch at a time
                    yield _first_of_batch(_batch(ids.type, parts))
                    parts, size = [], 0
                if len(text) < window:
                    continue
                size += len(text)
                h, at, first, last = contexts(text, window)
                sums = _sums(text)
                frequent = np.zeros(len(h), bool)
                if len(late):
                    frequent = late[np.minimum(np.searchsorted(late, h), len(late) - 1)] == h
                for flag, chosen in ((_EXACT, ~frequent), (_WINDOW, frequent)):
                    if not chosen.any():
                        continue
                    g, p, s, e = h[chosen], at[chosen], first[chosen], last[chosen]
                    if flag == _WINDOW:
                        n = e - s + 1
                        s = np.repeat(s, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        e, g, p = s, np.repeat(g, n), np.repeat(p, n)
                    name = _hashed(sums, s, e + window)
                    shape = ((p - s) << 8 | (p - e)).astype(np.uint64)
                    a, b = (g, mixed(name + shape)) if flag == _EXACT else (name, mixed(g + shape))
                    parts.append((a, b, pa.repeat(ids[number], len(a)), _place(p, s, e), flag))
            yield _first_of_batch(_batch(ids.type, parts))

    return docs.select("doc_id", "text").mapInArrow(rows, _ROW.format(kind))


def _first_of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Of equal contexts in a batch all but the first are marked as gone, and need no comparison."""
    if not batch.num_rows:
        return batch
    order = pa.compute.sort_indices(
        batch, sort_keys=[("a", "ascending"), ("b", "ascending"), ("doc_id", "ascending"), ("place", "ascending")],
        null_placement="at_start",
    )
    batch = batch.take(order)
    a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
    kind = batch.column("kind").to_numpy().copy()
    again = np.zeros(len(a), bool)
    again[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    kind[again] = _GONE
    # Spread by a random name: nobody looks for these any more.
    spread = np.where(again, mixed(np.arange(len(a), dtype=np.uint64)).view(np.int64), a)
    return pa.RecordBatch.from_arrays(
        [pa.array(spread), batch.column("b"), batch.column("doc_id"), batch.column("place"), pa.array(kind)],
        names=_NAMES,
    )


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by a, b and place: repeats as gone, and first contexts that share their anchor
    with other contexts. Holds one row between batches."""
    last_a = last_b = None
    waiting: pa.RecordBatch | None = None  # the only context so far of the anchor in hand
    several = False
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        kind = batch.column("kind").to_numpy()
        new_a, new_b = np.ones(len(a), bool), np.ones(len(a), bool)
        new_a[1:] = a[1:] != a[:-1]
        new_a[0] = a[0] != last_a
        new_b[1:] = b[1:] != b[:-1]
        new_b[0] = b[0] != last_b
        first = new_a | new_b
        gone = ~first | (kind == _GONE)
        run = np.cumsum(new_a)
        count = np.bincount(run[first], minlength=run[-1] + 1)
        here = count[0]
        count[0] += 0 if new_a[0] else (2 if several else 1)
        shared = first & (count[run] > 1) & (kind == _EXACT)
        out = [_marked(batch, gone, _GONE), _marked(batch, shared, _EXACT)]
        if waiting is not None and not new_a[0] and here:
            out.append(waiting)
        if new_a[0] or here:
            waiting = None
        # The last anchor may go on in the next batch.
        end = run == run[-1]
        several = bool(count[run[-1]] > 1)
        if not several and first[end].any():
            waiting = _marked(batch, end & first & (kind == _EXACT), _EXACT)
        last_a, last_b = a[-1], b[-1]
        yield from (o for o in out if o.num_rows)


def _marked(batch: pa.RecordBatch, rows: np.ndarray, kind: int) -> pa.RecordBatch:
    found = batch.filter(pa.array(rows))
    flags = pa.array(np.full(found.num_rows, kind, np.int32))
    return pa.RecordBatch.from_arrays([*found.columns[:4], flags], names=_NAMES)


def window_classes(texts: list[bytes], offsets: np.ndarray, groups: np.ndarray, window: int) -> list[np.ndarray]:
    """Which windows of the contexts repeat one of an earlier context of the same group.

    ``offsets`` holds the anchor's place in each context; contexts come in order of place. Returns for
    each context a flag per window start.
    """
    heads = offsets % BLOCK  # bytes before the first whole block
    counts = np.array([(len(t) - h) // BLOCK for t, h in zip(texts, heads.tolist(), strict=True)])
    blocks = [np.frombuffer(t, np.uint64, n, h) for t, n, h in zip(texts, counts.tolist(), heads.tolist(), strict=True)]
    _, names = np.unique(np.concatenate(blocks), return_inverse=True)
    starts = np.cumsum(counts + 1) - counts - 1  # one separator behind each context
    symbols = np.zeros(int(counts.sum()) + len(texts), np.int64)
    real = np.ones(len(symbols), bool)
    real[starts + counts] = False
    symbols[real] = names + 1
    suffixes = suffix_array(symbols)
    depth = (window - BLOCK + 1) // BLOCK  # whole blocks that every window has at least
    classes = {d: _classes(symbols, suffixes, d) for d in {depth, depth + 1}}

    width = np.array([len(t) for t in texts]) - window + 1
    owner = np.repeat(np.arange(len(texts)), width)
    at = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
    to_anchor = offsets[owner] - at
    before = to_anchor % BLOCK  # bytes before the window's first whole block
    whole = (window - before) // BLOCK
    block = (at + before - heads[owner]) // BLOCK
    middle = np.zeros(len(at), np.int64)
    for d, found in classes.items():
        own = whole == d
        middle[own] = found[starts[owner[own]] + block[own]]
    behind = window - before - whole * BLOCK
    flat = np.frombuffer(b"".join(texts) + bytes(BLOCK), np.uint8)
    base = np.cumsum([0, *[len(t) for t in texts]])[owner] + at
    edges = np.zeros((2, len(at)), np.uint64)
    for i in range(BLOCK - 1):
        edges[0] += np.where(i < before, flat[base + np.minimum(i, window - 1)].astype(np.uint64) << np.uint64(8 * i), 0).astype(np.uint64)
        tail = base + window - behind + i
        edges[1] += np.where(i < behind, flat[np.minimum(tail, len(flat) - 1)].astype(np.uint64) << np.uint64(8 * i), 0).astype(np.uint64)
    # Equal windows: same group, place to the anchor, middle and edges. The first in order stays.
    order = np.lexsort((np.arange(len(at)), edges[1], edges[0], middle, to_anchor, groups[owner]))
    same = np.ones(len(at), bool)
    same[:1] = False
    for key in (edges[1], edges[0], middle, to_anchor, groups[owner]):
        same[1:] &= key[order][1:] == key[order][:-1]
    repeat = np.zeros(len(at), bool)
    repeat[order] = same
    return np.split(repeat, np.cumsum(width)[:-1])


def _classes(symbols: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """Number of the class of each suffix: neighbours that agree in their first ``depth`` symbols."""
    padded = np.concatenate([symbols, np.full(depth, -1)])
    differs = np.zeros(len(suffixes), bool)
    for i in range(depth):
        row = padded[suffixes + i]
        differs[1:] |= row[1:] != row[:-1]
    out = np.empty(len(suffixes), np.int64)
    out[suffixes] = np.cumsum(differs)
    return out


def _entries(lists: pa.Array, *fields: str) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Where each list of structs begins among all entries (one more at the end), and their fields."""
    counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
    entries = lists.flatten()
    return np.concatenate([[0], np.cumsum(counts)]), tuple(entries.field(f).to_numpy() for f in fields)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of set flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, start, end``: byte spans of the texts that go; they may overlap."""
    own = docs.select("doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    row, span = _ROW.format(kind), f"doc_id {kind}, start bigint, end bigint"
    found = stage(
        anchored(own, window, often_anchors(own, window))
        .repartition("a")
        .sortWithinPartitions("a", "b", "doc_id", "place")
        .mapInArrow(_judged, row)
    )

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, first, last = _unplaced(batch.column("place").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(first), pa.array(last + window)], names=["doc_id", "start", "end"]
            )

    gone = found.where(F.col("kind") == _GONE).select("doc_id", "place").mapInArrow(spans, span)
    open_ = found.where(F.col("kind") == _EXACT)
    tiles = max(1, -(-open_.count() // TILE))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, (a, place) = _entries(batch.column("asked"), "a", "place")
            at, first, last = _unplaced(place)
            texts, fits = [], np.zeros(len(a), bool)
            for i, packed in enumerate(batch.column("packed")):
                text = unpacked(packed.as_py())
                own = slice(bounds[i], bounds[i + 1])
                # One that reaches too far is of another row with this doc_id.
                fits[own] = last[own] + window <= len(text)
                spans = zip(first[own][fits[own]].tolist(), last[own][fits[own]].tolist(), strict=True)
                texts += [text[s : e + window] for s, e in spans]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner[fits])),
                    pa.array(a[fits]),
                    pa.array(place[fits]),
                    pa.array((at - first)[fits]),
                    pa.array(texts, pa.binary()),
                ],
                names=["doc_id", "a", "place", "anchor", "context"],
            )

    def compare(tile: pa.Table) -> pa.Table:
        tile = tile.take(
            pa.compute.sort_indices(
                tile, sort_keys=[("doc_id", "ascending"), ("place", "ascending")], null_placement="at_start"
            )
        )
        texts = tile.column("context").to_pylist()
        flags = window_classes(texts, tile.column("anchor").to_numpy(), tile.column("a").to_numpy(), window)
        _, first, _ = _unplaced(tile.column("place").to_numpy())
        numbers, start, end = [], [], []
        for i, flag in enumerate(flags):
            if flag.any():
                lo, hi = _runs(flag)
                numbers.append(np.full(len(lo), i))
                start.append(lo + first[i])
                end.append(hi + first[i] + window)
        none = [np.zeros(0, np.int64)]
        return pa.table(
            {
                "doc_id": tile.column("doc_id").take(pa.array(np.concatenate(numbers or none))),
                "start": np.concatenate(start or none),
                "end": np.concatenate(end or none),
            }
        )

    asked = open_.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list(F.struct("a", "place")).alias("asked"))
    met = (
        compressed(own)
        .join(stage(asked), F.col("doc_id").eqNullSafe(F.col("_doc")))
        .select("doc_id", "packed", "asked")
        .mapInArrow(cut, f"doc_id {kind}, a bigint, place bigint, anchor bigint, context binary")
        .withColumn("tile", F.pmod(F.xxhash64("a"), F.lit(tiles)))
        .groupBy("tile")
        .applyInArrow(compare, span)
    )
    return gone.unionByName(stage(met))


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    with scratch(docs.sparkSession) as result:
        own = docs.select("doc_id", "text")
        if own.groupBy("doc_id").count().where("count > 1").limit(1).count():
            return result(_by_row(own, window))
        return result(_substring_dedup(own, window))


def _by_row(docs: DataFrame, window: int) -> DataFrame:
    """The same where doc_ids repeat: different rows are put in an order of their own, equal ones are one."""
    digest = [F.xxhash64(F.lit(n), F.coalesce("text", F.lit(""))).alias(f"_{c}") for n, c in enumerate("ab")]
    named = docs.select("doc_id", "text", *digest)
    rows = named.dropDuplicates(["doc_id", "_a", "_b"])
    placed = stage(global_position(rows, "doc_id", "_a", "_b", name="_row"))
    found = _substring_dedup(placed.select(F.col("_row").alias("doc_id"), "text"), window)
    measures = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    keys = placed.select("_row", F.col("doc_id").alias("_doc"), F.col("_a").alias("_x"), F.col("_b").alias("_y"))
    told = stage(found.join(keys, found["doc_id"] == keys["_row"]).select("_doc", "_x", "_y", *measures))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_a") == F.col("_x")) & (F.col("_b") == F.col("_y"))
    return named.drop("text").join(told, same).select("doc_id", *measures)


def _substring_dedup(docs: DataFrame, window: int) -> DataFrame:
    kind = dict(docs.dtypes)["doc_id"]
    spans = stage(
        repeated_spans(docs, window)
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, runs, digest = [], [], [], []
            bounds, (start, end) = _entries(batch.column("spans"), "start", "end")
            for i, packed in enumerate(batch.column("packed")):
                text = unpacked(packed.as_py())
                own = slice(bounds[i], bounds[i + 1])
                kept, n, cuts = remaining(text, start[own], end[own])
                size.append(len(text))
                removed.append(n)
                runs.append(cuts)
                digest.append(hashlib.sha256(kept).hexdigest())
            arrays = [pa.array(x, pa.int64()) for x in (size, removed, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays, pa.array(digest, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return (
        compressed(docs)
        .join(spans, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
        .select("doc_id", "packed", "spans")
        .mapInArrow(cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    )


def remaining(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes outside all spans, how many go, and in how many runs."""
    gone = np.zeros(len(text) + 1, np.int64)
    np.add.at(gone, np.minimum(start, len(text)), 1)
    np.subtract.at(gone, np.minimum(end, len(text)), 1)
    out = np.cumsum(gone)[:-1] > 0
    first, _ = _runs(out)
    return np.frombuffer(text, np.uint8)[~out].tobytes(), int(out.sum()), len(first)
