"""Packing documents into fixed-length token sequences by Karmarkar-Karp differencing.

A document's ids end with one separator. Whole sequences are cut off first; what remains is cut into
pieces of at most ``PIECE`` ids. Pieces gather in tiles of ``TILE`` sequences, and a tile is divided
by multiway differencing: the two partial partitions with the largest spread are merged, the fullest
window of one with the emptiest of the other, until one is left with near-equal windows. If a window
exceeds the capacity, the tile is divided again into one window more.

A task packs what it reads and holds one tile of piece descriptions, no ids; nothing is shuffled, and
a task that runs again gives the same sequences.

Defined results: null or empty text is its separator alone; every row is a document of its own, also
if doc_ids repeat or are null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

LENGTH = 2048
PIECE = 256
TILE = 128
BATCH_ROWS = 500  # texts that are held as Python strings at a time
SEPARATOR = 1
# Fixed value: the string that the vocabulary keeps one id for.
END = "<|endoftext|>"


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str):
    """The byte-level tokenizer of a ranks file; the id behind the ranks ends a text where it says so itself."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={END: len(ranks)})


def divide(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: items (by place) divided into windows of near-equal sums."""
    # A partial partition: its sums, largest first, less their minimum; for each a node of items.
    left: list[int] = list(range(len(sizes)))
    right: list[int] = [-1] * len(sizes)
    heap = [(-s, i, np.array([s], np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a, at = heapq.heappop(heap)
        _, _, b, bt = heapq.heappop(heap)
        b, bt = b[::-1], bt[::-1]  # smallest first
        met = max(0, len(a) + len(b) - windows)
        cut = len(a) - met
        nodes = []
        for x, y in zip(at[cut:].tolist(), bt[:met].tolist(), strict=True):
            nodes.append(len(left))
            left.append(x)
            right.append(y)
        sums = np.concatenate([a[:cut], a[cut:] + b[:met], b[met:]])
        ids = np.concatenate([at[:cut], np.array(nodes, np.int64), bt[met:]])
        order = np.argsort(-sums, kind="stable")
        sums, ids = sums[order], ids[order]
        if len(sums) == windows:
            sums = sums - sums[-1]
        number += 1
        heapq.heappush(heap, (-int(sums[0]), number, sums, ids))
    out = []
    for node in heap[0][3].tolist() if heap else []:
        items, todo = [], [node]
        while todo:
            n = todo.pop()
            if right[n] < 0:
                items.append(left[n])
            else:
                todo += [right[n], left[n]]
        out.append(items)
    return out


def pack(sizes: list[int], length: int = LENGTH) -> list[list[int]]:
    """The fewest windows from the sum upwards that differencing fills without exceeding ``length``."""
    windows = max(1, -(-sum(sizes) // length))
    while True:
        found = divide(sizes, windows)
        if all(sum(sizes[i] for i in w) <= length for w in found):
            return found
        windows += 1


SCHEMA = (
    "doc_id {0}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def packed(
    docs: DataFrame, ranks_path: str, pattern: str, length: int = LENGTH, tile: int = TILE
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    kind = dict(docs.dtypes)["doc_id"]
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, pattern).encode_to_numpy
        sequence = TaskContext.get().partitionId() << 32
        whole: list[tuple] = []
        waiting: list[tuple] = []
        held = 0
        id_type = pa.int64()

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [()] * 7
            arrays = [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:]]]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def divided() -> list[tuple]:
            nonlocal sequence
            out = []
            for window in pack([p[2] for p in waiting], length):
                offset = 0
                for i in sorted(window):
                    out.append((*waiting[i], sequence, offset))
                    offset += waiting[i][2]
                sequence += 1
            waiting.clear()
            return out

        for batch in (b.slice(lo, BATCH_ROWS) for b in batches for lo in range(0, max(1, b.num_rows), BATCH_ROWS)):
            id_type = batch.schema.field("doc_id").type
            texts = batch.column("text").to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.append(encode(text or "", allowed_special="all"), SEPARATOR).astype("<u4")
                n, start = len(ids), 0
                while start < n:
                    size = length if n - start >= length else min(PIECE, n - start)
                    piece = (doc_id, start, size, zlib.crc32(ids[start : start + size]), n)
                    if size == length:
                        whole.append((*piece, sequence, 0))
                        sequence += 1
                    else:
                        waiting.append(piece)
                        held += size
                    start += size
                if held >= tile * length - length // 2:
                    yield rows(whole + divided())
                    whole.clear()
                    held = 0
        yield rows(whole + (divided() if waiting else []))

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA.format(kind))
