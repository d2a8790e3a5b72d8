"""Prefix trie of conversations in balanced parentheses, one encoding per shard.

A conversation is the list of its turns' digests. Conversations are range-sorted, so each shard holds a
contiguous part of the trie in depth-first order and encodes it as balanced parentheses. The closing
parenthesis of a node (``findclose`` over a range min-max tree of excess blocks) delimits its subtree;
the rank of leaf pairs ``()`` within it counts leaves, and cumulative arrays over the opening
parentheses give members and savings. Neighbouring shards share the path from the root to where they
were cut, the spine: its nodes come out of both in part, with sums that count every node once (in the
last shard that holds it), and are merged by a grouping. A shard takes at most ``SHARD_TURNS`` turns and
one conversation; what a spine needs of the next shard is that shard's first conversation, which travels
as one extra row.

A task holds one shard, 20 bytes a turn and some hundred per node, and the path of one conversation.
Identical conversations may fill many shards. The ids that end at a spine node are hashed as a stream of
ordered pieces; SHA-256 is sequential, so one task reads a node's ids, but none holds them.

Defined results: null role or text is empty; turns come in order of turn (null first), then role, then
text, and repeated rows are turns of their own; rows with null conv_id belong to no conversation; a
conversation without turns is a member of the root; a table without conversations gives no rows; other
columns are not read. Two turns are the same if 128 bits of hash agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.shared import scratch, stage
from opinara.llm.shingles import mixed

SHARD_TURNS = 1 << 17
BLOCK = 256  # parentheses in a block of the min-max tree
PIECE_IDS = 4096  # ids in a piece of a spine node's list
FAMILY = 5
HEADS = 9


# ---- balanced parentheses --------------------------------------------------------------------


class Parentheses:
    """A balanced sequence (True opens) with ``findclose`` by a range min-max tree over excess blocks."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.n = len(opens)
        self.excess = np.cumsum(np.where(opens, 1, -1))
        blocks = -(-self.n // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[: self.n] = self.excess
        self.cells = padded.reshape(blocks, BLOCK)
        width = 1 << max(0, (blocks - 1).bit_length())
        level = np.full(width, np.iinfo(np.int64).max)
        level[:blocks] = self.cells.min(axis=1)
        levels = [level]  # minima of 1, 2, 4 ... blocks, one after the other
        while len(level) > 1:
            level = level.reshape(-1, 2).min(axis=1)
            levels.append(level)
        self.least = np.concatenate(levels)
        self.from_ = np.cumsum([0, *map(len, levels[:-1])])

    def _block_after(self, block: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first block after ``block`` whose least excess is at most ``goal``; there is one."""
        at, height = block + 1, np.zeros(len(block), np.int64)
        active = np.ones(len(block), bool)
        while True:  # up and to the right while nothing is low enough
            active &= self.least[self.from_[height] + at] > goal
            if not active.any():
                break
            at[active] += 1
            even = active & (at % 2 == 0)
            at[even] //= 2
            height[even] += 1
        while height.any():  # down to the first such block
            lower = np.flatnonzero(height)
            height[lower] -= 1
            at[lower] *= 2
            at[lower] += self.least[self.from_[height[lower]] + at[lower]] > goal[lower]
        return at

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at ``at`` are closed: the next place of an excess one less."""
        goal = self.excess[at] - 1
        block = at // BLOCK
        out = np.full(len(at), -1, np.int64)
        step = max(1, (1 << 22) // BLOCK)
        places = np.arange(BLOCK)

        def look(which: np.ndarray, blocks: np.ndarray, after: np.ndarray) -> None:
            for lo in range(0, len(which), step):
                w = which[lo : lo + step]
                b = blocks[lo : lo + step]
                hit = (self.cells[b] <= goal[w][:, None]) & (places > after[lo : lo + step][:, None])
                first = hit.argmax(axis=1)
                found = hit[np.arange(len(w)), first]
                out[w[found]] = b[found] * BLOCK + first[found]

        every = np.arange(len(at))
        look(every, block, at % BLOCK)
        rest = np.flatnonzero(out < 0)
        if len(rest):
            look(rest, self._block_after(block[rest], goal[rest]), np.full(len(rest), -1))
        return out


def _prefix_names(a: np.ndarray, b: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple:
    """128-bit names of all prefixes: sums of the turns' hashes, each mixed with its depth."""
    depth = np.arange(len(a)) - np.repeat(starts, lens) + 1
    out = []
    for x, salt in ((a, 0x9E3779B97F4A7C15), (b, 0xC2B2AE3D27D4EB4F)):
        place = mixed(depth.astype(np.uint64) * np.uint64(salt))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(x.view(np.uint64) ^ place))])
        out.append((sums[1:] - np.repeat(sums[starts], lens)).view(np.int64))
    return out[0], out[1], depth


SCHEMA = (
    "depth bigint, a bigint, b bigint, up_a bigint, up_b bigint, spine boolean, under_spine boolean, "
    "conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "weight bigint, own bigint, ends_sha256 string, piece bigint, ends binary"
)
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def shard_nodes(
    ids: np.ndarray, lens: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, shared: int, number: int
) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard's trie, from its sorted conversations.

    ``ids`` and ``lens`` per conversation; ``a, b, size`` (digest, bytes) per turn. ``shared`` is how many
    turns the shard's last conversation has in common with the next shard's first, -1 for the last shard.
    """
    m = len(ids)
    ends = np.cumsum(lens)
    starts = ends - lens
    name_a, name_b, depth_at = _prefix_names(a, b, starts, lens)

    # Turns in common with the conversation before, a new node for each turn beyond.
    common = np.zeros(m, np.int64)
    both = np.minimum(lens[1:], lens[:-1])
    total = int(both.sum())
    if total:
        base = np.cumsum(both) - both
        offset = np.arange(total) - np.repeat(base, both)
        left = np.repeat(starts[:-1], both) + offset
        right = np.repeat(starts[1:], both) + offset
        differs = (a[left] != a[right]) | (b[left] != b[right])
        first = np.full(m - 1, -1, np.int64)
        where = np.flatnonzero(differs)
        owner = np.repeat(np.arange(m - 1), both)[where]
        first[owner[::-1]] = offset[where][::-1]
        common[1:] = np.where(first >= 0, first, both)
    fresh = lens - common
    fresh_end = np.cumsum(fresh)
    turn = np.repeat(starts + common - (fresh_end - fresh), fresh) + np.arange(int(fresh_end[-1]))
    n = 1 + len(turn)  # node 0 is the root
    depth = np.concatenate([[0], depth_at[turn]])
    node_a, node_b = np.concatenate([[0], name_a[turn]]), np.concatenate([[0], name_b[turn]])
    node_size = np.concatenate([[0], size[turn]])

    # The parentheses: before a conversation's new turns, those it does not share are closed.
    closes = np.concatenate([[0], lens[:-1] - common[1:]])
    runs = np.stack([closes, fresh], axis=1).ravel()
    kinds = np.tile([False, True], m)
    opens = np.concatenate([[True], np.repeat(kinds, runs), np.zeros(int(lens[-1]) + 1, bool)])
    tree = Parentheses(opens)
    opened = np.flatnonzero(opens)
    close = tree.findclose(opened)
    last = np.arange(n) + (close - opened + 1) // 2  # one after the last node of the subtree

    # Members: the conversations between a node's first and the end of its subtree.
    first_row = np.concatenate([[0], np.repeat(np.arange(m), fresh)])
    end_row = np.append(first_row, m)[last]
    n_convs = end_row - first_row
    cuts = np.stack([first_row, end_row], axis=1).ravel()
    smallest = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), cuts)[::2]

    order = np.lexsort((np.arange(n), depth))
    ranked = depth[order] * n + order
    up = order[np.maximum(np.searchsorted(ranked, (depth - 1) * n + np.arange(n)) - 1, 0)]

    # Spines: nodes that the shard before or after may hold too. Those that go on count there.
    spine = np.zeros(n, bool)
    spine[first_row == 0] = True
    spine[0] = True
    final = end_row == m
    spine |= final
    counted = ~(final & (depth <= shared))
    leaf = ~opens[opened + 1]
    children = np.bincount(up[1:], weights=counted[1:], minlength=n).astype(np.int64)

    def subtree(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[last] - sums[:-1]

    n_leaves = subtree(leaf & counted)
    weight = subtree(n_convs * node_size)
    own = subtree(node_size * counted)

    # A conversation ends at its last new node, or at the one before's if both are the same.
    begin = np.searchsorted(fresh_end, np.arange(n), "left")
    until = np.searchsorted(fresh_end, np.arange(n), "right")
    text = [b"%d" % i for i in ids.tolist()]
    empty = hashlib.sha256(b"").hexdigest()
    digests = [empty] * n
    for k in np.flatnonzero((until > begin) & ~spine).tolist():
        digests[k] = hashlib.sha256(b",".join(text[begin[k] : until[k]])).hexdigest()

    def batch(rows: np.ndarray, pieces=None, lists=None) -> pa.RecordBatch:
        plain = [
            depth, node_a, node_b, node_a[up], node_b[up], spine, spine[up], smallest, smallest[up],
            n_convs, children, n_leaves, weight, own,
        ]
        arrays = [pa.array(x[rows]) for x in plain]
        arrays.append(pa.array([digests[k] for k in rows.tolist()], pa.string()))
        arrays.append(pa.array([number << 10] * len(rows) if pieces is None else pieces, pa.int64()))
        arrays.append(pa.array([None] * len(rows) if lists is None else lists, pa.binary()))
        return pa.RecordBatch.from_arrays(arrays, names=_NAMES)

    step = 1 << 16
    for lo in range(0, n, step):
        yield batch(np.arange(lo, min(n, lo + step)))
    for k in np.flatnonzero(spine & (until > begin)).tolist():
        for i, lo in enumerate(range(int(begin[k]), int(until[k]), PIECE_IDS)):
            piece = b",".join(text[lo : min(lo + PIECE_IDS, int(until[k]))])
            yield batch(np.array([k]), [(number << 10) + i], [piece])


# ---- the Spark job ---------------------------------------------------------------------------


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as digest ``a, b`` and ``size`` in bytes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turn = F.struct(
        F.row_number().over(order).alias("at"),
        F.xxhash64(F.lit(1), "role", "text").alias("a"),
        F.xxhash64(F.lit(2), "role", "text").alias("b"),
        F.octet_length("text").alias("size"),
    )
    lists = rows.select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("turn")).alias("turns")
    )
    return lists.select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["size"].alias("size"))).alias("turns")
    )


def family_rebuilt(lists: DataFrame) -> DataFrame:
    """Conversation c with its first ``crc32(c) % 9`` turns taken from conversation ``c - c % 5``."""
    heads = lists.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("_head"), F.slice("turns", 1, HEADS - 1).alias("_turns")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    joined = lists.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("_head"), "left")
    head = F.when(h > 0, F.slice("_turns", F.lit(1), h))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    none = F.slice("turns", 1, 0)
    return joined.select("conv_id", F.concat(F.coalesce(head, none), rest).alias("turns"))


def _common(turns: pa.StructArray, other: pa.StructArray) -> int:
    n = min(len(turns), len(other))
    same = np.ones(n, bool)
    for lane in ("a", "b"):
        same &= turns.field(lane).to_numpy()[:n] == other.field(lane).to_numpy()[:n]
    return n if same.all() else int(same.argmin())


def _encode_shards(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, pa.ListArray]] = []  # conversations of the open shard
        turns = 0
        number = -1  # of the partition the rows come from
        cuts = 0

        def closed(following: pa.StructArray | None) -> Iterator[pa.RecordBatch]:
            nonlocal turns, cuts
            if held:
                ids = np.concatenate([i for i, _ in held])
                lists = pa.concat_arrays([t for _, t in held])
                flat = lists.flatten()
                lens = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                shared = -1 if following is None else _common(lists[-1].values, following)
                lanes = [flat.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("a", "b", "size")]
                yield from shard_nodes(ids, lens, *lanes, shared, (number << 20) + cuts)
                held.clear()
            turns = 0
            cuts += 1

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            border = batch.column("border").to_numpy(zero_copy_only=False)
            lists = batch.column("turns")
            ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy()
            lo = 0
            while lo < batch.num_rows:
                if border[lo]:  # the first conversation of the next shard, or nothing
                    yield from closed(lists[lo].values if lists[lo].is_valid else None)
                    lo += 1
                    continue
                if shard[lo] != number:
                    number, cuts = int(shard[lo]), 0
                if turns >= limit:
                    yield from closed(lists[lo].values)
                # As many rows as fit, up to the next border; one at least.
                stop = np.flatnonzero(border[lo:])
                hi = lo + int(stop[0]) if len(stop) else batch.num_rows
                fits = lo + max(1, int(np.searchsorted(ends[lo + 1 : hi + 1] - ends[lo], limit - turns, "right")))
                hi = min(hi, fits)
                held.append((ids[lo:hi].astype(np.int64), lists.slice(lo, hi - lo)))
                turns += int(ends[hi] - ends[lo]) + (hi - lo)
                lo = hi
        if held:  # every shard ends with its border row
            raise RuntimeError("a shard without an end")

    return run


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come one after the other in order."""
    node, state = None, None
    names = ["depth", "a", "b", "digest"]

    def row() -> pa.RecordBatch:
        arrays = [pa.array([x], pa.int64()) for x in node] + [pa.array([state.hexdigest()])]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in names[:3]], strict=True)
        for key, piece in zip(keys, batch.column("ends").to_pylist(), strict=True):
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    yield row()
                node, state = key, hashlib.sha256()
            state.update(piece)
    if node is not None:
        yield row()


def trie_nodes(lists: DataFrame, shard_turns: int | None = None) -> DataFrame:
    """One row per node of the trie of ``conv_id, turns``, see :func:`conversation_trie`."""
    limit = shard_turns or SHARD_TURNS
    spark = lists.sparkSession
    with scratch(spark, arrow_rows=2000) as result:
        whole = stage(lists)
        n = whole.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
        shards = max(1, -(-n // limit))
        # The shard is written down, so that it holds however the table is read again.
        placed = stage(
            whole.repartitionByRange(shards, "turns", "conv_id").withColumn("shard", F.spark_partition_id())
        )
        # A shard's end: the first conversation of the next one. As many rows as shards.
        firsts = placed.groupBy("shard").agg(F.min("turns").alias("first"))
        ahead = F.lead("first").over(Window.orderBy("shard"))
        borders = firsts.select(
            F.lit(None).cast("bigint").alias("conv_id"), ahead.alias("turns"), "shard", F.lit(True).alias("border")
        )
        rows = placed.withColumn("border", F.lit(False)).unionByName(borders)
        sorted_rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", "border", "turns", "conv_id")
        parts = stage(sorted_rows.mapInArrow(_encode_shards(limit), SCHEMA))

        node = ["depth", "a", "b"]
        measures = ["n_convs", "n_children", "n_leaves", "weight", "own"]
        pieces = parts.where("ends IS NOT NULL").select(*node, "piece", "ends")
        digests = (
            pieces.repartition(*node)
            .sortWithinPartitions(*node, "piece")
            .mapInArrow(_digest_pieces, "depth bigint, a bigint, b bigint, digest string")
        )
        spines = (
            parts.where("spine AND ends IS NULL")
            .groupBy(*node)
            .agg(
                F.any_value("up_a").alias("up_a"),
                F.any_value("up_b").alias("up_b"),
                F.min("conv_id").alias("conv_id"),
                *[F.sum(m).alias(m) for m in measures],
            )
        )
        # A leaf that goes on in the next shard is counted where it ends, like every other node.
        spines = stage(spines.join(digests, node, "left"))
        ends = F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256")
        ups = spines.select(
            F.col("depth").alias("_depth"), F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("conv_id").alias("_up")
        )
        under = F.expr("depth - 1 = _depth AND up_a = _a AND up_b = _b")
        columns = ["conv_id", "depth", "parent_conv_id", *measures, "ends_sha256"]
        inner = parts.where("NOT spine AND NOT under_spine").select(*columns)
        hung = parts.where("NOT spine AND under_spine").drop("parent_conv_id").join(ups, under)
        merged = spines.withColumn("ends_sha256", ends).join(ups, under, "left")
        beside = [f.withColumn("parent_conv_id", F.col("_up")).select(*columns) for f in (hung, merged)]
        nodes = inner.unionByName(beside[0]).unionByName(beside[1])
        saved: Column = F.col("weight") - F.col("own")
        return result(
            nodes.select(
                "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                saved.alias("saved_tokens"), "ends_sha256",
            )
        )


def conversation_trie(conversations: DataFrame, shard_turns: int | None = None) -> DataFrame:
    """The trie of all conversations as they are.

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves``,
    ``saved_tokens`` (over the subtree, each node's other members times its last text's bytes) and
    ``ends_sha256`` (ids that end there). ``conv_id`` and ``depth`` name a node.
    """
    return trie_nodes(turn_lists(conversations), shard_turns)


def family_trie(conversations: DataFrame, shard_turns: int | None = None) -> DataFrame:
    """:func:`conversation_trie` of the conversations rebuilt by :func:`family_rebuilt`."""
    with scratch(conversations.sparkSession) as result:
        lists = stage(turn_lists(conversations))
        return result(trie_nodes(family_rebuilt(lists), shard_turns))
