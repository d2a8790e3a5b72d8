"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its ``NEAREST`` most similar reference points out of a number that grows with
the square root of the table. Inverted lists hold, per label and pivot, the vectors that have it among
theirs. Two vectors are candidates if they share at least ``SHARED`` pivots; they then meet in one of
the lists of their first ``NEAREST - SHARED + 1`` pivots by number, so only those are built, and a pair
is looked at in the list of its first shared pivot only. Candidates are verified by their cosine.

A list of m vectors is compared in blocks of at most ``BLOCK``, spread over tasks; a block returns one
row per linked vector (its number of links, and the least vector it hangs together with there), never
pairs. Reference points are fixed random directions, so nothing is fitted and every row is indexed.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those
without label, link with nothing; vectors of different lengths are not compared; rows that repeat a
vec_id are vectors of their own; a component has its smallest vec_id, null ids aside; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.shared import components, scratch, stage

THRESHOLD = 0.98
NEAREST = 8
SHARED = 3
BLOCK = 512
FEWEST, MOST = 64, 1 << 16


def pivot_count(rows: int) -> int:
    """About twice the square root of the table's rows, in powers of two."""
    return min(MOST, max(FEWEST, 1 << (2 * int(rows**0.5)).bit_length()))


@lru_cache(maxsize=4)
def pivots(count: int, dim: int) -> np.ndarray:
    """Reference points: fixed random unit vectors."""
    points = np.random.default_rng([42, dim]).standard_normal((count, dim))
    return (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)


def nearest_pivots(unit: np.ndarray, count: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, smallest number first."""
    out = []
    for lo in range(0, len(unit), 1024):
        likeness = unit[lo : lo + 1024].astype(np.float32) @ pivots(count, unit.shape[1]).T
        out.append(np.sort(np.argpartition(-likeness, NEAREST, axis=1)[:, :NEAREST], axis=1))
    return np.concatenate(out).astype(np.int32)


def described(vectors: DataFrame, count: int) -> DataFrame:
    """``row, label, dim, tops, unit`` of the vectors that can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_dim: dict[int, list[int]] = {}
            lists = batch.column("embedding").to_pylist()
            for i, v in enumerate(lists):
                if v and None not in v:
                    by_dim.setdefault(len(v), []).append(i)
            for dim, places in by_dim.items():
                x = np.array([lists[i] for i in places], np.float64)
                with np.errstate(all="ignore"):
                    scale = np.abs(x).max(axis=1)  # keeps the squares of very large numbers finite
                    x = x / scale[:, None]
                    unit = x / np.linalg.norm(x, axis=1)[:, None]
                good = np.isfinite(scale) & (scale > 0) & np.isfinite(unit).all(axis=1)
                if not good.any():
                    continue
                unit, at = unit[good], pa.array(np.array(places)[good])
                tops = nearest_pivots(unit, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").take(at),
                        batch.column("label").take(at),
                        pa.array(np.full(len(unit), dim, np.int32)),
                        pa.array(tops.tolist(), pa.list_(pa.int32())),
                        pa.array([u.tobytes() for u in unit], pa.binary()),
                    ],
                    names=["row", "label", "dim", "tops", "unit"],
                )

    kind = dict(vectors.dtypes)["label"]
    return vectors.where("label IS NOT NULL AND embedding IS NOT NULL").mapInArrow(
        run, f"row bigint, label {kind}, dim int, tops array<int>, unit binary"
    )


def _matches(tops: np.ndarray, pivot: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pivots each vector has, as a table, and which of the table's columns come before one."""
    kinds, column = np.unique(tops, return_inverse=True)
    table = np.zeros((len(tops), len(kinds)), np.float32)
    table[np.arange(len(tops))[:, None], column.reshape(tops.shape)] = 1
    return table, kinds < pivot


def compared(tile: pa.Table) -> pa.Table:
    """``row, links, root`` for the linked vectors of one tile: two blocks of a list, or one with itself."""
    rows, side = tile.column("row").to_numpy(), tile.column("side").to_numpy()
    tops = np.array(tile.column("tops").to_pylist(), np.int32)
    unit = np.stack([np.frombuffer(u) for u in tile.column("unit").to_pylist()])
    table, before = _matches(tops, tile.column("pivot")[0].as_py())
    one = tile.column("i")[0].as_py() == tile.column("j")[0].as_py()
    a = np.arange(len(rows)) if one else np.flatnonzero(side == 0)
    b = np.arange(len(rows)) if one else np.flatnonzero(side == 1)
    near = (table[a] @ table[b].T >= SHARED) & (table[a][:, before] @ table[b][:, before].T == 0)
    near &= unit[a] @ unit[b].T >= THRESHOLD
    if one:
        np.fill_diagonal(near, False)
    links, root = np.zeros(len(rows), np.int64), rows.copy()
    links[a] += near.sum(axis=1)
    if not one:
        links[b] += near.sum(axis=0)
    far = np.iinfo(np.int64).max
    while near.any():
        last = root.copy()
        root[a] = np.minimum(root[a], np.where(near, root[b][None, :], far).min(axis=1))
        root[b] = np.minimum(root[b], np.where(near, root[a][:, None], far).min(axis=0))
        if (root == last).all():
            break
    linked = links > 0
    return pa.table({"row": rows[linked], "links": links[linked], "root": root[linked]})


def near_vectors(vectors: DataFrame) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    with scratch(vectors.sparkSession) as result:
        return result(_near_vectors(vectors))


def _near_vectors(vectors: DataFrame) -> DataFrame:
    numbered = stage(
        vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "embedding")
    )
    index = stage(described(numbered.select("row", "label", "embedding"), pivot_count(numbered.count())))
    first = F.slice("tops", 1, NEAREST - SHARED + 1)
    posted = index.select("row", "label", "dim", F.explode(first).alias("pivot"))
    lists = stage(
        posted.groupBy("label", "dim", "pivot").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    )
    own = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    entries = (
        index.withColumn("pivot", F.explode(first))
        .join(lists.select("label", "dim", "pivot", "blocks"), ["label", "dim", "pivot"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "label", "dim", "pivot", "row", "tops", "unit",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )
    found = stage(
        entries.groupBy("label", "dim", "pivot", "i", "j").applyInArrow(
            compared, "row bigint, links bigint, root bigint"
        )
    )
    links = found.groupBy("row").agg(F.sum("links").alias("links")).withColumnRenamed("row", "_row")
    joined = stage(components(found.select(F.col("row").alias("a"), F.col("root").alias("b"))))
    placed = stage(
        numbered.select("row", "vec_id")
        .join(joined, F.col("row") == F.col("node"), "left")
        .join(links, F.col("row") == F.col("_row"), "left")
        .select("row", "vec_id", F.coalesce("component", "row").alias("root"), F.coalesce("links", F.lit(0)).alias("n_links"))
    )
    least = stage(placed.groupBy("root").agg(F.min("vec_id").alias("component_id")))
    return placed.join(least, "root").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
