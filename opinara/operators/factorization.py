"""Alternating least squares in staged rounds, which a stopped job takes up again.

A round solves all users for the present items, then all items for the new users. The ratings of a side
are dealt, in order of its ids, into chunks of bounded size that stay where they are (kept partitioned,
so no round moves them); a round sends each chunk the factors of the other side that it needs, each once.
An id that lies within its chunk is solved there. One that spans several sums its normal equations
per chunk first, then per group of chunks, and is solved from the sums, so an id may hold any share of
the ratings. Both halves of a round are written down; the next one reads them.

The fit stops when the users' factors stand still: when their change over a round is at most
``tolerance`` of their length, or after ``iters`` rounds. Regularization is weighted by an id's number of ratings.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from opinara.session import is_written, removed, shared_dir, written

TOLERANCE = 1e-4
CHUNK_RATINGS = 1 << 18
CHUNK_BYTES = 1 << 27  # of the other side's factors that a chunk may need
FAN = 256  # sums of normal equations that meet in one step
_SOLVED = "id int, features array<float>, sums binary, part int"


@dataclass
class Factors:
    """What a fit gives: ``id, features`` of both sides, and ``round, change`` of every round."""

    userFactors: DataFrame
    itemFactors: DataFrame
    rank: int
    history: DataFrame

    def transform(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``prediction``; null where the user or the item is unknown."""
        users, items = (
            f.select(F.col("id").alias(f"_{s}"), F.col("features").alias(f"_{s}_features"))
            for f, s in ((self.userFactors, "user"), (self.itemFactors, "item"))
        )
        both = pairs.join(users, F.col("user") == F.col("_user"), "left").join(items, F.col("item") == F.col("_item"), "left")
        products = F.zip_with("_user_features", "_item_features", lambda x, y: x.cast("double") * y)
        dot = F.aggregate(products, F.lit(0.0), lambda s, x: s + x)
        return both.withColumn("prediction", dot.cast("float")).drop("_user", "_item", "_user_features", "_item_features")


def initial_factors(ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """``id, features``: unit vectors drawn by hash, the same on every run."""
    draws = F.transform(
        F.sequence(F.lit(1), F.lit(rank)), lambda k: F.xxhash64("id", k, F.lit(seed)).cast("double") / float(1 << 63)
    )
    length = F.sqrt(F.aggregate("draws", F.lit(0.0), lambda s, x: s + x * x))
    return ids.select("id", draws.alias("draws")).select(
        "id", F.transform("draws", lambda x: (x / length).cast("float")).alias("features")
    )


def deal(
    ratings: DataFrame, own: str, other: str, size: int, total: int, folder: str
) -> tuple[DataFrame, DataFrame, int]:
    """Ratings of a side in chunks of about ``size``, which ids of the other side each chunk needs, and how
    many chunks there are. ``split`` marks ids that span chunks. The chunks are kept partitioned."""
    n = max(1, -(-total // size))
    rows = ratings.select(F.col(own).alias("id"), F.col(other).alias("other"), "rating")
    placed = written(
        rows.repartitionByRange(n, "id", "other").withColumn("chunk", F.spark_partition_id()), f"{folder}/by_{own}"
    )
    spans = placed.groupBy("id").agg(F.min("chunk").alias("_from"), F.max("chunk").alias("_to")).where("_from < _to")
    split = spans.select(F.col("id").alias("_id"))
    flagged = placed.join(split, F.col("id") == F.col("_id"), "left").select(
        "chunk", "id", "other", "rating", F.col("_id").isNotNull().alias("split")
    )
    flagged = written(flagged, f"{folder}/flagged_{own}")
    needs = written(flagged.select("chunk", "other").distinct(), f"{folder}/needs_{own}")
    partitions = min(n, 4 * ratings.sparkSession.sparkContext.defaultParallelism)
    kept = flagged.repartition(partitions, "chunk").sortWithinPartitions("chunk").persist(StorageLevel.MEMORY_AND_DISK)
    return kept, needs, n


def _normal(vectors: np.ndarray, ratings: np.ndarray) -> np.ndarray:
    """Packed normal equations of one id: upper triangle, right side, number of ratings."""
    rank = vectors.shape[1]
    square = vectors.T @ vectors
    return np.concatenate([square[np.triu_indices(rank)], vectors.T @ ratings, [len(ratings)]])


def _solve(sums: np.ndarray, rank: int, reg: float) -> np.ndarray:
    """Factors from packed normal equations, one row each."""
    square = np.zeros((len(sums), rank, rank))
    upper = np.triu_indices(rank)
    width = len(upper[0])
    square[:, upper[0], upper[1]] = sums[:, :width]
    square[:, upper[1], upper[0]] = sums[:, :width]
    square[:, np.arange(rank), np.arange(rank)] += reg * sums[:, -1:]
    return np.linalg.solve(square, sums[:, width : width + rank, None])[:, :, 0]


def _rows(ids: np.ndarray, features: np.ndarray, sums: list[bytes | None], part: int) -> pa.Table:
    n = len(ids)
    lists = [f.tolist() for f in features] if len(features) else [None] * n
    return pa.table(
        {
            "id": pa.array(ids, pa.int32()),
            "features": pa.array(lists, pa.list_(pa.float32())),
            "sums": pa.array(sums, pa.binary()),
            "part": pa.array([part] * n, pa.int32()),
        }
    )


def _chunk_solver(rank: int, reg: float):
    def solve(key: tuple, ratings: pa.Table, factors: pa.Table) -> pa.Table:
        ids = ratings.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        other = ratings.column("other").to_numpy()[order]
        value = ratings.column("rating").to_numpy()[order].astype(np.float64)
        split = ratings.column("split").to_numpy()[order].astype(bool)
        known = factors.column("other").to_numpy()
        flat = factors.column("features").combine_chunks()
        matrix = flat.flatten().to_numpy().reshape(len(known), rank).astype(np.float64)
        place = np.argsort(known)
        at = place[np.searchsorted(known[place], other)]
        begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        end = np.append(begin[1:], len(ids))
        sums = np.array([_normal(matrix[at[b:e]], value[b:e]) for b, e in zip(begin.tolist(), end.tolist(), strict=True)])
        whole = ~split[begin]
        part = int(key[0].as_py()) // FAN
        parts = [_rows(ids[begin[~whole]], np.zeros((0, rank)), [s.tobytes() for s in sums[~whole]], part)]
        if whole.any():
            parts.append(_rows(ids[begin[whole]], _solve(sums[whole], rank, reg), [None] * int(whole.sum()), part))
        return pa.concat_tables(parts)

    return solve


def _sum_solver(rank: int, reg: float, last: bool):
    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s, np.float64) for s in table.column("sums").to_pylist())
        ids, part = table.column("id").to_numpy()[:1], table.column("part")[0].as_py() // FAN
        if last:
            return _rows(ids, _solve(total[None, :], rank, reg), [None], part)
        return _rows(ids, np.zeros((0, rank)), [total.tobytes()], part)

    return add


def _half(chunks: DataFrame, needs: DataFrame, factors: DataFrame, n: int, rank: int, reg: float, path: str) -> DataFrame:
    """``id, features`` of one side, solved for the other side's."""
    sent = needs.join(factors, F.col("other") == F.col("id")).select("chunk", "other", "features")
    solved = chunks.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(_chunk_solver(rank, reg), _SOLVED)
    if n == 1:
        return written(solved.select("id", "features"), path)
    solved = written(solved, f"{path}-parts")
    parts, levels = solved.where("sums IS NOT NULL"), 1
    while FAN**levels < n:
        parts = parts.groupBy("id", "part").applyInArrow(_sum_solver(rank, reg, False), _SOLVED)
        levels += 1
    spanning = parts.groupBy("id").applyInArrow(_sum_solver(rank, reg, True), _SOLVED)
    whole = solved.where("sums IS NULL").select("id", "features")
    out = written(whole.unionByName(spanning.select("id", "features")), path)
    removed(factors.sparkSession, f"{path}-parts")
    return out


def _change(now: DataFrame, before: DataFrame) -> float:
    """Length of the change of all factors, as a share of their length."""
    old = before.select(F.col("id").alias("_id"), F.col("features").alias("_old"))

    def squares(x):
        return F.aggregate(x, F.lit(0.0), lambda s, y: s + y.cast("double") * y)

    moved = squares(F.zip_with("features", F.coalesce("_old", F.col("features")), lambda x, y: x - y))
    known = now.join(old, F.col("id") == F.col("_id"), "left")
    row = known.agg(F.sum(F.when(F.col("_old").isNull(), squares(F.col("features"))).otherwise(moved)), F.sum(squares(F.col("features")))).first()
    return float(np.sqrt(row[0] / row[1])) if row[1] else 0.0


def fit_rounds(
    ratings: DataFrame,
    rank: int = 10,
    reg: float = 0.1,
    iters: int = 1000,
    seed: int = 99,
    tolerance: float = TOLERANCE,
    folder: str | None = None,
    chunk_ratings: int | None = None,
) -> Factors:
    """Factors of ``user, item, rating`` (rows with a null are left out, repeated pairs count again).

    With ``folder`` the rounds are kept there, and a fit that was stopped goes on after the last round that
    is written to its end; it must be called with the same ratings, rank and regularization. Rounds before the last
    two are removed.
    """
    spark = ratings.sparkSession
    folder = (folder or f"{shared_dir(spark).rstrip('/')}/factors-{uuid.uuid4().hex}").rstrip("/")
    data = ratings.na.drop(subset=["user", "item", "rating"]).select(
        F.col("user").cast("int"), F.col("item").cast("int"), F.col("rating").cast("double")
    )
    data = written(data, f"{folder}/ratings")
    total = data.count()
    size = chunk_ratings or max(1, min(CHUNK_RATINGS, CHUNK_BYTES // (8 * rank)))
    users, for_users, n = deal(data, "user", "item", size, total, folder)
    items, for_items, _ = deal(data, "item", "user", size, total, folder)

    def path(side: str, number: int) -> str:
        return f"{folder}/{side}-{number:05d}"

    def read(side: str, number: int) -> DataFrame:
        return spark.read.schema("id int, features array<float>").parquet(path(side, number))

    # The rounds before the last two are gone.
    done = max((k for k in range(1, iters + 1) if is_written(spark, path("items", k))), default=0)
    if done:
        u, v = read("users", done), read("items", done)
    else:
        u = None
        v = written(initial_factors(data.select(F.col("item").alias("id")).distinct(), rank, seed), path("items", 0))
    changes: list[tuple[int, float | None]] = []
    try:
        while done < iters and total:
            before = u
            u = _half(users, for_users, v, n, rank, reg, path("users", done + 1))
            v = _half(items, for_items, u, n, rank, reg, path("items", done + 1))
            done += 1
            change = _change(u, before) if before is not None else None
            changes.append((done, change))
            removed(spark, path("users", done - 2), path("items", done - 2))
            if change is not None and change <= tolerance:
                break
    finally:
        users.unpersist()
        items.unpersist()
    if u is None:
        u = v.select("id", "features").limit(0)
    return Factors(u, v, rank, spark.createDataFrame(changes, "round int, change double"))


def normal_residual(ratings: DataFrame, model: Factors, reg: float, side: str = "user") -> DataFrame:
    """``id, n_ratings, sse, residual``: how far each id of a side is from solving its equations.

    ``residual`` is the length of the gradient ``sum((u.v - r) v) + reg n u`` as a share of the length of
    ``sum(r v)``; ``sse`` the summed squared error of its ratings.
    """
    other = "item" if side == "user" else "user"
    own, far = (model.userFactors, model.itemFactors) if side == "user" else (model.itemFactors, model.userFactors)
    x = own.select(F.col("id").alias(side), F.col("features").alias("_x"))
    y = far.select(F.col("id").alias(other), F.col("features").alias("_y"))
    rows = ratings.na.drop(subset=["user", "item", "rating"]).join(x, side).join(y, other)
    dot = F.aggregate(F.zip_with("_x", "_y", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, a: s + a)
    rows = rows.withColumn("_miss", dot - F.col("rating"))
    terms = rows.select(side, "rating", "_x", "_miss", F.posexplode("_y").alias("k", "_v"))
    per = terms.groupBy(side, "k").agg(
        F.sum(F.col("_miss") * F.col("_v")).alias("g"),
        F.sum(F.col("rating") * F.col("_v")).alias("b"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_miss") * F.col("_miss")).alias("sse"),
        F.any_value(F.get("_x", F.col("k"))).alias("x"),
    )
    gradient = F.col("g") + reg * F.col("n") * F.col("x")
    return per.groupBy(F.col(side).alias("id")).agg(
        F.max("n").alias("n_ratings"),
        F.max("sse").alias("sse"),
        F.try_divide(F.sqrt(F.sum(gradient * gradient)), F.sqrt(F.sum(F.col("b") * F.col("b")))).alias("residual"),
    )
