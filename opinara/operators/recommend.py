"""Collaborative filtering with MLlib's alternating least squares."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from opinara.operators.factorization import Factors
from opinara.operators.keys import global_position
from opinara.operators.tuning import grid_errors
from opinara.session import written

# The hyper-parameter grid and the final fit.
RANKS = (10, 30, 50, 100, 150, 200)
REG_PARAMS = (0.1, 0.01, 0.001, 0.25, 0.025, 0.005, 0.002, 0.05, 0.16, 0.18, 0.0002)
TUNING_ITERATIONS = 10
FINAL_ITERATIONS = 1000
FINAL_SEED = 99
TOP_ITEMS = 10


def clean_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.na.drop(subset=["user", "item", "rating"])


def drop_cold(predictions: DataFrame) -> DataFrame:
    """Without the pairs whose user or item the model has not seen (null or NaN)."""
    return predictions.na.drop(subset=["prediction"])


def split_ratings(
    ratings: DataFrame, seed: int = 1, train_percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Training and validation parts by a hash of the pair.

    A pair always falls on the same side, whatever the file order and also when a task is run
    again, which a random draw per partition does not guarantee.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("user"), F.col("item")))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return ratings.where(draw < train_percent), ratings.where(draw >= train_percent)


def als(
    ratings: DataFrame,
    rank: int = 10,
    reg: float = 0.1,
    iters: int = 10,
    seed: int | None = None,
    blocks: int | None = None,
) -> ALS:
    """The estimator; blocks follow the cluster's cores, lineage is cut if a checkpoint folder is set."""
    spark = ratings.sparkSession
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    est = ALS(
        rank=rank,
        regParam=reg,
        maxIter=iters,
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        coldStartStrategy="drop",
    )
    if seed is not None:
        est = est.setSeed(seed)
    return est.setNumBlocks(blocks or max(10, spark.sparkContext.defaultParallelism))


def fit_als(ratings: DataFrame, **params) -> ALSModel:
    data = clean_ratings(ratings)
    return als(data, **params).fit(data)


def predict(model: ALSModel | Factors, pairs: DataFrame) -> DataFrame:
    return drop_cold(model.transform(pairs))


def evaluate(predictions: DataFrame) -> float:
    return RegressionEvaluator(
        metricName="rmse", labelCol="rating", predictionCol="prediction"
    ).evaluate(predictions)


def covering_ratings(ratings: DataFrame) -> DataFrame:
    """A rating of every user and one of every item. MLlib draws first factors by the ids alone, so it draws the
    same for these rows."""
    rows = ratings.select("user", "item", "rating")
    users = rows.groupBy("user").agg(F.min(F.struct("item", "rating")).alias("r")).select("user", "r.item", "r.rating")
    items = rows.groupBy("item").agg(F.min(F.struct("user", "rating")).alias("r")).select("r.user", "item", "r.rating")
    return users.unionByName(items)


def tune_als(
    ratings: DataFrame,
    ranks: Sequence[int] = RANKS,
    regs: Sequence[float] = REG_PARAMS,
    iters: Sequence[int] = (TUNING_ITERATIONS,),
    seed: int = 1,
    parallelism: int = 2,
) -> DataFrame:
    """``trial, rank, reg, iters, rmse`` for every grid point, in grid order.

    MLlib draws the first factors of each rank, ``parallelism`` ranks side by side; the points then go through
    their rounds (:mod:`opinara.operators.tuning`) over all ratings, with MLlib's order and regularization. The result has
    one row per grid point; choose with :func:`opinara.operators.aggregates.best_params`.
    """
    train, valid = split_ratings(clean_ratings(ratings), seed)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    valid = valid.persist(StorageLevel.MEMORY_AND_DISK)
    est = als(train)
    points = [(r, g, i) for r in ranks for g in regs for i in iters]

    ids = written(covering_ratings(train))

    def first(rank: int) -> tuple[int, ALSModel]:
        return rank, est.copy({est.rank: rank, est.maxIter: 0}).fit(ids)

    try:
        with ThreadPool(min(parallelism, len(points))) as pool:
            models = dict(pool.imap(first, dict.fromkeys(ranks)))
        users, items = ({r: getattr(m, side) for r, m in models.items()} for side in ("userFactors", "itemFactors"))
        errors = grid_errors(train, valid, users, items, regs, iters)
    finally:
        train.unpersist()
        valid.unpersist()
    rows = [(n, *point, errors[point]) for n, point in enumerate(points)]
    return ratings.sparkSession.createDataFrame(
        rows, "trial int, rank int, reg double, iters int, rmse double"
    )


def _merge_best(score: np.ndarray, item: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, best first, the smaller item first on ties."""
    if score.shape[1] > 4 * k:
        top = np.argpartition(-score, k - 1, axis=1)[:, :k]
        border = np.take_along_axis(score, top, 1).min(axis=1)
        # Ties at the border are decided by the item, so all of them have to be looked at.
        ties = (score >= border[:, None]).sum(axis=1).max()
        if ties > k:
            top = np.argpartition(-score, ties - 1, axis=1)[:, :ties]
        score, item = np.take_along_axis(score, top, 1), np.take_along_axis(item, top, 1)
    order = np.lexsort((item, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(item, order, 1)


_STATE = "group int, user int, features array<float>, score array<float>, item array<int>, left boolean"
_SENT = ["group", "kind", "norm", "id", "features", "score", "item", "after"]


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


class _Group:
    """The users of a group and the best items found for them."""

    def __init__(self, number: int, k: int):
        self.number, self.k = number, k
        self.parts: list[pa.RecordBatch] = []
        self.user: np.ndarray | None = None
        self.after = 0.0

    def ready(self) -> None:
        if self.user is None:
            table = pa.Table.from_batches(self.parts).combine_chunks()
            columns = {c: table.column(c).chunk(0) for c in ("id", "features", "score", "item", "after")}
            self.ids, self.features = columns["id"], columns["features"]
            self.user = _matrix(columns["features"], np.float32)
            self.size = np.linalg.norm(self.user, axis=1)
            self.score, self.item = _matrix(columns["score"], np.float32), _matrix(columns["item"], np.int32)
            self.after = float(columns["after"][0].as_py() or 0.0)
            self.parts = []

    def done(self, norm: float) -> np.ndarray:
        """Who can't find better items among those of at most ``norm``: the bound, with room for rounding."""
        full = self.score.shape[1] >= self.k
        worst = self.score[:, self.k - 1] if full else np.full(len(self.score), -np.inf)
        return worst > self.size * norm * (1 + 1e-5) + 1e-6

    def see(self, batch: pa.RecordBatch, step: int) -> None:
        norms = batch.column("norm").to_numpy()
        factors, ids = _matrix(batch.column("features"), np.float32), batch.column("id").to_numpy()
        for lo in range(0, len(ids), step):
            open_ = np.flatnonzero(~self.done(float(norms[lo])))
            if not len(open_):
                return
            if self.score.shape[1] < self.k:  # rows are of one length until all have k
                open_ = np.arange(len(self.user))
            new = self.user[open_] @ factors[lo : lo + step].T
            names = np.broadcast_to(ids[lo : lo + step], new.shape)
            score, item = _merge_best(
                np.hstack([self.score[open_], new]), np.hstack([self.item[open_], names]), self.k
            )
            if len(open_) == len(self.user):
                self.score, self.item = score, item
            else:
                self.score[open_], self.item[open_] = score, item

    def rows(self) -> pa.RecordBatch:
        n = len(self.user)
        left = bool((~self.done(self.after)).any())
        columns = [
            pa.array([self.number] * n, pa.int32()), self.ids, self.features,
            pa.array(self.score.tolist(), pa.list_(pa.float32())), pa.array(self.item.tolist(), pa.list_(pa.int32())),
            pa.array([left] * n),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _STATE.split(", ")])


def _band_search(k: int, step: int):
    """Rows by group: its users, then the band's items by falling norm. Holds one group's users."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: _Group | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            number, kind = batch.column("group").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if group is None or number[lo] != group.number:
                    if group is not None:
                        group.ready()
                        yield group.rows()
                    group = _Group(int(number[lo]), k)
                part = batch.slice(lo, hi - lo)
                if kind[lo] == 0:
                    group.parts.append(part)
                else:
                    group.ready()
                    group.see(part, step)
        if group is not None:
            group.ready()
            yield group.rows()

    return run


def recommend_all(
    model: ALSModel | Factors, k: int = TOP_ITEMS, block: int = 1 << 12, step: int = 1 << 11, users: int = 1 << 12
) -> DataFrame:
    """``user, recommendations``: the k best items of every user with their predicted ratings.

    Exact, without scoring every pair: items come by descending norm of their factors, in bands of which
    the first has ``block`` items and each next one four times as many. A band is sent to the groups of
    about ``users`` users that still take part, with the largest norm behind it. A user is done when
    the k-th score found exceeds the user's norm times that bound, and a group leaves when all its users
    are done. What was found is written down after each band; bands grow, so there are few. Ties go to
    the smaller item.
    """
    spark = model.userFactors.sparkSession
    squares = F.aggregate("features", F.lit(0.0), lambda s, x: s + x * x)
    items = model.itemFactors.withColumn("norm", F.sqrt(squares)).withColumn("down", -F.col("norm"))
    placed = written(global_position(items, "down", "id", name="place").drop("down"))
    n, groups = placed.count(), max(1, -(-model.userFactors.count() // users))
    none = F.array()
    state = model.userFactors.select(
        F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"), F.col("id").alias("user"), "features",
        none.cast("array<float>").alias("score"), none.cast("array<int>").alias("item"), F.lit(True).alias("left"),
    )
    state, finished, low = written(state), [], 0
    while low < n:
        band = placed.where(F.col("place").between(low, low + block - 1))
        after = placed.where(F.col("place") >= low + block).agg(F.max("norm")).scalar()
        # As many numbers as groups.
        open_ = state.select("group").distinct().agg(F.collect_list("group")).scalar()
        sent = band.select(
            F.explode(open_).alias("group"), F.lit(1).alias("kind"), "norm", "id", "features",
            none.cast("array<float>").alias("score"), none.cast("array<int>").alias("item"), F.lit(0.0).alias("after"),
        )
        own = state.select(
            "group", F.lit(0).alias("kind"), F.lit(0.0).alias("norm"), F.col("user").alias("id"), "features",
            "score", "item", F.coalesce(after, F.lit(0.0)).alias("after"),
        )
        rows = own.unionByName(sent).repartition("group").sortWithinPartitions("group", "kind", F.desc("norm"), "id")
        found = written(rows.select(*_SENT).mapInArrow(_band_search(k, step), _STATE))
        low, block = low + block, 4 * block
        finished.append(found if low >= n else found.where("NOT left"))
        state = found.where("left")
        if low < n and not state.limit(1).count():
            break
    if not finished:
        finished = [state]
    whole = finished[0]
    for more in finished[1:]:
        whole = whole.unionByName(more)
    pairs = F.zip_with("item", "score", lambda i, s: F.struct(i.alias("item"), s.alias("rating")))
    return whole.select("user", pairs.alias("recommendations"))


def recommend_all_pairs(model: ALSModel, k: int = TOP_ITEMS) -> DataFrame:
    """The same by MLlib, which scores every user with every item."""
    return model.recommendForAllUsers(k)


def recommend_for(model: ALSModel, users: DataFrame, k: int = TOP_ITEMS) -> DataFrame:
    return model.recommendForUserSubset(users, k)


def recommended_items(recommendations: DataFrame) -> DataFrame:
    """``user, recommended array<int>``: the item ids only."""
    return recommendations.select(
        "user", F.col("recommendations")["item"].cast("array<int>").alias("recommended")
    )
