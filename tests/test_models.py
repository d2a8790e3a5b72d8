import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinara.operators import factorization as Z
from opinara.operators import recommend as R
from opinara.operators import spectral, vectors
from opinara.operators import tuning as U
from opinara.operators.aggregates import best_params, rmse
from opinara.operators.vectors import train_word_vectors
from opinara.session import swept, written


@pytest.fixture(scope="module")
def planted(spark):
    """Rank-2 ratings with some pairs left out."""
    users, items = spark.range(60).toDF("user"), spark.range(40).toDF("item")
    u1, u2 = F.col("user") % 7 + 1, F.col("user") % 5 + 1
    i1, i2 = F.col("item") % 6 + 1, F.col("item") % 4 + 1
    return (
        users.crossJoin(items)
        .where((F.col("user") * 31 + F.col("item") * 17) % 10 < 6)
        .select(
            F.col("user").cast("int"), F.col("item").cast("int"), ((u1 * i1 + u2 * i2) / 10).alias("rating")
        )
    )


def test_split_is_repeatable_and_whole(planted):
    train, valid = R.split_ratings(planted, seed=3)
    again, _ = R.split_ratings(planted.repartition(13), seed=3)
    assert train.count() + valid.count() == planted.count()
    assert train.exceptAll(again).count() == 0 and again.exceptAll(train).count() == 0
    assert 0.7 < train.count() / planted.count() < 0.9


def test_clean_ratings(spark):
    df = spark.createDataFrame(
        [(1, 1, 1.0), (None, 1, 1.0), (1, None, 1.0), (1, 1, None)], "user int, item int, rating double"
    )
    assert R.clean_ratings(df).count() == 1


def test_beats_the_mean_and_repeats(planted):
    train, valid = R.split_ratings(planted)
    model = R.fit_als(train, rank=4, reg=0.01, iters=8, seed=7)
    again = R.fit_als(train, rank=4, reg=0.01, iters=8, seed=7)
    error = R.evaluate(R.predict(model, valid))
    mean = train.agg(F.avg("rating")).first()[0]
    guess = rmse(valid.withColumn("prediction", F.lit(mean)), "rating", "prediction").first()["rmse"]
    assert error < guess / 3
    left = {r["id"]: r["features"] for r in model.userFactors.collect()}
    right = {r["id"]: r["features"] for r in again.userFactors.collect()}
    assert left.keys() == right.keys()
    assert all(left[k] == pytest.approx(right[k], abs=1e-4) for k in left)


def test_recommendations_and_cold_start(spark, planted):
    model = R.fit_als(planted, rank=4, iters=5, seed=7)
    recs = R.recommend_all(model, 10)
    rows = R.recommended_items(recs).collect()
    assert len(rows) == 60 and all(len(set(r["recommended"])) == 10 for r in rows)
    assert dict(recs.dtypes)["recommendations"] == "array<struct<item:int,rating:float>>"
    some = spark.createDataFrame([(3,), (999,)], "user int")
    assert [r["user"] for r in R.recommend_for(model, some, 2).collect()] == [3]
    pairs = spark.createDataFrame([(1, 1, 1.0), (999, 1, 1.0)], "user int, item int, rating double")
    predicted = R.predict(model, pairs)
    assert predicted.count() == 1
    assert R.evaluate(predicted) < 10


def test_tuning_lists_every_point(planted):
    metrics = R.tune_als(planted, ranks=(1, 4), regs=(0.01, 5.0), iters=(4,), parallelism=3)
    rows = metrics.orderBy("trial").collect()
    assert [(r["rank"], r["reg"]) for r in rows] == [(1, 0.01), (1, 5.0), (4, 0.01), (4, 5.0)]
    best = best_params(metrics).first()
    assert best["rmse"] == min(r["rmse"] for r in rows) and best["reg"] == 0.01


def test_tuning_draws_first_factors_once_per_rank(planted, monkeypatch):
    fits, fit = [], R.ALS._fit
    monkeypatch.setattr(R.ALS, "_fit", lambda self, data: fits.append(self.getRank()) or fit(self, data))
    rows = R.tune_als(planted, ranks=(2, 3), regs=(0.01, 0.1, 1.0), iters=(1, 2)).collect()
    assert len(rows) == 12 and sorted(fits) == [2, 3]


@pytest.mark.parametrize("size", [None, 30])
def test_points_fitted_together_equal_single_fits(spark, planted, size):
    """Also with more ratings of an id than a chunk takes, repeated pairs, and pairs that are not known."""
    again = planted.where("user % 7 = 0").withColumn("rating", F.col("rating") + 0.5)
    train, valid = R.split_ratings(planted.unionByName(again))
    strange = spark.createDataFrame([(10**6, 1, 2.0), (1, 10**6, 2.0)], "user int, item int, rating double")
    valid = valid.unionByName(strange.select(valid.columns))
    ranks, regs, iters = (2, 30), (0.01, 0.2), (0, 2)
    firsts = {r: R.als(train, rank=r, iters=0, seed=3).fit(train) for r in ranks}
    users, items = {r: m.userFactors for r, m in firsts.items()}, {r: m.itemFactors for r, m in firsts.items()}
    found = U.grid_errors(train, valid, users, items, regs, iters, **({"size": size, "fan": 4} if size else {}))
    assert found.keys() == {(r, g, i) for r in ranks for g in regs for i in iters}
    for (rank, reg, i), error in found.items():
        model = R.als(train, rank=rank, reg=reg, iters=i, seed=3).fit(train)
        assert error == pytest.approx(R.evaluate(R.predict(model, valid)), rel=1e-3)


def test_points_that_do_not_fit_together_follow_one_another(spark, planted, monkeypatch):
    """The tables of a round hold the factors of one group of points; blocks of both sides give the same errors."""
    train, valid = R.split_ratings(planted)
    firsts = {r: R.als(train, rank=r, iters=0, seed=3).fit(train) for r in (2, 3)}
    users, items = {r: m.userFactors for r, m in firsts.items()}, {r: m.itemFactors for r, m in firsts.items()}
    together = U.grid_errors(train, valid, users, items, (0.01, 0.2), (1, 2))
    points, kept = [], U.written

    def look(df, path):
        out = kept(df, path)
        if "/items-" in path or "/users-" in path:
            points.append(sum(len(r["features"]) for r in out.select("features").collect()) // 4 // out.select("id").distinct().count())
        return out

    monkeypatch.setattr(U, "written", look)
    monkeypatch.setattr(U, "GROUP_BYTES", 1)
    monkeypatch.setattr(U, "_shape", lambda *_: (2, 3))
    apart = U.grid_errors(train, valid, users, items, (0.01, 0.2), (1, 2))
    assert set(points) == {2, 3} and len(points) == 4 * 5
    assert apart.keys() == together.keys()
    assert all(apart[p] == pytest.approx(together[p], rel=1e-5) for p in together)


def test_blocks_of_ratings_send_less_than_every_rating_its_factors():
    """1 GB: 90,000 users and 100 items, 3.5 million ratings at rank 200; before, nearly every rating sent a user's."""
    high, wide = U._shape(16, 100, 90_000, 3_500_000, 200)
    sent = 4 * 200 * 90_000 * high + (wide > 1) * 8 * U._packed(200) * 100 * wide
    assert high * wide >= 16 and sent < 4 * 200 * 3_500_000 / 8
    assert U._shape(16, 90_000, 100, 3_500_000, 200) == (16, 1)


def test_first_factors_depend_on_ids_alone(planted):
    some = R.covering_ratings(planted)
    assert some.count() == 100 < planted.count()
    for side in ("userFactors", "itemFactors"):
        found, whole = (
            {r["id"]: r["features"] for r in getattr(R.als(x, rank=3, iters=0, seed=3).fit(x), side).collect()}
            for x in (some, planted)
        )
        assert found == whole and len(found) in (60, 40)


def test_word_vectors(spark):
    docs = spark.createDataFrame(
        [(["wide", "broad", "road"],), (["wide", "broad", "street"],), (["once"],)] * 1
        + [(["wide", "road"],)] * 5,
        "tokens array<string>",
    )
    rows = train_word_vectors(docs, dim=8, window=2, min_count=2, iters=1, partitions=2).collect()
    assert {r["word"] for r in rows} == {"wide", "broad", "road"}
    assert all(len(r["vector"]) == 8 for r in rows)


def test_pruned_top_items_equal_the_search_over_all_pairs(planted):
    model = R.fit_als(planted, rank=4, iters=5, seed=7)
    whole = {r["user"]: [x["rating"] for x in r["recommendations"]] for r in R.recommend_all_pairs(model, 7).collect()}
    for block, step in ((1 << 16, 8), (9, 4), (1, 1)):
        found = R.recommend_all(model, 7, block, step)
        rows = {r["user"]: r["recommendations"] for r in found.collect()}
        assert rows.keys() == whole.keys()
        for user, best in rows.items():
            assert [x["rating"] for x in best] == pytest.approx(whole[user], abs=1e-4)
            assert len({x["item"] for x in best}) == 7
    plan = R.recommend_all(model, 7)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _plain_rounds(rows, initial, rank, reg, rounds):
    """The same rounds over plain arrays."""
    users, items = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    v = {i: np.array(initial[i], float) for i in items}
    u = {}
    for _ in range(rounds):
        for own, other, a, b in ((u, v, 0, 1), (v, u, 1, 0)):
            for k in users if a == 0 else items:
                mine = [r for r in rows if r[a] == k]
                x = np.array([other[r[b]] for r in mine])
                y = np.array([r[2] for r in mine])
                own[k] = np.linalg.solve(x.T @ x + reg * len(mine) * np.eye(rank), x.T @ y).astype(np.float32).astype(float)
    return u, v


@pytest.mark.parametrize("chunk", [None, 40])
def test_staged_rounds_equal_plain_ones(spark, planted, tmp_path, monkeypatch, chunk):
    """In one chunk, and with ids that span many: a third of the ratings are one user's."""
    monkeypatch.setattr(Z, "FAN", 3)
    hot = spark.range(400).select(F.lit(7).cast("int").alias("user"), (F.col("id") % 40).cast("int").alias("item"), (F.col("id") % 5 + 0.5).alias("rating"))
    data = planted.where("user < 12").unionByName(hot)
    rows = [tuple(r) for r in data.select("user", "item", "rating").collect()]
    first = Z.initial_factors(data.select(F.col("item").alias("id")).distinct(), 3, 99)
    initial = {r["id"]: r["features"] for r in first.collect()}
    model = Z.fit_rounds(data, 3, 0.05, 4, tolerance=0, folder=str(tmp_path / "fit"), chunk_ratings=chunk)
    u, v = _plain_rounds(rows, initial, 3, 0.05, 4)
    for found, expected in ((model.userFactors, u), (model.itemFactors, v)):
        got = {r["id"]: r["features"] for r in found.collect()}
        assert got.keys() == expected.keys()
        assert all(got[k] == pytest.approx(expected[k].tolist(), abs=2e-3) for k in got)
    assert [r["round"] for r in model.history.collect()] == [1, 2, 3, 4]


def test_a_stopped_fit_goes_on(planted, tmp_path):
    whole = Z.fit_rounds(planted, 2, 0.1, 5, tolerance=0, folder=str(tmp_path / "a"))
    Z.fit_rounds(planted, 2, 0.1, 3, tolerance=0, folder=str(tmp_path / "b"))
    (tmp_path / "b" / "users-00004").mkdir()  # a half round that was not written to its end
    rest = Z.fit_rounds(planted, 2, 0.1, 5, tolerance=0, folder=str(tmp_path / "b"))
    assert [r["round"] for r in rest.history.collect()] == [4, 5]
    left, right = ({r["id"]: r["features"] for r in m.itemFactors.collect()} for m in (whole, rest))
    assert left.keys() == right.keys() and all(left[k] == pytest.approx(right[k], abs=1e-5) for k in left)


def test_fit_stops_where_factors_stand_still(spark, planted):
    model = Z.fit_rounds(planted, 2, 0.1, 200, tolerance=0.02)
    changes = [r["change"] for r in model.history.orderBy("round").collect()]
    assert 2 < len(changes) < 200 and changes[-1] <= 0.02 < changes[-2]
    for side, most in (("user", 0.1), ("item", 1e-4)):
        rows = Z.normal_residual(planted, model, 0.1, side).collect()
        assert len(rows) == (60 if side == "user" else 40) and max(r["residual"] for r in rows) < most
        assert sum(r["n_ratings"] for r in rows) == planted.count()
    error = R.evaluate(R.predict(model, planted))
    sse = sum(r["sse"] for r in rows)
    assert error == pytest.approx((sse / planted.count()) ** 0.5, rel=1e-3)
    recs = {r["user"]: r["recommendations"] for r in R.recommend_all(model, 3, 4, 2, 16).collect()}
    u = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    v = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    for user, best in recs.items():
        scores = sorted((float(u[user] @ x) for x in v.values()), reverse=True)[:3]
        assert [b["rating"] for b in best] == pytest.approx(scores, abs=1e-3)


def test_no_ratings_no_factors(spark, planted):
    model = Z.fit_rounds(planted.limit(0), 2, 0.1, 3)
    assert model.userFactors.count() == model.itemFactors.count() == 0
    assert R.recommend_all(model).count() == 0


@pytest.mark.parametrize("chunk", [None, 60])
def test_leading_vectors_equal_a_dense_decomposition(spark, chunk):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 3)) * [3.0, 2.0, 1.2]
    dense = base @ base.T + 0.01 * rng.normal(size=(40, 40))
    dense = np.where(rng.random((40, 40)) < 0.6, dense, 0)
    dense = np.triu(dense, 1) + np.triu(dense, 1).T
    dense[0] = dense[:, 0] = 1.0
    rows = [(i, j, float(dense[i, j])) for i in range(40) for j in range(40) if dense[i, j]]
    frame = spark.createDataFrame(rows, "row int, col int, value double")
    found = {r["id"]: r["features"] for r in spectral.leading_vectors(frame, 2, 10, chunk_entries=chunk).collect()}
    values, turn = np.linalg.eigh(dense)
    top = np.argsort(-np.abs(values))[:2]
    expected = turn[:, top] * np.sqrt(np.abs(values[top]))
    got = np.array([found[i] for i in range(40)])
    assert np.allclose(got @ got.T, expected @ expected.T, atol=0.02 * np.abs(values[top[0]]))


def test_rows_of_blocks_follow_one_another(spark, monkeypatch):
    """1 GB: what travels at a time is a basis row and a sum per id, not one of each for every row of blocks."""
    assert spectral._passes(25, 3_000_000, 150) == [range(r, r + 1) for r in range(25)]
    assert spectral._passes(7, 10_000, 150) == [range(7)]
    rows = [(i, j, float(1 + (i * j) % 5)) for i in range(30) for j in range(30) if (i + j) % 3]
    frame = spark.createDataFrame(rows, "row int, col int, value double")
    whole = {r["id"]: r["features"] for r in spectral.leading_vectors(frame, 2, 6, chunk_entries=60).collect()}
    jobs, kept = [], spectral.written
    monkeypatch.setattr(spectral, "written", lambda df, path: jobs.append(path) or kept(df, path))
    monkeypatch.setattr(spectral, "PASS_BYTES", 30 * 2 * 12 * 2)
    apart = {r["id"]: r["features"] for r in spectral.leading_vectors(frame, 2, 6, chunk_entries=60).collect()}
    assert len([p for p in jobs if "/last/" in p]) == 2 and len(whole) == 30
    first, second = (np.array([x[i] for i in range(30)]) for x in (whole, apart))
    assert np.allclose(first @ first.T, second @ second.T, atol=1e-4 * np.abs(first @ first.T).max())


def test_count_vectors_of_planted_words_are_neighbours(spark):
    """Words of one theme stand together, two words of a theme never side by side with another theme's."""
    rng = random.Random(1)
    themes = {t: [f"{t}word{i}" for i in range(6)] for t in ("sea", "city", "farm")}
    docs = [([rng.choice(themes[t]) for _ in range(12)] + ["common"],) for t in themes for _ in range(40)]
    frame = spark.createDataFrame([*docs, (["once"],), ([],), (None,)], "tokens array<string>")
    found = written(vectors.count_word_vectors(frame, dim=4, window=4, rounds=5, shift=1.0))
    words = {r["word"] for r in found.collect()}
    assert "once" not in words and {w for ws in themes.values() for w in ws} <= words
    for theme in themes:
        near = [r["word"] for r in vectors.similar_words(found, f"{theme}word0", 5).collect()]
        assert all(w.startswith(theme) for w in near), near


def test_cooccurrences_count_every_pair_of_places(spark):
    rng = random.Random(2)
    docs = [[rng.choice("abcd") for _ in range(rng.randint(0, 15))] for _ in range(30)]
    expected: dict = {}
    for d in docs:
        for i, x in enumerate(d):
            for y in d[i + 1 : i + 4]:
                if x != y:
                    for pair in ((x, y), (y, x)):
                        expected[pair] = expected.get(pair, 0) + 1
    frame = spark.createDataFrame([(d,) for d in docs], "tokens array<string>")
    found = {(r["word"], r["other"]): r["times"] for r in vectors.cooccurrences(frame, window=3).collect()}
    assert found == expected


def test_pairs_of_ids_are_counted_as_pairs_of_places(spark, monkeypatch):
    """Over the ends of stretches, with empty and null lists and ids that repeat."""
    rng = random.Random(3)
    docs = [[rng.randint(0, 5) for _ in range(rng.randint(0, 30))] for _ in range(40)] + [[], [1 << 30, 0, 1 << 30]]
    monkeypatch.setattr(vectors, "STRETCH", 7)
    batch = pa.RecordBatch.from_arrays([pa.array([*docs, None], pa.list_(pa.int32()))], names=["ids"])
    small: dict = {}
    for part in vectors._near_ids(4)(iter([batch])):
        for key, times in zip(*[c.to_pylist() for c in part.columns], strict=True):
            small[key >> 32, key & 0xFFFFFFFF] = small.get((key >> 32, key & 0xFFFFFFFF), 0) + times
    frame = spark.createDataFrame([(d,) for d in [*docs, None]], "ids array<int>")
    rows = vectors.counted_pairs(frame, 4).collect()
    found = {(r["word"], r["other"]): r["times"] for r in rows}
    plain = {(r["word"], r["other"]): r["times"] for r in vectors.cooccurrences(frame, "ids", 4).collect() if r["word"] < r["other"]}
    assert len(rows) == len(found) and found == plain == small


def test_shares_of_pairs_are_all_pairs(spark, monkeypatch):
    """Shares follow one another; together they hold each pair once, and totals count the same pairs at their places."""
    rng = random.Random(6)
    docs = [[rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))] for _ in range(40)] + [["a", None, "b", "b"], None, []]
    kept, texts = vectors.numbered_texts(spark.createDataFrame([(d,) for d in docs], "tokens array<string>"))
    names = {r["id"]: r["word"] for r in kept.collect()}
    known = sorted([w for w in d if w is not None] for d in docs if d)
    assert sorted([names[i] for i in r["ids"]] for r in texts.collect()) == known
    monkeypatch.setattr(vectors, "SHARE_PAIRS", 500)
    seen = []

    def each(pairs):
        seen.append(pairs.count())
        return pairs

    whole = {(r["word"], r["other"]): r["times"] for r in vectors.counted_pairs(texts, 4).collect()}
    rows = vectors.over_pairs(texts, each, 4).collect()
    assert len(seen) > 3 and max(seen) < len(whole) == len(rows) == sum(seen)
    assert {(r["word"], r["other"]): r["times"] for r in rows} == whole
    totals: dict = {}
    for pair, times in whole.items():
        for word in pair:
            totals[word] = totals.get(word, 0) + times
    assert {r["word"]: r["_n"] for r in vectors.pair_totals(texts, 4).collect()} == totals


def test_shuffle_files_go_with_their_job(spark):
    """Within the block; the setting is as before afterwards."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with swept(spark):
        assert spark.conf.get(key) == "true"
        with swept(spark):
            pass
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before


def test_vocabulary_is_read_once_for_its_numbers(spark):
    """Numbering looks at the words several times; the texts are read for the counts and for the pairs only."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    texts = spark.createDataFrame([(["a", "b", "a"],), (["b", "c", "c"],)], "tokens array<string>")
    kept, pairs = vectors.counted_words(texts.mapInArrow(look, "tokens array<string>"), window=2)
    assert {r["word"]: r["id"] for r in kept.collect()} == {"a": 0, "b": 1, "c": 2}
    assert {(r["word"], r["other"]): r["times"] for r in pairs.collect()} == {(0, 1): 2, (1, 2): 2}
    assert seen.value == 2 * 2


def test_a_round_sends_a_block_the_basis_rows_of_its_columns():
    """Rows that travel in a round are vectors times blocks a side; chunks of rows were each sent nearly all."""
    for columns in (400_000, 1_600_000):
        total = 150 * columns
        grid = spectral._grid(total, columns, 150, spectral.BLOCK_ENTRIES)
        assert total / grid**2 <= spectral.BLOCK_ENTRIES and columns / grid * 150 * 4 <= spectral.BLOCK_BYTES
        assert grid <= 1 + max((total / spectral.BLOCK_ENTRIES) ** 0.5, columns * 600 / spectral.BLOCK_BYTES)


def test_a_block_is_multiplied_in_steps(monkeypatch):
    rng = np.random.default_rng(5)
    dense = rng.normal(size=(6, 50)) * (rng.random((6, 50)) < 0.7)
    dense[2] = 0
    at = [tuple(x) for x in np.argwhere(dense)]
    rng.shuffle(at)
    entries = pa.table({"row": [10 + i for i, _ in at], "col": [j for _, j in at], "value": [dense[i, j] for i, j in at]})
    vectors_ = rng.normal(size=(50, 3)).astype(np.float32)
    order = rng.permutation(50)
    basis = pa.table({"id": pa.array(order), "features": spectral._bytes(vectors_[order])})
    monkeypatch.setattr(spectral, "STEP", 4)
    out = spectral._multiplier(3)(entries, basis)
    assert out.column("id").to_pylist() == [10, 11, 13, 14, 15]
    expected = (dense @ vectors_.astype(float))[[0, 1, 3, 4, 5]]
    assert np.allclose(spectral._matrix(out.column("features"), 3), expected)


def test_no_entries_no_vectors(spark):
    frame = spark.createDataFrame([], "row int, col int, value double")
    assert spectral.leading_vectors(frame, 2, 2).count() == 0
