from pyspark.sql import functions as F

from opinara.operators import aggregates as A
from opinara.operators import aspects, keys


def test_map_ids_is_dense_in_key_order(spark):
    df = spark.range(5000).select(F.concat(F.lit("u"), F.col("id") % 777).alias("u"))
    mapped, mapping = keys.map_ids(df, "u", "user")
    rows = sorted(mapping.collect(), key=lambda r: r["user"])
    assert [r["user"] for r in rows] == list(range(777))
    assert [r["u"] for r in rows] == sorted(r["u"] for r in rows)
    assert mapped.count() == 5000 and mapped.dtypes == [("user", "int")]


def test_global_position_with_one_hot_key(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        "id",
    )
    got = {(r["k"], r["id"]): r["position"] for r in keys.number_within(df, "k", "id").collect()}
    seen: dict = {}
    for k, i in sorted(got):
        assert got[k, i] == seen.get(k, 0)
        seen[k] = seen.get(k, 0) + 1


def test_group_collect_parts_and_nulls(spark):
    rows = [("a", i, None if i % 4 == 0 else f"v{i}") for i in range(10)] + [("b", 0, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = {(r["k"], r["part"]): r["values"] for r in A.group_collect(df, "k", "v", "o", 4).collect()}
    assert got == {
        ("a", 0): ["v1", "v2", "v3"],
        ("a", 1): ["v5", "v6", "v7"],
        ("a", 2): ["v9"],
        ("b", 0): [],
    }


def test_concat_reviews_in_order(spark):
    rows = [(3, "p", "c"), (1, "p", "a"), (2, "p", "b"), (4, "q", None)]
    df = spark.createDataFrame(rows, "review_id int, product_id string, review_text string")
    got = {r["product_id"]: r["reviews"] for r in A.concat_reviews(df).collect()}
    assert got == {"p": "a.b.c", "q": ""}


def test_best_params_first_wins_and_nan_loses(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, nan), (1, 0.5), (2, 0.5), (3, 0.9), (4, None)], "trial int, rmse double")
    assert [tuple(r) for r in A.best_params(df).collect()] == [(1, 0.5)]
    assert A.best_params(df.where("trial = 0")).collect() == []


def test_rmse_leaves_out_missing_predictions(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, float("nan")), (3.0, 1.0)], "rating double, p double")
    assert abs(A.rmse(df, "rating", "p").first()["rmse"] - 2.5**0.5) < 1e-12


def test_group_collect_keeps_null_and_repeated_orders(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", None, "n"), (None, 2, "p"), (None, None, "o"), ("b", 3, "z")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = {r["k"]: r["values"] for r in A.group_collect(df, "k", "v", "o").collect()}
    assert got == {"a": ["n", "x", "x"], None: ["o", "p"], "b": ["z"]}


def test_positions_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(keys, "BUCKET_ROWS", 50)
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    rows = keys.global_position(df, "k", "id").collect()
    want = sorted((r["k"], r["id"]) for r in rows)
    assert [(r["k"], r["id"]) for r in sorted(rows, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in rows) == list(range(3000))
    same = keys.global_position(spark.range(500).select(F.lit(1).alias("k")), "k")
    assert sorted(r["position"] for r in same.collect()) == list(range(500))


def _largest_task(spark, frame):
    """Rows of the largest output task and of all, with joins that can't broadcast and split early."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sizes = frame().rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return max(sizes), sum(sizes)


def test_hot_keys_are_split_in_joins(spark, monkeypatch):
    # A task's output is split by the tasks it comes from: a bucket each.
    monkeypatch.setattr(keys, "BUCKET_ROWS", 5000)
    hot = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 5 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id"
    )
    most, rows = _largest_task(spark, lambda: keys.number_within(hot, "k", "id"))
    assert rows == 200_000 and most < rows / 4
    tagged = hot.select(F.col("k").alias("word"), F.lit("NN").alias("tag"))
    learned = aspects.build_tag_lexicon(tagged)
    words = hot.select(F.col("k").alias("word"), "id")
    most, rows = _largest_task(spark, lambda: aspects.attach_tags(words, learned))
    assert rows == 200_000 and most < rows / 4


def test_positions_over_two_levels_of_buckets(spark, monkeypatch):
    """Both limits lowered: more buckets than borders are drawn for, in groups of a few."""
    monkeypatch.setattr(keys, "BUCKET_ROWS", 50)
    monkeypatch.setattr(keys, "MAX_BUCKETS", 3)
    monkeypatch.setattr(keys, "GROUP_BUCKETS", 4)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).when(F.col("id") % 50 == 0, None).otherwise(F.col("id") * 7919 % 997).alias("k"), "id"
    )
    found = {r["id"]: r["position"] for r in keys.global_position(df, "k", "id").collect()}
    ranked = sorted(df.collect(), key=lambda r: (r["k"] is not None, r["k"] or 0, r["id"]))
    assert found == {r["id"]: i for i, r in enumerate(ranked)}
    per_key = {(r["k"], r["id"]): r["position"] for r in keys.number_within(df, "k", "id").collect()}
    seen: dict = {}
    for r in ranked:
        assert per_key[r["k"], r["id"]] == seen.get(r["k"], 0)
        seen[r["k"]] = seen.get(r["k"], 0) + 1


def test_ranges_hold_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(keys, "BUCKET_ROWS", 100)
    monkeypatch.setattr(keys, "MAX_BUCKETS", 2)
    seen = {}
    plain = keys._numbered

    def watched(placed, name):
        seen["most"] = placed.groupBy("_bucket").count().agg(F.max("count")).first()[0]
        return plain(placed, name)

    monkeypatch.setattr(keys, "_numbered", watched)
    df = spark.range(5000).select((F.col("id") * 31 % 4999).alias("k"), "id")
    assert keys.global_position(df, "k").agg(F.max("position")).first()[0] == 4999
    assert seen["most"] <= 400
