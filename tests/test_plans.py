"""Shapes of the physical plans that large inputs depend on."""

import pytest
from pyspark.sql import functions as F

from opinara.functions import text as T
from opinara.operators import aggregates as A
from opinara.operators import aspects, sentiment
from opinara.plans import catalog, tables


@pytest.fixture(scope="module")
def reviews(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "reviews")
    spark.range(50).select(
        F.col("id").alias("review_id"),
        F.concat(F.lit("p"), F.col("id") % 3).alias("product_id"),
        F.lit("a good plot").alias("review_text"),
        F.lit("x").alias("zz_spare"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.sql("SELECT * FROM VALUES ('good', 1.9) AS t(token, valence)")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_aspects_two_shuffles_ranked_before_the_second(reviews):
    text = plan(aspects.top_aspects(reviews))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("WindowGroupLimit") == 2
    assert "Python" not in text and "Arrow" not in text
    assert text.count("regexp_extract_all(") == 1
    assert "zz_spare" not in text


def test_sentiment_one_shuffle_of_review_rows(reviews, lexicon):
    text = plan(sentiment.score_reviews(reviews, lexicon, sentiment.FULL))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange SinglePartition") == 0
    assert text.count("BroadcastHashJoin") == 4
    assert "Window" not in text and "Python" not in text


def test_product_sentiment_sums_before_each_shuffle(reviews, lexicon):
    text = plan(sentiment.score_products(reviews, lexicon))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_sum") == 2


def test_tokens_are_computed_once(reviews):
    tokens = reviews.select("review_id", T.tokenize(F.col("review_text")).alias("tokens"))
    for df in (aspects.tag_tokens(tokens), A.vocabulary(tokens, "tokens")):
        assert plan(df).count("regexp_extract_all(") == 1


def test_a_large_lexicon_moves_short_rows(reviews, lexicon):
    rows = sentiment._packed_rows(reviews, ["review_id"], "review_text", sentiment.FULL)
    assert [name for name, kind in rows.dtypes if kind not in ("bigint", "int", "double")] == ["w"]
    text = plan(sentiment.score_reviews(reviews, lexicon, sentiment.FULL, large=True))
    moved = [line for line in text.splitlines() if "Window [" in line]
    assert len(moved) == 1 and not any(f"{c}#" in moved[0] for c in ("p1", "p2", "p3", "n1", "n2", "lows"))


def test_lexicons_of_the_tables_are_files(spark):
    """Their size is known before tokens are joined with them, however large the tables they come from."""
    for frame in (tables.word_lexicon(spark, "/root/testdata/sf0.001"), catalog._learned(spark, "/root/testdata/sf0.001")):
        text = plan(frame)
        assert "FileScan parquet" in text and "Aggregate" not in text and "Exchange" not in text


def test_basic_rules_need_no_arrays_of_words(reviews, lexicon):
    text = plan(sentiment.score_reviews(reviews, lexicon, sentiment.BASIC))
    assert "transform(" not in text and "filter(split" not in text
