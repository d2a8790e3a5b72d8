"""End-to-end jobs: each reads its inputs, runs one plan and writes its output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opinara.functions import text as T
from opinara.operators import aspects, factorization, keys, lexicon, lookup, pages, recommend, sentiment
from opinara.operators.aggregates import best_params
from opinara.operators.vectors import count_word_vectors, train_word_vectors
from opinara.sources import readers, writers
from opinara.streaming import messages


def aspects_job(
    spark: SparkSession,
    reviews: str,
    out: str,
    tag_lexicon: DataFrame | None = None,
    k: int = 5,
    single_file: bool = False,
) -> None:
    """Review text file to ``product <tab> [nouns]`` lines without header."""
    lists = aspects.aspect_lists(readers.read_reviews(spark, reviews), k, tag_lexicon=tag_lexicon)
    writers.write_delimited(lists, out, sep="\t", single_file=single_file)


def sentiment_job(
    spark: SparkSession,
    reviews: str,
    lexicon_path: str,
    out: str,
    rules: sentiment.Rules = sentiment.FULL,
    single_file: bool = False,
) -> None:
    """Review text file and lexicon to ``products,compoundscore`` with header."""
    words = lexicon.latest_entries(readers.read_lexicon(spark, lexicon_path))
    scores = sentiment.score_products(readers.read_reviews(spark, reviews), words, rules)
    named = scores.select(
        F.col("product_id").alias("products"), F.col("compound").alias("compoundscore")
    )
    writers.write_delimited(named, out, sep=",", header=True, single_file=single_file)


def dictionary_job(
    spark: SparkSession,
    corpus: str,
    lexicon_path: str,
    out: str,
    seed_word: str = "wide",
    skip: int = lexicon.SKIPPED_LINES,
    partitions: int | None = None,
    skip_gram: bool = False,
    **training: float,
) -> None:
    """Corpus lines to word vectors; the seed word's absent neighbours join a new lexicon version.

    The new version holds every line of the old file as it was. ``partitions`` deals out the lines of
    a corpus of few gzip files. Vectors come from co-occurrence counts; ``skip_gram`` trains them instead,
    with a vocabulary that fits the driver. ``training`` goes to the one or the other.
    """
    lines = readers.read_lines(spark, corpus, partitions)
    tokens = lines.select(T.simple_preprocess(F.col("value")).alias("tokens"))
    vectors = (train_word_vectors if skip_gram else count_word_vectors)(tokens, **training)
    old = readers.read_lexicon_lines(spark, lexicon_path)
    rows = lexicon.new_entries(lexicon.parse_lexicon(old), vectors, seed_word, skip=skip, lines=old)
    writers.write_lexicon(rows, out, lines=old)


def recommendation_job(
    spark: SparkSession,
    ratings: str,
    out: str,
    ranks: Sequence[int] = recommend.RANKS,
    regs: Sequence[float] = recommend.REG_PARAMS,
    final_iters: int = recommend.FINAL_ITERATIONS,
    k: int = recommend.TOP_ITEMS,
    parallelism: int = 2,
    serving: str | None = None,
    rounds: str | None = None,
) -> dict:
    """Ratings to the top items of every user with the best grid point; returns that point.

    The final fit runs ``final_iters`` rounds or until its factors stand still. With ``rounds`` they are kept
    in that folder, and a job that was stopped within the fit goes on from there.

    With ``serving`` user and item ids may be any text: they are mapped to numbers, and the tables
    ``recommendations``, ``users`` and ``products`` that :func:`lookup_job` reads go to that folder.
    """
    data = recommend.clean_ratings(readers.read_ratings(spark, ratings, keyed=serving is not None))
    if serving is not None:
        data, users = keys.map_ids(data.withColumnRenamed("user", "name"), "name", "user")
        data, products = keys.map_ids(data.withColumnRenamed("item", "product"), "product", "item")
        users.select(F.col("user").alias("user_id"), F.col("name").alias("user")).write.parquet(f"{serving}/users")
        products.select(F.col("item").alias("pro_id"), "product").write.parquet(f"{serving}/products")
    trials = recommend.tune_als(data, ranks, regs, parallelism=parallelism)
    best = best_params(trials).first()
    if best is None:
        raise ValueError("no grid point had a finite validation error")
    folder = rounds and f"{rounds}/rank-{best['rank']}-reg-{best['reg']}"
    model = factorization.fit_rounds(
        data, best["rank"], best["reg"], final_iters, recommend.FINAL_SEED, folder=folder
    )
    items = recommend.recommended_items(recommend.recommend_all(model, k))
    writers.write_recommendations(items, out)
    if serving is not None:
        served = items.select(F.col("user").alias("user_id"), F.col("recommended").alias("rec_prods"))
        writers.write_recommendations(served, f"{serving}/recommendations")
    return best.asDict()


def extraction_job(spark: SparkSession, fetched: str, out: str) -> None:
    """Fetched pages to product records as JSON lines."""
    records = pages.extract_products(readers.read_pages(spark, fetched))
    writers.write_products_json(records.drop("page_id"), out)


def publish_job(
    spark: SparkSession, fetched: str, options: dict[str, str], fmt: str = "kafka"
) -> None:
    """Fetched pages to messages, one record each."""
    records = pages.extract_products(readers.read_pages(spark, fetched))
    messages.publish(records.drop("page_id"), options, fmt)


def review_stream_job(
    spark: SparkSession,
    source: dict[str, str],
    checkpoint: str,
    out: str,
    fmt: str = "kafka",
    available_now: bool = True,
    time: str = "timestamp",
    horizon: str | None = None,
    rejected: str | None = None,
) -> StreamingQuery:
    """Messages to review rows, each product once.

    With ``horizon`` (such as "7 days") a product is forgotten that long after its message's ``time``,
    so the state stays bounded; without, every url is kept. ``rejected`` names a folder for messages
    that can't be read; a second query writes them.
    """
    raw = messages.read_review_stream(spark, source, fmt)
    decoded = messages.decode_messages(raw)
    rows = messages.stream_reviews(messages.first_products(decoded, time=time, horizon=horizon))
    if rejected:
        bad = messages.malformed_messages(raw)
        messages.run_stream(bad, f"{checkpoint}-rejected", path=rejected, available_now=available_now)
    return messages.run_stream(rows, checkpoint, path=out, available_now=available_now)


def lookup_job(spark: SparkSession, base: str, wanted: DataFrame | None = None) -> DataFrame:
    """Serving tables to the titled recommendations of all users, or of those wanted."""
    t = readers.read_serving(spark, base)
    # The serving table keeps no order of its titles, so a product with several shows the greatest.
    titles = t["titles"].groupBy("movie").agg(F.max("title").alias("title"))
    return lookup.recommendation_report(
        t["recommendations"], t["users"], t["products"], titles, wanted
    )
