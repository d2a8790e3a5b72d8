"""Inputs of the catalogue: the given tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.functions import cleaning as C
from opinara.operators import aggregates as A
from opinara.operators.sentiment import Rules
from opinara.session import written
from opinara.sources.readers import spread

TOP_ITEMS = 10

# A small lexicon and stand-in modifiers made of words that occur in the texts.
LEXICON = {
    "the": 1.9, "th": -1.5, "er": 2.3, "re": -0.8, "nd": 1.1, "en": -2.4, "le": 0.7, "der": -1.2,
    "que": 1.4, "thth": 3.1, "an": -0.6, "ble": 2.2, "ea": 0.9, "est": -3.0, "y": 1.3, "los": -1.1,
}
RULES = dict(
    negations=("of", "de", "nt"),
    boosters=("and", "la", "ti", "ea"),
    dampeners=("to", "un", "ly"),
    dampener_pairs=("in the", "er th"),
    idioms={"on the": 3.0, "the the": -2.0, "of the th": 1.5, "is th": 2.5},
    but="is",
    never="that",
    intensive=("it", "in"),
    least="for",
    least_exempt=("was", "as"),
)


def rules(context: bool = True, emphasis: bool = True, special: bool = True) -> Rules:
    return Rules(context=context, emphasis=emphasis, special=special, **RULES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A text table for work that costs far more than its scan.

    The given tables are files of one row group, which one task reads; a corpus of many splits is
    read without this step.
    """
    return spread(table(spark, sf_dir, name).select(*columns))


def inline_lexicon(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{t}', {v})" for t, v in LEXICON.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(token, valence)")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents", "doc_id", "source", "text").select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("product_id"),
        F.col("text").alias("review_text"),
    )


def holed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with null sources and orders, and with every seventh row twice."""
    docs = table(spark, sf_dir, "documents").select(
        F.nullif("source", F.lit("src3")).alias("source"),
        F.when(F.col("doc_id") % 11 != 5, F.col("doc_id")).alias("doc_id"),
        F.when(F.col("doc_id") % 11 != 5, F.col("lang")).alias("lang"),
        F.when(F.col("doc_id") % 11 != 5, F.col("text")).alias("text"),
    )
    return docs.unionByName(docs.where(F.col("doc_id") % 7 == 0))


def word_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the conversations with a valence made of its length.

    Written down, as a lexicon is a file: Spark then knows its size before the tokens are joined with it.
    """
    words = table(spark, sf_dir, "conversations").select(
        F.explode(F.split(F.lower("text"), r"[\s\p{Z}]+")).alias("token")
    )
    kept = words.where(F.length("token") > 1).distinct()
    return written(kept.withColumn("valence", (F.length("token") * 7 % 9 - 4) / F.lit(2.0)))


def item_of(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("user"),
        item_of(F.col("props")).alias("item"),
        F.col("value").alias("rating"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user, item, rating``: the mean value per pair."""
    return A.mean_value(raw_ratings(spark, sf_dir), ["user", "item"], "rating", scale=6)


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user, recommendations array<struct<item,rating>>``: ten items per user by summed value."""
    exact = F.sum(F.col("rating").cast("decimal(18,6)")).cast("double").alias("rating")
    sums = raw_ratings(spark, sf_dir).groupBy("user", "item").agg(exact)
    best = Window.partitionBy("user").orderBy(F.desc("rating"), "item")
    top = sums.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP_ITEMS)
    entries = F.array_sort(F.collect_list(F.struct("rank", "item", "rating")))
    pairs = F.transform(entries, lambda e: F.struct(e["item"].alias("item"), e["rating"].alias("rating")))
    return top.groupBy("user").agg(pairs.alias("recommendations"))


def recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommendations(spark, sf_dir).select(
        F.col("user").alias("user_id"), F.col("recommendations")["item"].alias("rec_prods")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("user_id"), F.col("c_name").alias("user")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("pro_id"),
        F.concat(F.lit("P"), F.col("p_partkey")).alias("product"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles for some of the products only: the nations lend their names."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("P"), F.col("n_nationkey")).alias("movie"), F.col("n_name").alias("title")
    )


def lexicon_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts as tab-separated lexicon lines."""
    part = table(spark, sf_dir, "part")
    valence = (F.col("p_size") / F.lit(10)).cast("decimal(5,2)")
    sd = (F.col("p_size") * F.lit(2)).cast("decimal(8,2)") / F.lit(100)
    return part.select(
        (F.col("p_partkey") + 1).alias("line_no"),
        F.concat_ws(
            "\t", "p_name", valence.cast("string"), sd.cast("double").cast("string"), "p_brand"
        ).alias("value"),
    )


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("w"), F.col("vec_id")).alias("word"), F.col("embedding").alias("vector")
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (
        F.when(F.col("page_id") % 10 == 0, 404).when(F.col("page_id") % 10 == 1, 503).otherwise(200)
    )
    return table(spark, sf_dir, "pages").withColumn("status", status.cast("int"))


def _escaped(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def shop_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a shop page: one review block per line, histogram, name and price."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")

    def block(line: Column, i: Column) -> Column:
        hidden = _escaped(F.to_json(F.struct(F.concat(F.lit("<b>+"), F.col("lang"), F.lit("</b>")).alias("rest"))))
        return F.concat(
            F.lit('<div class="r" data-hook="review"><span class="a-profile-name">by <b>'),
            F.col("source"),
            F.lit('</b></span><i data-hook="review-star-rating">'),
            (i % 5 + 1).cast("string"),
            F.lit(' out of 5 stars</i><a data-hook="review-title" href="#">line '),
            i.cast("string"),
            F.lit('</a><span data-hook="review-date">on January '),
            (i % 28 + 1).cast("string"),
            F.lit(', 2018</span><div data-hook="review-collapsed"><p>'),
            _escaped(line),
            F.lit("<p></div>"),
            F.when(
                i % 3 == 0,
                F.concat(
                    F.lit('<div><span data-action="columnbalancing-showfullreview" '
                          'data-columnbalancing-showfullreview="'),
                    hidden,
                    F.lit('"></span></div>'),
                ),
            ).otherwise(F.lit("")),
            F.lit('<span data-hook="review-comment">'),
            i.cast("string"),
            F.lit(" comments</span></div>"),
        )

    blocks = F.transform(F.split("text", "\n"), block)
    html = F.concat(
        F.lit('<html><body><h1 id="t"><span id="productTitle"> '),
        F.col("source"),
        F.lit(' </span></h1><span id="priceblock_ourprice">$'),
        F.format_number("n_chars", 2),
        F.lit('</span><table id="histogramTable"><tr><td><a href="#">5 star</a></td><td><a>'),
        (F.col("n_chars") % 100).cast("string"),
        F.lit('%</a></td></tr><tr><td>no link</td></tr><tr><td><a>1 star</a><td><a>7%</a></table>'),
        F.array_join(blocks, ""),
        F.lit("</body></html>"),
    )
    return docs.select(
        F.col("doc_id").alias("page_id"),
        C.product_url(F.col("doc_id").cast("string")).alias("url"),
        F.lit(200).alias("status"),
        html.alias("html"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as product records: one review each, error events as error records."""
    events = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    none = F.lit(None).cast("string")
    review = F.struct(
        none.alias("review_comment_count"),
        F.col("props").alias("review_text"),
        none.alias("review_posted_date"),
        F.col("event_type").alias("review_header"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("review_rating"),
        F.col("user_id").cast("string").alias("review_author"),
    )
    return events.select(
        "event_id",
        C.product_url(F.col("user_id").cast("string")).alias("url"),
        F.when(~failed, F.col("event_type")).alias("name"),
        F.when(~failed, F.col("value").cast("decimal(12,2)").cast("string")).alias("price"),
        F.when(~failed, F.create_map(F.lit("k"), item_of(F.col("props")).cast("string"))).alias(
            "ratings"
        ),
        F.when(~failed, F.array(review)).alias("reviews"),
        F.when(failed, F.lit("page not found")).alias("error"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_records(spark, sf_dir)
    fields = [c for c in records.columns if c != "event_id"]
    return records.select("event_id", F.to_json(F.array(F.struct(*fields))).alias("value"))
