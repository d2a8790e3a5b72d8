"""Aspect extraction: the most frequent nouns over all reviews of a product."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import text as T
from opinara.functions.words import MARKUP_TOKENS, PUNCTUATION, STOP_WORDS
from opinara.operators.aggregates import explode_rows, term_lists, top_terms

Tagger = Callable[[Column], Column]


def build_tag_lexicon(tagged: DataFrame, word: str = "word", tag: str = "tag") -> DataFrame:
    """``word, tag``: the most frequent tag of every word; ties go to the first tag by name."""
    counts = tagged.groupBy(word, tag).agg(F.count(F.lit(1)).alias("n"))
    # Group sizes here are bounded by the tag set. Taken out of a struct, the words are a plain side
    # of a later join, which Spark shuffles by itself and can split at a hot word.
    entry = F.struct(F.col(word).alias("word"), F.col(tag).alias("tag"))
    best = counts.groupBy(word).agg(F.min_by(entry, F.struct(-F.col("n"), F.col(tag))).alias("e"))
    return best.select("e.word", "e.tag")


def attach_tags(words: DataFrame, tag_lexicon: DataFrame | None, word: str = "word") -> DataFrame:
    """Add ``tag`` to one row per word: the lexicon's tag, else the back-off rules.

    The join carries no hint: Spark broadcasts the lexicon if its size allows and otherwise
    shuffles both sides with skew handling.
    """
    words = words.withColumn("_low", F.lower(F.col(word)))
    guess = T.default_tag(F.col(word), F.col("_low"))
    if tag_lexicon is None:
        return words.withColumn("tag", guess).drop("_low")
    known = tag_lexicon.select(F.col("word").alias(word), F.col("tag").alias("_known"))
    return (
        words.join(known, word, "left")
        .withColumn("tag", F.coalesce("_known", guess))
        .drop("_known", "_low")
    )


def tag_tokens(
    df: DataFrame, tokens: str = "tokens", tag_lexicon: DataFrame | None = None
) -> DataFrame:
    """One row per token, with ``pos`` (from 0), ``word`` and ``tag``."""
    return attach_tags(explode_rows(df, tokens, "pos", "word"), tag_lexicon)


def tag_array(tokens: Column, tagger: Tagger = T.default_tag) -> Column:
    """``array<struct<word,tag>>`` without leaving the row; ``tagger`` maps a word to its tag."""
    return F.transform(tokens, lambda w: F.struct(w.alias("word"), tagger(w).alias("tag")))


def review_words(
    text: Column, stop_words: Sequence[str] = STOP_WORDS, lower: bool = False
) -> Column:
    return T.remove_punctuation(T.remove_stopwords(T.tokenize(text, lower), stop_words))


def noun_counts(
    reviews: DataFrame,
    tag_lexicon: DataFrame | None = None,
    stop_words: Sequence[str] = STOP_WORDS,
    lower: bool = False,
) -> DataFrame:
    """``product_id, term, n``; products without nouns keep a row with a null term.

    Stop words and marks are dropped as the tokens are exploded, where the test is generated code;
    they become null terms, which are never counted. A word's tag does not depend on its place, so
    words are counted first and each distinct (product, word) is tagged once: the tag join sees
    counts, not tokens.
    """
    dropped = [*stop_words, *PUNCTUATION, *MARKUP_TOKENS]
    tokens = reviews.where(F.col("product_id").isNotNull()).select(
        "product_id", F.explode_outer(T.tokenize(F.col("review_text"), lower)).alias("token")
    )
    counts = (
        tokens.select("product_id", F.when(~F.col("token").isin(dropped), F.col("token")).alias("term"))
        .groupBy("product_id", "term")
        .agg(F.count("term").alias("n"))
    )
    tagged = attach_tags(counts, tag_lexicon, "term")
    noun = T.is_noun(F.col("tag")) & F.col("term").isNotNull()
    return tagged.select(
        "product_id", F.when(noun, F.col("term")).alias("term"), F.when(noun, F.col("n")).alias("n")
    )


def top_aspects(reviews: DataFrame, k: int = 5, **options) -> DataFrame:
    """``product_id, rank, term, n`` with at most k rows per product."""
    ranked = top_terms(noun_counts(reviews, **options), "product_id", k)
    return ranked.where(F.col("term").isNotNull())


def aspect_lists(reviews: DataFrame, k: int = 5, **options) -> DataFrame:
    """``product_id, noun``: at most k nouns, most frequent first; an empty list if none."""
    return term_lists(top_terms(noun_counts(reviews, **options), "product_id", k), "product_id")
