"""The query catalogue: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara import schemas
from opinara.functions import cleaning as C
from opinara.functions import text as T
from opinara.operators import aggregates as A
from opinara.operators import aspects, factorization, joins, keys, lexicon, lookup, pages, recommend, sentiment
from opinara.operators import vectors as V
from opinara.plans import tables as t
from opinara.session import written
from opinara.sources import readers
from opinara.streaming import messages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED_WORD = "w7"
PART_SIZE = 16


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _fingerprint(tokens: Column) -> list[Column]:
    return [F.size(tokens).alias("n"), F.md5(F.array_join(tokens, " ")).alias("digest")]


# ---- sources -------------------------------------------------------------------------------


@query
def pages_scan(spark, d):
    return t.table(spark, d, "pages").select("page_id", "url", F.length("html").alias("n_chars"))


@query
def ratings_scan(spark, d):
    return t.ratings(spark, d)


@query
def lexicon_scan(spark, d):
    return lexicon.parse_lexicon(t.lexicon_lines(spark, d)).withColumn(
        "valence", F.col("valence").cast("double")
    )


@query
def review_records(spark, d):
    """All documents rendered as blocks of ``key: value`` lines and parsed back."""
    docs = t.texts(spark, d, "documents", "doc_id", "source", "text")
    block = F.concat(
        F.lit("product/productId: "),
        F.col("source"),
        F.lit("\nreview/userId: u\nreview/text: "),
        F.translate("text", "\n", " "),
        F.lit("\n"),
    )
    records = readers.parse_review_blocks(
        docs.select(F.col("doc_id").alias("review_id"), block.alias("value"))
    )
    return records.select(
        "review_id",
        "product_id",
        F.length("review_text").alias("n_chars"),
        F.md5("review_text").alias("digest"),
    )


# ---- predicates and projections --------------------------------------------------------------


def _lines(spark, d):
    docs = t.table(spark, d, "documents")
    return docs.select(
        "doc_id",
        F.explode(
            F.array(
                F.concat(F.lit("product/productId: "), F.col("source")),
                F.concat(F.lit("review/text: "), F.col("text")),
            )
        ).alias("line"),
    )


@query
def filter_contains(spark, d):
    kept = A.filter_contains(_lines(spark, d), "line", "review/text: ")
    return kept.select("doc_id", F.md5("line").alias("digest"))


@query
def strip_prefix(spark, d):
    stripped = T.strip_key(T.strip_key(F.col("line"), "review/text: "), "product/productId: ")
    return _lines(spark, d).select("doc_id", F.md5(stripped).alias("digest"))


@query
def clean_ratings(spark, d):
    holed = t.raw_ratings(spark, d).select(
        F.nullif("user", F.lit(3)).alias("user"), F.nullif("item", F.lit(7)).alias("item"), "rating"
    )
    return recommend.clean_ratings(holed)


@query
def array_to_text(spark, d):
    keys_ = F.array("l_orderkey", "l_partkey", "l_suppkey")
    return t.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", T.array_to_text(keys_).alias("keys")
    )


@query
def map_ids(spark, d):
    mapped, _ = keys.map_ids(t.table(spark, d, "customer"), "c_name", "user")
    return mapped.select("c_custkey", "user")


# ---- joins -----------------------------------------------------------------------------------


@query
def full_outer_join(spark, d):
    def per_day(name, column, count):
        day = F.date_format(column, "yyyy-MM-dd").alias("day")
        return t.table(spark, d, name).groupBy(day).agg(F.count(F.lit(1)).alias(count))

    return joins.full_outer_join(
        per_day("orders", "o_orderdate", "n_ordered"),
        per_day("lineitem", "l_shipdate", "n_shipped"),
        "day",
    )


@query
def recs_join_users(spark, d):
    joined = lookup.recs_with_users(t.recs(spark, d), t.users(spark, d))
    return joined.withColumn("rec_prods", T.array_to_text(F.col("rec_prods")))


@query
def recs_for_user(spark, d):
    one = lookup.recs_for_user(t.recs(spark, d), t.users(spark, d), 7)
    return one.withColumn("rec_prods", T.array_to_text(F.col("rec_prods")))


@query
def recommended_products(spark, d):
    return lookup.recommended_products(t.recs(spark, d), t.products(spark, d))


@query
def recommended_products_text(spark, d):
    """The same from lists stored as text."""
    stored = t.recs(spark, d).withColumn("rec_prods", T.array_to_text(F.col("rec_prods")))
    return lookup.recommended_products(stored, t.products(spark, d))


@query
def keyed_ratings(spark, d):
    """Ratings whose users and items are texts, mapped to numbers."""
    named = t.ratings(spark, d).select(
        F.concat(F.lit("u"), "user").alias("name"), F.concat(F.lit("i"), "item").alias("thing"), "rating"
    )
    by_user, _ = keys.map_ids(named, "name", "user")
    return keys.map_ids(by_user, "thing", "item")[0]


@query
def titles_with_default(spark, d):
    return lookup.with_titles(t.products(spark, d), t.titles(spark, d))


@query
def recommendation_report(spark, d):
    return lookup.recommendation_report(
        t.recs(spark, d), t.users(spark, d), t.products(spark, d), t.titles(spark, d)
    )


@query
def title_dedup(spark, d):
    named = t.table(spark, d, "part").select(
        F.col("p_name").alias("movie"),
        F.concat_ws(" ", "p_brand", "p_type").alias("title"),
        "p_partkey",
    )
    return lookup.title_dedup(named, "p_partkey")


# ---- aggregations ----------------------------------------------------------------------------


@query
def group_collect(spark, d):
    parts = A.group_collect(t.holed_documents(spark, d), "source", "lang", "doc_id", PART_SIZE)
    return parts.select("source", "part", F.array_join("values", ",").alias("langs"))


@query
def concat_reviews(spark, d):
    docs = t.holed_documents(spark, d).select(
        F.col("doc_id").alias("review_id"), F.col("source").alias("product_id"), F.col("text").alias("review_text")
    )
    parts = A.concat_reviews(docs, part_size=PART_SIZE)
    return parts.select("product_id", "part", F.md5("reviews").alias("digest"))


@query
def term_counts(spark, d):
    words = t.reviews(spark, d).select("product_id", T.tokenize(F.col("review_text")).alias("words"))
    return A.term_counts(words, "product_id", "words")


@query
def flatten_lists(spark, d):
    lines = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    return t.texts(spark, d, "documents", "doc_id", "text").select("doc_id", *_fingerprint(T.flatten_lists(lines)))


@query
def distinct_products(spark, d):
    return A.distinct_values(t.reviews(spark, d), "product_id")


def _errors_by_type(spark, d):
    pairs = t.table(spark, d, "events").select("event_type", "value", F.lit(50.0).alias("guess"))
    return A.rmse(pairs, "value", "guess", ["event_type"])


@query
def rmse(spark, d):
    return _errors_by_type(spark, d).withColumn("rmse", F.round("rmse", 6))


@query
def best_params(spark, d):
    best = A.best_params(_errors_by_type(spark, d), "rmse", "event_type")
    return best.withColumn("rmse", F.round("rmse", 6))


@query
def rating_histogram(spark, d):
    """Shares of the order priorities per market segment, as the map of a page."""
    orders = t.table(spark, d, "orders").select("o_custkey", "o_orderpriority")
    segments = t.table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("url")
    )
    counts = (
        orders.join(segments, "o_custkey")
        .groupBy("url", F.col("o_orderpriority").alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One entry per priority, so the lists are short whatever the data size.
    page = counts.groupBy("url").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("key", "n")).alias("entries")
    )
    shares = F.transform(
        "entries",
        lambda e: F.struct(
            e["key"].alias("key"),
            F.concat(F.floor(e["n"] * 100 / F.col("total")).cast("string"), F.lit("%")).alias("value"),
        ),
    )
    return pages.rating_histogram(page.select("url", C.rating_map(shares).alias("ratings")))


def _corpus(spark, d):
    return t.texts(spark, d, "documents", "doc_id", "text").select(
        "doc_id", T.simple_preprocess(F.col("text")).alias("tokens")
    )


@query
def vocabulary(spark, d):
    return A.vocabulary(_corpus(spark, d), "tokens", 2)


@query
def top_aspects(spark, d):
    return aspects.top_aspects(t.reviews(spark, d))


@query
def top_aspects_learned(spark, d):
    """Aspects tagged with the lexicon learned from the conversations."""
    learned = _learned(spark, d)
    return aspects.top_aspects(t.reviews(spark, d), tag_lexicon=learned)


@query
def aspect_lists(spark, d):
    lists = aspects.aspect_lists(t.reviews(spark, d))
    return lists.withColumn("noun", T.array_to_text(F.col("noun")))


# ---- text ------------------------------------------------------------------------------------


@query
def tokenize(spark, d):
    return t.texts(spark, d, "documents", "doc_id", "text").select("doc_id", *_fingerprint(T.tokenize(F.col("text"))))


@query
def remove_stopwords(spark, d):
    kept = T.remove_stopwords(T.tokenize(F.col("text")))
    return t.texts(spark, d, "documents", "doc_id", "text").select("doc_id", *_fingerprint(kept))


@query
def remove_punctuation(spark, d):
    kept = T.remove_punctuation(T.tokenize(F.col("text")))
    return t.texts(spark, d, "documents", "doc_id", "text").select("doc_id", *_fingerprint(kept))


def _tagged(spark, d, name):
    """Lower-cased words with the tag of their spelling, as a tagged corpus."""
    tokens = t.texts(spark, d, name, "text").select(T.tokenize(F.col("text")).alias("tokens"))
    words = A.explode_rows(tokens, "tokens", "pos", "w")
    return words.select(F.lower("w").alias("word"), T.default_tag(F.col("w")).alias("tag"))


def _learned(spark, d):
    """The tag lexicon of the conversations, written down, so that Spark knows its size before the tokens join it."""
    return written(aspects.build_tag_lexicon(_tagged(spark, d, "conversations")))


@query
def tag_lexicon(spark, d):
    return aspects.build_tag_lexicon(_tagged(spark, d, "documents"))


@query
def tag_tokens(spark, d):
    """Documents tagged with the lexicon learned from the conversations."""
    learned = _learned(spark, d)
    tokens = t.texts(spark, d, "documents", "doc_id", "text").select(
        "doc_id", aspects.review_words(F.col("text")).alias("tokens")
    )
    tagged = aspects.tag_tokens(tokens, "tokens", learned)
    return tagged.groupBy("doc_id", "tag").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("word")).alias("char_sum"),
        F.sum(F.col("pos").cast("bigint")).alias("pos_sum"),
        F.sum(F.col("pos").cast("bigint") * F.length("word")).alias("mixed_sum"),
    )


@query
def extract_nouns(spark, d):
    tokens = aspects.review_words(F.col("text"))
    nouns = T.extract_nouns(aspects.tag_array(tokens))
    return t.texts(spark, d, "documents", "doc_id", "text").select("doc_id", *_fingerprint(nouns))


@query
def simple_preprocess(spark, d):
    return _corpus(spark, d).select("doc_id", *_fingerprint(F.col("tokens")))


# ---- sentiment -------------------------------------------------------------------------------


def _scores(spark, d, rules):
    return sentiment.score_reviews(t.reviews(spark, d), t.inline_lexicon(spark), rules)


@query
def sentiment_basic(spark, d):
    return _scores(spark, d, t.rules(context=False, emphasis=False, special=False))


@query
def sentiment_context(spark, d):
    return _scores(spark, d, t.rules(emphasis=False, special=False))


@query
def sentiment_emphasis(spark, d):
    return _scores(spark, d, t.rules(special=False))


@query
def sentiment_full(spark, d):
    return _scores(spark, d, t.rules())


@query
def sentiment_table_lexicon(spark, d):
    """With a lexicon taken from a table: the words of the conversations."""
    rules = t.rules(context=False, emphasis=False, special=False)
    return sentiment.score_reviews(t.reviews(spark, d), t.word_lexicon(spark, d), rules)


@query
def sentiment_table_full(spark, d):
    """All rules with that lexicon, taken as too large to send to every task."""
    return sentiment.score_reviews(t.reviews(spark, d), t.word_lexicon(spark, d), t.rules(), large=True)


@query
def product_sentiment(spark, d):
    return sentiment.score_products(t.reviews(spark, d), t.inline_lexicon(spark), t.rules())


@query
def conversation_sentiment(spark, d):
    turns = t.texts(spark, d, "conversations", "conv_id", "turn", "text").select(
        F.col("turn").alias("review_id"),
        F.col("conv_id").cast("string").alias("product_id"),
        F.col("text").alias("review_text"),
    )
    return sentiment.score_products(turns, t.inline_lexicon(spark), t.rules())


# ---- lexicon and vectors ---------------------------------------------------------------------


def _part_lexicon(spark, d):
    return lexicon.parse_lexicon(t.lexicon_lines(spark, d))


@query
def nearest_vectors(spark, d):
    near = V.similar_words(t.word_vectors(spark, d), SEED_WORD, 10)
    return near.withColumn("similarity", F.round("similarity", 6))


@query
def nearest_lexicon_row(spark, d):
    row = lexicon.nearest_row(_part_lexicon(spark, d))
    return row.withColumn("valence", F.col("valence").cast("double"))


@query
def lexicon_latest(spark, d):
    rows = lexicon.latest_entries(_part_lexicon(spark, d))
    return rows.withColumn("valence", F.col("valence").cast("double"))


def _words(spark, d):
    return A.vocabulary(_corpus(spark, d), "tokens", 2).select("word")


@query
def lexicon_missing_words(spark, d):
    known = _part_lexicon(spark, d)
    missing = [
        lexicon.missing_words(_words(spark, d), known, mode).select("word", F.lit(mode).alias("mode"))
        for mode in ("token", "substring")
    ]
    return missing[0].unionByName(missing[1])


def _proposals(spark, d):
    known = _part_lexicon(spark, d)
    fresh = lexicon.missing_words(_words(spark, d), known)
    return lexicon.propose_entries(fresh, lexicon.nearest_row(known))


@query
def lexicon_proposals(spark, d):
    return _proposals(spark, d).withColumn("valence", F.col("valence").cast("double"))


@query
def lexicon_append(spark, d):
    grown = lexicon.append_lexicon(_part_lexicon(spark, d).drop("line_no"), _proposals(spark, d))
    return grown.withColumn("valence", F.col("valence").cast("double"))


@query
def grow_lexicon(spark, d):
    grown = lexicon.grow_lexicon(_part_lexicon(spark, d), t.word_vectors(spark, d), SEED_WORD)
    return grown.withColumn("valence", F.col("valence").cast("double"))


def _named(frame, kept, *columns):
    """Ids replaced by their words."""
    for c in columns:
        names = kept.select(F.col("id").alias(c), F.col("word").alias(f"_{c}"))
        frame = frame.join(names, c).drop(c).withColumnRenamed(f"_{c}", c)
    return frame


@query
def word_cooccurrences(spark, d):
    """Per word: how many words stand near it, how often, and the one that does most."""
    kept, texts = V.numbered_texts(_corpus(spark, d))
    low = (1 << 31) - 1
    # One number, which is added up in place; a struct would be sorted. The smaller id wins, more than 2^32 times fail.
    best = F.max(F.col("times") * (low + 1) + (F.lit(low) - F.col("other"))).alias("best")

    def counted(pairs):
        return V.mirrored(pairs).groupBy("word").agg(F.count(F.lit(1)).alias("n_others"), F.sum("times").alias("times"), best)

    found = V.over_pairs(texts, counted).groupBy("word")
    found = found.agg(F.sum("n_others").alias("n_others"), F.sum("times").alias("times"), F.max("best").alias("best"))
    other = (F.lit(low) - F.col("best").bitwiseAND(low)).cast("int")
    named = _named(found.select("word", "n_others", "times", other.alias("other")), kept, "word", "other")
    return named.select("word", "n_others", "times", F.col("other").alias("nearest"))


@query
def word_information(spark, d):
    """Per word: its positive information weights, how many, their sum and the largest."""
    kept, texts = V.numbered_texts(_corpus(spark, d))
    totals = written(V.pair_totals(texts))

    def weighed(pairs):
        weights = V.mirrored(V.positive_information(pairs, 5.0, totals)).groupBy("word")
        return weights.agg(F.count(F.lit(1)).alias("n_weights"), F.sum("weight").alias("total"), F.max("weight").alias("largest"))

    found = V.over_pairs(texts, weighed).groupBy("word").agg(
        F.sum("n_weights").alias("n_weights"), F.round(F.sum("total"), 4).alias("total"), F.round(F.max("largest"), 6).alias("largest")
    )
    return _named(found, kept, "word")


@query
def word_vectors(spark, d):
    """Ten rounds over all co-occurrence weights; the words that have any, and whether their vectors are numbers."""
    vectors = V.count_word_vectors(_corpus(spark, d))
    finite = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6))
    return vectors.select("word", F.size("vector").alias("dim"), (finite & F.exists("vector", lambda x: x != 0)).alias("is_vector"))


# ---- pages -----------------------------------------------------------------------------------


def _flat_pages(spark, d):
    html = F.col("html")
    return t.texts(spark, d, "pages", "page_id", "html").select(
        "page_id",
        pages.flat_piece(html, "h1").alias("name"),
        pages.flat_blocks(html, r"(?s)<p><b>(.*?)<br>", r"(?s)<p>(.*?)</p>").alias("blocks"),
    )


@query
def page_products(spark, d):
    return _flat_pages(spark, d).select("page_id", "name", *_fingerprint(F.col("blocks")))


@query
def page_reviews(spark, d):
    blocks = _flat_pages(spark, d).select("page_id", "blocks")
    return A.explode_rows(blocks, "blocks", "pos", "review_text")


@query
def page_records(spark, d):
    """Nested extraction from shop pages: one row per review."""
    found = pages.extract_products(t.shop_pages(spark, d))
    return pages.extract_reviews(found).withColumn("review_text", F.md5("review_text"))


@query
def page_record_heads(spark, d):
    found = pages.extract_products(t.shop_pages(spark, d))
    ratings = F.array_sort(F.map_entries("ratings"))
    shown = F.transform(ratings, lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.select(
        "url", "name", "price", F.array_join(shown, ",").alias("ratings"),
        F.size("reviews").alias("n_reviews"), "error",
    )


@query
def review_text_rule(spark, d):
    collapsed = F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.col("text"))
    rest = F.concat(F.lit("<b>"), F.col("source"), F.lit("</b> more"))
    hidden = F.when(F.col("doc_id") % 3 == 0, F.to_json(F.struct(rest.alias("rest"))))
    rule = C.review_text_rule(collapsed, hidden, F.concat(F.lit("  "), F.col("text")))
    return t.table(spark, d, "documents").select("doc_id", F.md5(rule).alias("digest"))


@query
def clean_text(spark, d):
    return t.table(spark, d, "pages").select(
        "page_id", F.md5(C.clean_text(F.col("html"))).alias("digest")
    )


@query
def page_errors(spark, d):
    return pages.page_errors(t.pages(spark, d))


@query
def product_url(spark, d):
    key = F.col("p_partkey").cast("string")
    return t.table(spark, d, "part").select("p_partkey", C.product_url(key).alias("url"))


@query
def parse_price(spark, d):
    raw = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return t.table(spark, d, "orders").select("o_orderkey", C.parse_price(raw).alias("price"))


@query
def parse_stars(spark, d):
    raw = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" out of 5 stars"))
    return t.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        C.parse_stars(raw).alias("stars"),
        C.stars_value(raw).alias("stars_value"),
    )


@query
def normalize_date(spark, d):
    """Each order's date in one of twelve spellings, and two that are no dates."""
    shapes = [
        "MMMM d, yyyy", "d MMM yyyy", "yyyy-MM-dd", "EEEE, MMMM d, yyyy", "d-MMM-yyyy", "yyyy-MM-dd'T'HH:mm:ss",
        "yyyyMMdd", "MMMM d, yyyy h:mm a", "MM/dd/yyyy", "EEE d MMM yyyy", "MMM. d, yyyy", "yyyy/MM/dd",
    ]
    spelled = F.when(F.col("o_orderkey") % 14 == 12, F.lit("not a date"))
    for i, shape in enumerate(shapes):
        spelled = spelled.when(F.col("o_orderkey") % 14 == i, F.date_format("o_orderdate", shape))
    spelled = spelled.otherwise(F.date_format("o_orderdate", "MMMM yyyy"))
    return t.table(spark, d, "orders").select(
        "o_orderkey", C.normalize_date(spelled).alias("posted")
    )


@query
def comment_count(spark, d):
    raw = F.concat(F.col("user_id").cast("string"), F.lit(" comments"))
    return t.table(spark, d, "events").select(
        "event_id", C.parse_comment_count(raw).alias("comments")
    )


# ---- messages --------------------------------------------------------------------------------


@query
def publish_payload(spark, d):
    docs = t.table(spark, d, "documents").select("doc_id", "source", "text")
    return messages.payload(docs)


def _decoded(spark, d):
    return messages.decode_messages(t.event_messages(spark, d), schemas.MESSAGE)


@query
def stream_decode(spark, d):
    return _decoded(spark, d).select(
        "event_id", "url", "name", "price", F.col("ratings")["k"].alias("k"),
        F.size("reviews").alias("n_reviews"), "error",
    )


@query
def stream_dedup(spark, d):
    latest = messages.latest_products(_decoded(spark, d), "event_id")
    return latest.select("event_id", "url", "name", "price", "error")


@query
def stream_reviews(spark, d):
    flat = messages.stream_reviews(_decoded(spark, d))
    return flat.select(
        "url", "name", "pos", "review_text", "review_header", "review_rating", "review_author"
    )


# ---- models ----------------------------------------------------------------------------------


@query
def split_ratings(spark, d):
    train, valid = recommend.split_ratings(t.ratings(spark, d))
    return train.withColumn("part", F.lit("train")).unionByName(
        valid.withColumn("part", F.lit("valid"))
    )


def _model(spark, d):
    """The grid's first rank and the tuning's iterations; the final fit of 1000 takes too long here."""
    return recommend.fit_als(
        t.ratings(spark, d), rank=recommend.RANKS[0], iters=recommend.TUNING_ITERATIONS, seed=recommend.FINAL_SEED
    )


def _factors(frame, name):
    return frame.select(F.col("id").alias(name), F.col("features").alias(f"{name}_features"))


@query
def als_factors(spark, d):
    """The final fit, at most 1000 staged rounds, stopped when the factors change by less than 5 % in a round;
    whether each id solves its own equations (users to what the last half round moved)."""
    reg = recommend.REG_PARAMS[0]
    data = t.ratings(spark, d)
    model = factorization.fit_rounds(
        data, recommend.RANKS[0], reg, recommend.FINAL_ITERATIONS, recommend.FINAL_SEED, tolerance=0.05
    )
    sides = []
    for side, most in (("user", 0.1), ("item", 1e-4)):
        found = factorization.normal_residual(data, model, reg, side)
        sides.append(
            found.select(F.lit(side).alias("kind"), "id", "n_ratings", (F.col("residual") < most).alias("is_solution"))
        )
    return sides[0].unionByName(sides[1])


@query
def als_predict(spark, d):
    """Whether each prediction is the product of its factors."""
    model = _model(spark, d)
    rows = recommend.predict(model, t.ratings(spark, d))
    rows = rows.join(_factors(model.userFactors, "user"), "user").join(_factors(model.itemFactors, "item"), "item")
    products = F.zip_with("user_features", "item_features", lambda x, y: x.cast("double") * y)
    product = F.aggregate(products, F.lit(0.0), lambda s, x: s + x)
    return rows.select("user", "item", "rating", (F.abs(product - F.col("prediction")) < 1e-4).alias("is_product"))


@query
def als_tuning(spark, d):
    """All 66 points of the grid with all iterations; whether each has an error that is a number."""
    trials = recommend.tune_als(t.ratings(spark, d), parallelism=4)
    error = F.col("rmse")
    return trials.select("trial", "rank", "reg", "iters", (error.between(0, 1e9) & ~F.isnan(error)).alias("is_finite"))


@query
def recommend_all(spark, d):
    """The pruned top items, and whether a search over all pairs finds the same ratings."""
    model = _model(spark, d)

    def ranked(recommendations, rating):
        return recommendations.select("user", F.posexplode("recommendations").alias("pos", "r")).select(
            "user", "pos", F.col("r.rating").alias(rating)
        )

    found = ranked(recommend.recommend_all(model), "rating")
    whole = ranked(recommend.recommend_all_pairs(model), "best")
    same = F.abs(F.col("rating") - F.col("best")) < 1e-4
    return found.join(whole, ["user", "pos"], "full").select("user", "pos", F.coalesce(same, F.lit(False)).alias("is_best"))


@query
def recommended_items(spark, d):
    items = recommend.recommended_items(t.recommendations(spark, d))
    return items.withColumn("recommended", T.array_to_text(F.col("recommended")))
