from pyspark.sql import functions as F

from opinara.functions import text as T
from opinara.operators import aspects
from opinara.operators.aggregates import term_counts, term_lists, top_terms


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "x string").select(column.alias("y")).first()["y"]


def tokens(spark, text, **kw):
    return one(spark, T.tokenize(F.col("x"), **kw), text)


def test_contractions_and_quotes(spark):
    assert tokens(spark, "I don't think it's \"great\".") == [
        "I", "do", "n't", "think", "it", "'s", "``", "great", "''", ".",
    ]
    assert tokens(spark, "We can't, they'll; cannot gonna") == [
        "We", "ca", "n't", ",", "they", "'ll", ";", "can", "not", "gon", "na",
    ]


def test_inner_marks_stay(spark):
    assert tokens(spark, "well-known rock'n'roll 1,299.50 U.S.A and/or ...") == [
        "well-known", "rock'n'roll", "1,299.50", "U.S.A", "and/or", "...",
    ]
    assert tokens(spark, "good<br />bad (x)") == ["good", "<", "br", "/", ">", "bad", "(", "x", ")"]


def test_empty_and_null(spark):
    assert tokens(spark, "") == []
    assert tokens(spark, None) == []


def test_case_is_kept_unless_asked(spark):
    assert tokens(spark, "The Film") == ["The", "Film"]
    assert tokens(spark, "The Film", lower=True) == ["the", "film"]


def test_very_long_runs(spark):
    assert len(tokens(spark, "a" * 300_000)) == 1
    assert len(tokens(spark, "a." * 150_000)) == 2
    assert len(tokens(spark, "a'b" * 100_000)) == 1
    assert len(tokens(spark, "can't" * 50_000)) >= 1
    assert one(spark, F.size(T.simple_preprocess(F.col("x"))), "ab " * 100_000) == 100_000


def test_stop_words_are_case_sensitive(spark):
    kept = T.remove_stopwords(T.tokenize(F.col("x")))
    assert one(spark, kept, "The cat is on the mat") == ["The", "cat", "mat"]
    loose = T.remove_stopwords(T.tokenize(F.col("x")), case_sensitive=False)
    assert one(spark, loose, "The cat is on the mat") == ["cat", "mat"]


def test_punctuation_keeps_longer_marks(spark):
    kept = T.remove_punctuation(T.tokenize(F.col("x")))
    assert one(spark, kept, 'a , b ... "c" <br>') == ["a", "b", "...", "``", "c", "''"]


def test_simple_preprocess(spark):
    words = one(spark, T.simple_preprocess(F.col("x")), "A Été x1y wonderful! abcdefghijklmnop _no")
    assert words == ["été", "wonderful"]


def test_array_text_round_trip(spark):
    row = spark.range(1).select(T.array_to_text(F.array(F.lit(1), F.lit(2))).alias("t"))
    assert row.first()["t"] == "[1, 2]"
    assert row.select(T.text_to_ids(F.col("t")).alias("a")).first()["a"] == [1, 2]


def test_tag_backoff(spark):
    words = ["the", "London", "Alps", "running", "walked", "slowly", "wonderful", "cats", "cat", "12.5", "..."]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["word"]: r["tag"] for r in aspects.attach_tags(df, None).collect()}
    assert list(got[w] for w in words) == [
        "DT", "NNP", "NNPS", "VBG", "VBD", "RB", "JJ", "NNS", "NN", "CD", "SYM",
    ]


def test_tag_lexicon_wins_and_ties_go_by_name(spark):
    tagged = spark.createDataFrame(
        [("cat", "VB"), ("cat", "VB"), ("cat", "NN"), ("dog", "VB"), ("dog", "NN")],
        "word string, tag string",
    )
    lexicon = aspects.build_tag_lexicon(tagged)
    assert {tuple(r) for r in lexicon.collect()} == {("cat", "VB"), ("dog", "NN")}
    df = spark.createDataFrame([(1, ["cat", "dog", "bird"])], "id int, tokens array<string>")
    rows = aspects.tag_tokens(df, "tokens", lexicon).orderBy("pos").collect()
    assert [(r["word"], r["tag"]) for r in rows] == [("cat", "VB"), ("dog", "NN"), ("bird", "NN")]


REVIEWS = [
    (1, "p1", "the plot and the cast , plot plot music"),
    (2, "p1", "cast music sound light camera"),
    (3, "p2", "is the and"),
    (4, "p3", None),
    (5, None, "orphan plot"),
]


def test_aspects_ties_empty_products_and_orphans(spark):
    df = spark.createDataFrame(REVIEWS, "review_id long, product_id string, review_text string")
    lists = {r["product_id"]: r["noun"] for r in aspects.aspect_lists(df).collect()}
    assert lists == {"p1": ["plot", "cast", "music", "camera", "light"], "p2": [], "p3": []}
    top = aspects.top_aspects(df).where("product_id = 'p1'").orderBy("rank").collect()
    assert [(r["term"], r["n"]) for r in top][:2] == [("plot", 3), ("cast", 2)]


def test_hot_product_top_terms_match_brute_force(spark):
    """One product holds most rows; the ranking must still be whole."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("k"),
        F.array(F.concat(F.lit("w"), (F.col("id") * F.col("id")) % 997)).alias("a"),
    )
    top = term_lists(top_terms(term_counts(rows, "k", "a"), "k", 5), "k", "t")
    got = {r["k"]: r["t"] for r in top.collect()}
    counts = {}
    for i in range(60_000):
        key = "hot" if i % 3 else f"p{i % 50}"
        counts.setdefault(key, {}).setdefault(f"w{i * i % 997}", 0)
        counts[key][f"w{i * i % 997}"] += 1
    for key, c in counts.items():
        assert got[key] == [w for w, _ in sorted(c.items(), key=lambda e: (-e[1], e[0]))[:5]]
