import random

from pyspark.sql import functions as F

from opinara.operators import lexicon as X
from opinara.operators import lookup as L
from opinara.operators.joins import full_outer_join, known_rows, missing_rows
from opinara.operators.vectors import similar_words


def _serving(spark):
    recs = spark.createDataFrame(
        [(1, "[3, 1, 9, 3]"), (2, "[]"), (3, "[2]")], "user_id int, rec_prods string"
    )
    users = spark.createDataFrame([(1, "ann"), (2, "bob"), (4, "eve")], "user_id int, user string")
    products = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "pro_id int, product string")
    titles = spark.createDataFrame(
        [("A", "old", 1), ("A", "new", 2), ("Z", "z", 1)], "movie string, title string, n int"
    )
    return recs, users, products, L.title_dedup(titles, "n")


def test_report(spark):
    report = L.recommendation_report(*_serving(spark)).orderBy("user_id", "rank").collect()
    assert [tuple(r) for r in report] == [
        (1, "ann", 1, "C", "TITLE NOT AVAILABLE"),
        (1, "ann", 2, "A", "new"),
    ]


def test_report_for_wanted_users(spark):
    wanted = spark.createDataFrame([(2,), (99,)], "user_id int")
    assert L.recommendation_report(*_serving(spark), wanted=wanted).collect() == []


def test_unknown_user_gives_no_row(spark):
    recs, users, *_ = _serving(spark)
    assert L.recs_for_user(recs, users, 99).collect() == []
    assert L.recs_for_user(recs, users, 1).first()["user"] == "ann"


def test_joins_keep_both_sides(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string")
    b = spark.createDataFrame([(2, "p"), (3, "q")], "id int, b string")
    assert {tuple(r) for r in full_outer_join(a, b, "id").collect()} == {
        (1, "x", None), (2, "y", "p"), (3, None, "q"),
    }
    assert [r["id"] for r in known_rows(a, b, "id").collect()] == [2]
    assert [r["id"] for r in missing_rows(a, b, "id").collect()] == [1]


def _lexicon(spark):
    lines = [
        (1, "header\t1.0\t0.44957\t[0]"),
        (2, "wonderful\t2.7\t0.45\t[1]"),
        (3, "grand\t1.5\t0.4492\t[2]"),
        (4, "poor\t-1.5\t0.44914\t[3]"),
        (5, "poor\t-2.0\t0.45\t[4]"),
        (6, "bad line\t1"),
        (7, ""),
        (8, "word\tnan?\t0.1\t[5]"),
    ]
    return X.parse_lexicon(spark.createDataFrame(lines, "line_no long, value string"))


def test_parse_and_latest(spark):
    lex = _lexicon(spark)
    assert lex.count() == 5
    assert {r["token"]: r["line_no"] for r in X.latest_entries(lex).collect()}["poor"] == 5


def test_nearest_row_skips_header_and_first_line_wins(spark):
    lex = _lexicon(spark)
    assert X.nearest_row(lex, skip=0).first()["token"] == "header"
    assert X.nearest_row(lex, skip=1).first()["line_no"] == 3
    tied = lex.withColumn("sd", F.lit(0.5))
    assert X.nearest_row(tied, skip=1).first()["line_no"] == 2


def test_missing_words(spark):
    words = spark.createDataFrame([("grand",), ("onder",), ("0.4",), ("tasty",)], "word string")
    lex = _lexicon(spark)
    assert {r["word"] for r in X.missing_words(words, lex).collect()} == {"onder", "0.4", "tasty"}
    assert {r["word"] for r in X.missing_words(words, lex, "substring").collect()} == {"tasty"}
    none = words.where("word = ''")
    assert X.missing_words(none, lex, "substring").collect() == []


def test_grow(spark):
    vectors = spark.createDataFrame(
        [
            ("wide", [1.0, 0.0]), ("broadly", [0.99, 0.1]), ("broad", [0.98, 0.2]),
            ("grand", [0.97, 0.25]), ("huge", [0.9, 0.4]), ("far", [0.0, 1.0]), ("zero", [0.0, 0.0]),
        ],
        "word string, vector array<double>",
    )
    near = similar_words(vectors, "wide", 4).orderBy("rank").collect()
    assert [r["word"] for r in near] == ["broadly", "broad", "grand", "huge"]
    assert similar_words(vectors, "unknown", 4).collect() == []
    lex = _lexicon(spark)
    grown = X.grow_lexicon(lex, vectors, "wide", n=4, skip=1)
    new = grown.where("line_no > 5").orderBy("line_no").collect()
    # "broad" is part of the new word before it; "grand" is already there.
    assert [(r["line_no"], r["token"], float(r["valence"]), r["raw"]) for r in new] == [
        (6, "broadly", 1.5, "[2]"), (7, "huge", 1.5, "[2]"),
    ]
    by_token = X.grow_lexicon(lex, vectors, "wide", n=4, skip=1, mode="token")
    assert by_token.count() == lex.count() + 3


def test_contained_words_equal_a_search_of_every_line(spark):
    rng = random.Random(12)
    lines = ["".join(rng.choice("abé c\n") for _ in range(rng.randint(0, 60))) for _ in range(80)] + [None, "", "z" * 5000 + "needle"]
    words = {"".join(rng.choice("abé c") for _ in range(rng.randint(0, 9))) for _ in range(400)} | {"zzzzzzzzneed", "needle", "eedlez", ""}
    words |= {x[3:17] for x in lines if x}
    frame = spark.createDataFrame([(w,) for w in words] + [(None,), ("needle",)], "word string")
    text = spark.createDataFrame([(x,) for x in lines], "value string")
    found = [r["word"] for r in X.contained_words(frame, text).collect()]
    assert sorted(found) == sorted(w for w in words if any(x is not None and w in x for x in lines))
    none = text.where("false")
    assert X.contained_words(frame, none).count() == 0
