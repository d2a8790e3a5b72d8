"""Sentiment rules against a plain per-text loop over the same rules."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opinara.functions import words as K
from opinara.operators import sentiment as S

LEXICON = {
    "good": 1.9, "great": 3.1, "bad": -2.5, "terrible": -2.1, "love": 3.2, "hate": -2.7,
    "no": -1.2, "fun": 2.3, "kind": 2.4, "shit": -2.6, ":)": 2.0, "pretty": 2.2,
}


def brute(text, lex=LEXICON):
    """The full rule set, word by word."""
    ws = [w if len(w.strip(K.PUNCTUATION)) <= 2 else w.strip(K.PUNCTUATION) for w in text.split()]
    ws = [w for w in ws if len(w) > 1]
    caps = [w.isupper() for w in ws]
    mixed = 0 < sum(caps) < len(ws)
    low = [w.lower() for w in ws]
    out = []
    for i, w in enumerate(ws):
        if low[i] in K.BOOSTERS or low[i] in K.DAMPENERS or low[i] not in lex:
            out.append(0.0)
            continue
        if low[i] == "kind" and low[i + 1 : i + 2] == ["of"]:
            out.append(0.0)
            continue
        v = lex[low[i]]
        if caps[i] and mixed:
            v += 0.733 if v > 0 else -0.733
        for d in (1, 2, 3):
            if i < d or low[i - d] in lex:
                continue
            p = low[i - d]
            s = 0.293 if p in K.BOOSTERS else -0.293 if p in K.DAMPENERS else 0.0
            if s:
                s = -s if v < 0 else s
                if caps[i - d] and mixed:
                    s += 0.733 if v > 0 else -0.733
            v += s * (1.0, 0.95, 0.9)[d - 1]
            negated = p in K.NEGATIONS or "n't" in p
            so = ("so", "this")
            if d == 2 and ws[i - 2] == "never" and ws[i - 1] in so:
                v *= 1.5
            elif d == 3 and ((ws[i - 3] == "never" and ws[i - 2] in so) or ws[i - 1] in so):
                v *= 1.25
            elif negated:
                v *= -0.74
            if d == 3:
                def ph(a, b):
                    return " ".join(ws[a:b])

                for x in (ph(i - 1, i + 1), ph(i - 2, i + 1), ph(i - 2, i), ph(i - 3, i), ph(i - 3, i - 1)):
                    if x in K.IDIOMS:
                        v = K.IDIOMS[x]
                        break
                if i + 1 < len(ws) and ph(i, i + 2) in K.IDIOMS:
                    v = K.IDIOMS[ph(i, i + 2)]
                if i + 2 < len(ws) and ph(i, i + 3) in K.IDIOMS:
                    v = K.IDIOMS[ph(i, i + 3)]
                if ph(i - 3, i - 1) in K.DAMPENER_PAIRS or ph(i - 2, i) in K.DAMPENER_PAIRS:
                    v -= 0.293
        if i > 0 and low[i - 1] == "least" and "least" not in lex:
            if i < 2 or low[i - 2] not in ("at", "very"):
                v *= -0.74
        out.append(v)
    if "but" in low:
        b = low.index("but")
        out = [v * (0.5 if i < b else 1.5 if i > b else 1.0) for i, v in enumerate(out)]
    total = sum(out)
    q = text.count("?")
    marks = min(text.count("!"), 4) * 0.292 + (0 if q <= 1 else q * 0.18 if q <= 3 else 0.96)
    total += marks if total > 0 else -marks if total < 0 else 0
    return round(total / math.sqrt(total * total + 15), 4)


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(LEXICON.items()), "token string, valence double")


def scores(spark, lexicon, texts, rules=S.FULL, large=False):
    df = spark.createDataFrame(list(enumerate(texts)), "review_id long, review_text string")
    rows = S.score_reviews(df, lexicon, rules, large=large).collect()
    return [c for _, c in sorted((r["review_id"], r["compound"]) for r in rows)]


SENTENCES = [
    "The movie was good.",
    "The movie was VERY good!!!",
    "The movie was not good",
    "It isn't GREAT but I love it",
    "never so good as this",
    "They were never really so good",
    "the least good film",
    "at least good fun",
    "kind of good and kind people",
    "it is the shit today",
    "yeah right good",
    "sort of really bad????",
    "not very good, extremely bad?? ",
    "no good",
    "",
    "nothing here",
    ":) !",
    "ALL GOOD",
    None,
]


def test_hand_made_sentences(spark, lexicon):
    assert scores(spark, lexicon, SENTENCES) == pytest.approx([brute(t or "") for t in SENTENCES], abs=1e-4)


def test_known_values(spark, lexicon):
    got = scores(spark, lexicon, ["good", "not good", "very good"])
    assert got == pytest.approx([0.4404, -0.3412, 0.4927], abs=1e-4)


def test_random_texts(spark, lexicon):
    rng = random.Random(5)
    vocab = [*LEXICON, *"very not so this never least at but kind of sort GOOD VERY BAD the a film".split()]
    vocab += ["film!", "good?", "isn't", "(great)", "the", "shit", "bad", "ass", "just", "enough"]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 12))) for _ in range(600)]
    found = scores(spark, lexicon, texts)
    assert found == pytest.approx([brute(t) for t in texts], abs=1.01e-4)
    assert scores(spark, lexicon, texts, large=True) == found


def test_large_lexicon_is_joined_once(spark, lexicon):
    df = spark.createDataFrame(list(enumerate(SENTENCES)), "review_id long, review_text string")
    joins = [
        S.score_reviews(df, lexicon, S.FULL, large=large)._jdf.queryExecution().optimizedPlan().toString().count("Join ")
        for large in (True, False)
    ]
    assert joins == [1, 4]


def test_lexicon_too_large_to_broadcast_gives_the_same(spark, lexicon):
    broadcast = scores(spark, lexicon, SENTENCES)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert scores(spark, lexicon, SENTENCES) == broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_product_score_pools_reviews(spark, lexicon):
    df = spark.createDataFrame(
        [(1, "p", "good"), (2, "p", "bad"), (3, "q", "none"), (4, None, "good"), (5, "p", "not good")],
        "review_id long, product_id string, review_text string",
    )
    got = {r["product_id"]: r["compound"] for r in S.score_products(df, lexicon, S.FULL).collect()}
    total = 1.9 - 2.5 - 1.9 * 0.74
    assert got == {"p": round(total / math.sqrt(total**2 + 15), 4), "q": 0.0}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*LEXICON, "the", "x"]), max_size=30), min_size=1, max_size=20))
def test_basic_rule_is_bounded_and_odd(spark, lexicon, texts):
    joined = [" ".join(t) for t in texts]
    negated = lexicon.withColumn("valence", -F.col("valence"))
    up, down = (scores(spark, x, joined, S.BASIC) for x in (lexicon, negated))
    assert all(-1 <= u <= 1 and u == -d for u, d in zip(up, down))
