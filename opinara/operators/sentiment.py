"""Lexicon-based sentiment (the rules of Hutto & Gilbert 2014) as joins and expressions.

The steps for one lexicon word, in order:

1. its valence, moved away from zero by 0.733 if it is in capitals in a text of mixed case;
2. for each of the three words before it, nearest first, unless that word is in the lexicon:
   a. a booster or dampener adds or takes 0.293 (with 0.733 more in capitals), times 1, 0.95, 0.9;
   b. a negation multiplies by -0.74; ``never so`` / ``never this`` raise it instead
      (times 1.5 at distance two; times 1.25 at distance three, or for a bare so/this);
   c. at distance three, idioms replace the valence and two-word dampeners lower it;
3. ``least`` before it, unless ``at least`` or ``very least``, multiplies by -0.74;
4. words before the first ``but`` count half, words after it one and a half times.

The text's sum is then moved away from zero by its exclamation and question marks and normalized
to x / sqrt(x*x + 15).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions import words as K


# A blank-delimited piece without lower-case letters that holds an upper-case one.
CAPITALS_PATTERN = (
    r"(?:^|(?<=[\s\p{Z}]))(?=[^\s\p{Z}]*[\p{Lu}\p{Nl}\p{So}])[^\s\p{Z}\p{Ll}]++(?=$|[\s\p{Z}])"
)


@dataclass(frozen=True)
class Rules:
    """Word lists and switches; each switch turns one group of rules on."""

    context: bool = True
    emphasis: bool = True
    special: bool = True
    negations: Sequence[str] = field(default_factory=lambda: K.NEGATIONS)
    negation_infix: str = "n't"
    boosters: Sequence[str] = field(default_factory=lambda: K.BOOSTERS)
    dampeners: Sequence[str] = field(default_factory=lambda: K.DAMPENERS)
    dampener_pairs: Sequence[str] = K.DAMPENER_PAIRS
    idioms: Mapping[str, float] = field(default_factory=lambda: K.IDIOMS)
    but: str = "but"
    never: str = "never"
    intensive: Sequence[str] = ("so", "this")
    least: str = "least"
    least_exempt: Sequence[str] = ("at", "very")
    min_length: int = 2


BASIC = Rules(context=False, emphasis=False, special=False)
CONTEXT = Rules(emphasis=False, special=False)
STANDARD = Rules(special=False)
FULL = Rules()


def sentiment_words(text: Column, min_length: int = 2) -> Column:
    """Whitespace tokens, trimmed of outer marks unless two or fewer characters would remain.

    Tokens shorter than ``min_length`` are left out, also as neighbours.
    """
    pieces = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\s\p{Z}]+"), lambda t: t != "")

    def trimmed(t: Column) -> Column:
        bare = F.btrim(t, F.lit(K.PUNCTUATION))
        return F.when(F.length(bare) <= 2, t).otherwise(bare)

    return F.filter(F.transform(pieces, trimmed), lambda t: F.length(t) >= min_length)


def normalize(total: Column) -> Column:
    return F.round(total / F.sqrt(total * total + F.lit(K.NORMALIZER)), 4)


def _in_capitals(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def punctuation_emphasis(text: Column) -> Column:
    """0.292 per ``!`` up to four; 0.18 per ``?`` for two or three, 0.96 for more."""
    text = F.coalesce(text, F.lit(""))
    questions = _count(text, "?")
    return F.least(_count(text, "!"), F.lit(4)) * F.lit(0.292) + (
        F.when(questions <= 1, F.lit(0.0))
        .when(questions <= 3, questions * F.lit(0.18))
        .otherwise(F.lit(0.96))
    )


def _text_shape(text: Column, rules: Rules) -> list[Column]:
    if not rules.emphasis:
        return [F.lit(0.0).alias("marks")]
    text = F.coalesce(text, F.lit(""))
    return [
        punctuation_emphasis(text).alias("marks"),
        F.contains(F.lower(text), F.lit(rules.but)).alias("has_but"),
        text.rlike(CAPITALS_PATTERN).alias("has_capitals"),
    ]


def attach_valence(tokens: DataFrame, lexicon: DataFrame, word: str = "w") -> DataFrame:
    """Left join of one row per token with the lexicon, case-folded on the token side.

    No hint: the lexicon is broadcast if Spark finds it small enough, else both sides shuffle.
    """
    known = lexicon.select(
        F.col("token").alias("_token"), F.col("valence").cast("double").alias("valence")
    )
    return tokens.join(known, F.lower(F.col(word)) == F.col("_token"), "left").drop("_token")


def _plain_rows(reviews: DataFrame, ids: Sequence[str], text: str, rules: Rules) -> DataFrame:
    """:func:`token_rows` for rules that look at no neighbour, place or capital.

    Pieces are exploded first and trimmed as rows, which is generated code; ``pos`` only tells the
    review's own row.
    """
    pieces = F.split(F.coalesce(F.col(text), F.lit("")), r"[\s\p{Z}]+")
    rows = reviews.select(*ids, F.explode_outer(F.concat(pieces, F.array(F.lit(None).cast("string")))).alias("piece"))
    bare = F.btrim("piece", F.lit(K.PUNCTUATION))
    rows = rows.select(*ids, "piece", F.when(F.length(bare) <= 2, F.col("piece")).otherwise(bare).alias("w"))
    kept = rows.where(F.col("piece").isNull() | ((F.col("piece") != "") & (F.length("w") >= rules.min_length)))
    return kept.select(
        *ids, F.lit(0.0).alias("marks"), F.when(F.col("piece").isNull(), -1).otherwise(0).alias("pos"), "w"
    )


def _shaped_texts(reviews: DataFrame, ids: Sequence[str], text: str, rules: Rules) -> DataFrame:
    """``*ids, marks, words, mixed_case, but_at`` per review."""
    words = F.col("words")
    texts = reviews.select(
        *ids,
        sentiment_words(F.col(text), rules.min_length).alias("words"),
        *_text_shape(F.col(text), rules),
    )
    if rules.emphasis:
        # Only texts that hold the word, or a run of capitals, are looked at word by word.
        lower_words = F.transform(words, lambda w: F.lower(w))
        but_at = F.when(F.col("has_but"), F.array_position(lower_words, rules.but) - 1)
        mixed = (
            F.col("has_capitals")
            & F.exists(words, _in_capitals)
            & F.exists(words, lambda w: ~_in_capitals(w))
        )
    else:
        but_at, mixed = F.lit(-1), F.lit(False)
    return texts.select(
        *ids,
        "marks",
        "words",
        mixed.alias("mixed_case"),
        F.coalesce(but_at.cast("int"), F.lit(-1)).alias("but_at"),
    )


def token_rows(reviews: DataFrame, ids: Sequence[str], text: str, rules: Rules) -> DataFrame:
    """One row per token with its neighbours, plus one row per review with a null word.

    The null-word row keeps reviews without any hit. Neighbours travel with the token, so no
    window and no shuffle of tokens is needed.
    """
    words = F.col("words")
    texts = _shaped_texts(reviews, ids, text, rules)
    none = F.lit(None).cast("string")

    def entry(w: Column, i: Column) -> Column:
        near = [F.get(words, i + d) for d in (-1, -2, -3, 1, 2)] if rules.context else [none] * 5
        names = ("p1", "p2", "p3", "n1", "n2")
        return F.struct(
            i.alias("pos"), w.alias("w"), *[c.alias(n) for c, n in zip(near, names)]
        )

    review_row = F.struct(
        F.lit(-1).alias("pos"),
        *[none.alias(n) for n in ("w", "p1", "p2", "p3", "n1", "n2")],
    )
    entries = F.concat(F.array(review_row), F.transform(words, entry))
    return texts.select(
        *ids, "marks", "mixed_case", "but_at", F.explode(entries).alias("t")
    ).select(*ids, "marks", "mixed_case", "but_at", "t.*")


# What a word means to its neighbours, as bits of one integer.
_BOOST, _DAMPEN, _NEGATE, _CAPS, _NEVER, _INTENSIVE, _LEAST, _EXEMPT = (1 << i for i in range(8))


def _looked_up(word: Column, bits: Mapping[str, int]) -> Column:
    # Few words are listed, so the set test decides before the map is searched.
    if not bits:
        return F.lit(0)
    entries = F.create_map(*[F.lit(x) for pair in bits.items() for x in pair])
    return F.when(word.isin(list(bits)), F.try_element_at(entries, word)).otherwise(F.lit(0))


def _kinds(word: Column, low: Column, rules: Rules) -> Column:
    folded: dict[str, int] = {}
    exact: dict[str, int] = {}
    listed = [(folded, _BOOST, rules.boosters), (folded, _DAMPEN, rules.dampeners)]
    listed += [(folded, _NEGATE, rules.negations)]
    if rules.special:
        listed += [(folded, _LEAST, [rules.least]), (folded, _EXEMPT, rules.least_exempt)]
        listed += [(exact, _NEVER, [rules.never]), (exact, _INTENSIVE, rules.intensive)]
    for bits, bit, members in listed:
        for m in members:
            bits[m] = bits.get(m, 0) | bit
    kinds = _looked_up(low, folded)
    infix = F.when(F.contains(low, F.lit(rules.negation_infix)), F.lit(_NEGATE))
    kinds = kinds.bitwiseOR(infix.otherwise(F.lit(0)))
    if rules.special:
        kinds = kinds.bitwiseOR(_looked_up(word, exact))
    if rules.emphasis:
        kinds = kinds.bitwiseOR(
            F.when((word != low) & (F.upper(word) == word), F.lit(_CAPS)).otherwise(F.lit(0))
        )
    return kinds


def _is(kinds: Column, bits: int) -> Column:
    return kinds.bitwiseAND(F.lit(bits)) != 0


def _away(value: Column) -> Column:
    return F.when(value > 0, F.lit(K.CAPS)).otherwise(F.lit(-K.CAPS))


def _booster_scalar(kinds: Column, valence: Column, rules: Rules) -> Column:
    sign = F.when(valence < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    size = F.when(_is(kinds, _BOOST), F.lit(K.BOOST)).otherwise(F.lit(-K.BOOST))
    scalar = sign * size
    if rules.emphasis:
        loud = F.col("mixed_case") & _is(kinds, _CAPS)
        scalar = scalar + F.when(loud, _away(valence)).otherwise(F.lit(0.0))
    return F.when(_is(kinds, _BOOST | _DAMPEN), scalar).otherwise(F.lit(0.0))


def _negation_factor(kinds: list[Column], distance: int, rules: Rules) -> Column:
    k1, k2, k3 = kinds
    factor = F.when(_is(kinds[distance - 1], _NEGATE), F.lit(K.NEGATION)).otherwise(F.lit(1.0))
    if not rules.special or distance == 1:
        return factor
    if distance == 2:
        raised = _is(k2, _NEVER) & _is(k1, _INTENSIVE)
        return F.when(raised, F.lit(1.5)).otherwise(factor)
    raised = (_is(k3, _NEVER) & _is(k2, _INTENSIVE)) | _is(k1, _INTENSIVE)
    return F.when(raised, F.lit(1.25)).otherwise(factor)


def _phrase(*parts: Column) -> Column:
    """Null if a part is missing."""
    return F.concat(*[p if i == 0 else F.concat(F.lit(" "), p) for i, p in enumerate(parts)])


def _around() -> list[Column]:
    return [F.col(c) for c in ("p3", "p2", "p1", "w", "n1", "n2")]


def _idiom(rules: Rules, around: Sequence[Column]) -> Column:
    """The value of an idiom around the word, or null; one after it wins over one before, the longer one first."""
    if not rules.idioms:
        return F.lit(None).cast("double")
    p3, p2, p1, w, n1, n2 = around
    phrases = [(w, n1, n2), (w, n1), (p1, w), (p2, p1, w), (p2, p1), (p3, p2, p1), (p3, p2)]
    known = F.filter(F.array(*[_phrase(*x) for x in phrases]), lambda x: x.isin(list(rules.idioms)))
    entries = [F.lit(x) for idiom, v in rules.idioms.items() for x in (idiom, float(v))]
    return F.try_element_at(F.create_map(*entries), F.get(known, F.lit(0)))


def _lowered(rules: Rules, around: Sequence[Column]) -> Column:
    """Whether a two-word dampener stands before the word."""
    if not rules.dampener_pairs:
        return F.lit(False)
    p3, p2, p1 = around[:3]
    found = F.exists(F.array(_phrase(p3, p2), _phrase(p2, p1)), lambda x: x.isin(list(rules.dampener_pairs)))
    return F.coalesce(found, F.lit(False))


def _open_by_lexicon(hits: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``_open1`` to ``_open3``: whether the words before are outside the lexicon, by looking them up."""
    tokens = lexicon.select("token")
    for d in (1, 2, 3):
        hits = (
            hits.withColumn(f"_low{d}", F.get(F.col("lows"), F.lit(d - 1)))
            .join(tokens.withColumnRenamed("token", f"_k{d}"), F.col(f"_low{d}") == F.col(f"_k{d}"), "left")
            .withColumn(f"_open{d}", F.col(f"_low{d}").isNotNull() & F.col(f"_k{d}").isNull())
            .drop(f"_low{d}", f"_k{d}")
        )
    return hits


def _open_by_place(hits: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The same from the hits of a review: a word before is in the lexicon if it is a hit itself.

    The three hits before one hold all within three words. Hits are dealt by review for it, which the sum
    per review needs anyway; the lexicon is not looked at again.
    """
    order = Window.partitionBy(*ids).orderBy("pos")
    before = [F.lag("pos", n).over(order).alias(f"_before{n}") for n in (1, 2, 3)]
    hits = hits.select("*", *before)
    for d in (1, 2, 3):
        at = [F.coalesce(F.col(f"_before{n}"), F.lit(-9)) == F.col("pos") - d for n in (1, 2, 3)]
        hits = hits.withColumn(f"_open{d}", F.col(f"_there{d}") & ~(at[0] | at[1] | at[2]))
    return hits.drop("_before1", "_before2", "_before3")


def _active(rules: Rules) -> Column:
    """Modifiers count nothing themselves, even if the lexicon lists them."""
    low = F.lower(F.col("w"))
    neutral = low.isin([*rules.boosters, *rules.dampeners]) | ((low == "kind") & (F.lower(F.col("n1")) == "of"))
    return ~F.coalesce(neutral, F.col("w").isNull())


def _raised(rules: Rules) -> Column:
    return F.col("mixed_case") & _in_capitals(F.col("w")) if rules.emphasis else F.lit(False)


def _weight(rules: Rules) -> Column:
    """1, 2 or 3 halves, by the side of ``but`` that the word is on."""
    if not rules.emphasis:
        return F.lit(2)
    halves = F.when((F.col("but_at") < 0) | (F.col("pos") == F.col("but_at")), F.lit(2))
    return halves.when(F.col("pos") < F.col("but_at"), F.lit(1)).otherwise(F.lit(3))


# Further bits of a token's kinds, and where a packed row keeps three kinds of 8 bits, single bits and halves.
_LISTED, _KIND, _OF = (1 << i for i in range(8, 11))
_THERE, _ACTIVE, _RAISED, _MIXED, _LOWERED, _HALVES = 24, 27, 28, 29, 30, 31


def _packed_rows(reviews: DataFrame, ids: Sequence[str], text: str, rules: Rules) -> DataFrame:
    """Token rows whose only text is the word to look up: what the rules need to know is one number.

    A large lexicon makes every token travel, to its word and to its review; such a row takes a fraction of
    the token with its neighbours. Each word's kinds are found once; idioms are looked for where two words in
    a row are in any.
    """
    listed = list(dict.fromkeys(w for phrase in (*rules.idioms, *rules.dampener_pairs) for w in phrase.split(" ")))
    words, lows, kinds = F.col("words"), F.col("lows"), F.col("kinds")

    def flag(test: Column, bit: int) -> Column:
        return F.when(test, F.lit(bit)).otherwise(F.lit(0))

    def of_word(w: Column, low: Column) -> Column:
        found = _kinds(w, low, rules).bitwiseOR(flag(low == "kind", _KIND)).bitwiseOR(flag(low == "of", _OF))
        return found.bitwiseOR(flag(w.isin(listed), _LISTED)) if rules.special and listed else found

    texts = _shaped_texts(reviews, ids, text, rules).withColumn("lows", F.transform(words, lambda w: F.lower(w)))
    texts = texts.withColumn("kinds", F.zip_with(words, lows, of_word))

    def entry(low: Column, i: Column) -> Column:
        near = [F.get(kinds, i + d) for d in (-3, -2, -1, 0, 1)]
        fields = [i.alias("pos"), low.alias("w"), *[k.alias(n) for n, k in zip(("k3", "k2", "k1", "k0", "kn"), near)]]
        if rules.special:
            around = [F.get(words, i + d) for d in (-3, -2, -1, 0, 1, 2)]
            pairs = [_is(x.bitwiseAND(y), _LISTED) for x, y in zip(near, near[1:])]
            some = F.coalesce(pairs[0], F.lit(False))
            for pair in pairs[1:]:
                some = some | F.coalesce(pair, F.lit(False))
            fields.append(F.when(some, _idiom(rules, around)).alias("_idiom"))
            fields.append(F.when(some, _lowered(rules, around)).otherwise(F.lit(False)).alias("_lowered"))
        return F.struct(*fields)

    own = [F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("w")]
    own += [F.lit(None).cast("int").alias(n) for n in ("k3", "k2", "k1", "k0", "kn")]
    if rules.special:
        own += [F.lit(None).cast("double").alias("_idiom"), F.lit(False).alias("_lowered")]
    entries = F.concat(F.array(F.struct(*own)), F.transform(lows, entry))
    rows = texts.select(*ids, "marks", "mixed_case", "but_at", F.explode(entries).alias("t"))
    rows = rows.select(*ids, "marks", "mixed_case", "but_at", "t.*")

    bits = F.lit(0).cast("bigint")

    def put(value: Column, place: int) -> None:
        nonlocal bits
        bits = bits.bitwiseOR(F.shiftleft(F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint")), place))

    for d in (1, 2, 3):
        put(F.col(f"k{d}").bitwiseAND(F.lit(255)), 8 * (d - 1))
        put(F.col(f"k{d}").isNotNull(), _THERE + d - 1)
    neutral = _is(F.col("k0"), _BOOST | _DAMPEN) | (_is(F.col("k0"), _KIND) & F.coalesce(_is(F.col("kn"), _OF), F.lit(False)))
    put(F.col("k0").isNotNull() & ~neutral, _ACTIVE)
    put(F.col("mixed_case") & _is(F.col("k0"), _CAPS), _RAISED)
    put(F.col("mixed_case"), _MIXED)
    put(_weight(rules), _HALVES)
    if rules.special:
        put(F.col("_lowered"), _LOWERED)
    return rows.select(
        *ids,
        "pos",
        "w",
        bits.alias("bits"),
        (F.col("_idiom") if rules.special else F.lit(None).cast("double")).alias("_idiom"),
        F.when(F.col("pos") == -1, F.col("marks")).alias("marks"),
    )


def _unpacked(hits: DataFrame, ids: Sequence[str]) -> DataFrame:
    def part(place: int, width: int) -> Column:
        return F.shiftright("bits", place).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")).cast("int")

    return hits.select(
        *ids, "pos", "v", "marks", "_idiom",
        *[part(8 * d, 8).alias(f"kinds{d + 1}") for d in range(3)],
        *[(part(_THERE + d, 1) == 1).alias(f"_there{d + 1}") for d in range(3)],
        (part(_ACTIVE, 1) == 1).alias("_active"),
        (part(_RAISED, 1) == 1).alias("_raised"),
        (part(_MIXED, 1) == 1).alias("mixed_case"),
        (part(_LOWERED, 1) == 1).alias("_lowered"),
        part(_HALVES, 2).alias("_halves"),
    )


def _apply_context(hits: DataFrame, rules: Rules) -> DataFrame:
    """The steps for the words before; a neighbour that is itself in the lexicon modifies nothing."""
    kinds = [F.col(f"kinds{d}") for d in (1, 2, 3)]
    # Each step is its own projection: the running value is used several times per step.
    for d in (1, 2, 3):
        open_ = F.col(f"_open{d}")
        scalar = _booster_scalar(kinds[d - 1], F.col("v"), rules)
        hits = hits.withColumn(
            "v", F.when(open_, F.col("v") + scalar * F.lit(K.DAMP[d - 1])).otherwise(F.col("v"))
        )
        factor = _negation_factor(kinds, d, rules)
        hits = hits.withColumn("v", F.when(open_, F.col("v") * factor).otherwise(F.col("v")))
    if rules.special:
        hits = hits.withColumn("v", F.coalesce(F.when(F.col("_open3"), F.col("_idiom")), F.col("v")))
        hits = hits.withColumn(
            "v", F.when(F.col("_open3") & F.col("_lowered"), F.col("v") - F.lit(K.BOOST)).otherwise(F.col("v"))
        )
        least = F.col("_open1") & _is(kinds[0], _LEAST) & ~_is(kinds[1], _EXEMPT)
        hits = hits.withColumn(
            "v", F.when(least, F.col("v") * F.lit(K.NEGATION)).otherwise(F.col("v"))
        )
    return hits


def _packed_valences(rows: DataFrame, lexicon: DataFrame, ids: Sequence[str], rules: Rules) -> DataFrame:
    """The hits by a large lexicon, ``*ids, pos, marks, v``, of :func:`_packed_rows`."""
    rows = attach_valence(rows, lexicon)
    hits = rows.where(F.col("valence").isNotNull() | (F.col("pos") == -1))
    hits = hits.select(*ids, "pos", "bits", "_idiom", "marks", F.coalesce("valence", F.lit(0.0)).alias("v"))
    hits = _unpacked(hits, ids)
    if rules.emphasis:
        hits = hits.withColumn("v", F.when(F.col("_raised"), F.col("v") + _away(F.col("v"))).otherwise(F.col("v")))
    hits = _apply_context(_open_by_place(hits, ids), rules)
    hits = hits.withColumn("v", F.when(F.col("_active"), F.col("v")).otherwise(F.lit(0.0)))
    return hits.select(*ids, "pos", "marks", (F.col("v") * (F.col("_halves") / F.lit(2.0))).alias("v"))


def word_valences(
    reviews: DataFrame, lexicon: DataFrame, ids: Sequence[str], text: str, rules: Rules, large: bool = False
) -> DataFrame:
    """One row per lexicon hit with its adjusted valence ``v``, plus the null-word rows.

    ``large`` is for a lexicon that is too large to send to every task: its tokens are joined once, as
    short rows, and the words before a hit are told by their places.
    """
    if not (rules.context or rules.emphasis):
        rows = attach_valence(_plain_rows(reviews, ids, text, rules), lexicon)
        hits = rows.where(F.col("valence").isNotNull() | (F.col("pos") == -1))
        return hits.withColumn("v", F.coalesce("valence", F.lit(0.0)))
    if large and rules.context:
        return _packed_valences(_packed_rows(reviews, ids, text, rules), lexicon, ids, rules)
    rows = attach_valence(token_rows(reviews, ids, text, rules), lexicon)
    # Tokens outside the lexicon end here, before any rule is evaluated.
    hits = rows.where(F.col("valence").isNotNull() | (F.col("pos") == -1))
    hits = hits.withColumn("v", F.coalesce("valence", F.lit(0.0)))
    if rules.context:
        hits = hits.withColumn("_active", _active(rules))
    if rules.emphasis:
        hits = hits.withColumn("v", F.when(_raised(rules), F.col("v") + _away(F.col("v"))).otherwise(F.col("v")))
    if rules.context:
        # Only lexicon hits reach this point. The words before one are looked at once, as lower-case text and kinds.
        near = F.array("p1", "p2", "p3")
        hits = hits.withColumn("lows", F.transform(near, lambda p: F.lower(p))).withColumn(
            "kinds", F.zip_with(near, "lows", lambda p, low: _kinds(p, low, rules))
        )
        hits = _open_by_lexicon(hits, lexicon)
        hits = hits.withColumns({f"kinds{d + 1}": F.get("kinds", F.lit(d)) for d in range(3)})
        if rules.special:
            hits = hits.withColumns({"_idiom": _idiom(rules, _around()), "_lowered": _lowered(rules, _around())})
        hits = _apply_context(hits, rules)
        hits = hits.withColumn("v", F.when(F.col("_active"), F.col("v")).otherwise(F.lit(0.0)))
    if rules.emphasis:
        hits = hits.withColumn("v", F.col("v") * (_weight(rules) / F.lit(2.0)))
    return hits


def review_totals(
    reviews: DataFrame,
    lexicon: DataFrame,
    rules: Rules = STANDARD,
    ids: Sequence[str] = ("review_id",),
    text: str = "review_text",
    large: bool = False,
) -> DataFrame:
    """``*ids, total``: the sum per review with its emphasis, exact to six decimals.

    All rows of a review leave one task, so partial aggregation turns them into one row before
    the shuffle. Sums are decimal and do not depend on row order.
    """
    exact = F.round("v", 6).cast("decimal(18,6)")
    sums = (
        word_valences(reviews, lexicon, ids, text, rules, large)
        .groupBy(*ids)
        .agg(F.sum(exact).alias("s"), F.max("marks").alias("marks"))
    )
    marks = F.round("marks", 6).cast("decimal(18,6)")
    total = F.col("s") + F.when(F.col("s") > 0, marks).when(F.col("s") < 0, -marks).otherwise(
        F.lit(0).cast("decimal(18,6)")
    )
    return sums.select(*ids, total.alias("total"))


def score_reviews(
    reviews: DataFrame,
    lexicon: DataFrame,
    rules: Rules = STANDARD,
    ids: Sequence[str] = ("review_id",),
    text: str = "review_text",
    large: bool = False,
) -> DataFrame:
    """``*ids, compound`` in [-1, 1]; 0.0 for a review without lexicon words."""
    totals = review_totals(reviews, lexicon, rules, ids, text, large)
    return totals.select(*ids, normalize(F.col("total").cast("double")).alias("compound"))


def score_products(
    reviews: DataFrame, lexicon: DataFrame, rules: Rules = STANDARD, large: bool = False
) -> DataFrame:
    """``product_id, compound``: the totals of all reviews of a product, normalized once.

    No text is concatenated; a hot product is summed before the shuffle.
    """
    totals = review_totals(
        reviews.where(F.col("product_id").isNotNull()),
        lexicon,
        rules,
        ids=("product_id", "review_id"),
        large=large,
    )
    sums = totals.groupBy("product_id").agg(F.sum("total").cast("double").alias("total"))
    return sums.select("product_id", normalize(F.col("total")).alias("compound"))
