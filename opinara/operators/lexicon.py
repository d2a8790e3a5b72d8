"""The sentiment lexicon: parsing, lookups and growth from word-vector neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.operators.vectors import similar_words

# The deviation a new word's model row should have, and the header lines skipped.
TARGET_SD = 0.44957
SKIPPED_LINES = 440
NEW_WORDS = 5


def parse_lexicon(lines: DataFrame, value: str = "value") -> DataFrame:
    """``line_no, token, valence, sd, raw`` from tab-separated lines; malformed lines are dropped."""
    parts = lines.select("line_no", F.split(value, "\t").alias("p")).where(F.size("p") == 4)
    return parts.select(
        "line_no",
        F.col("p")[0].alias("token"),
        F.col("p")[1].try_cast("decimal(28,14)").alias("valence"),
        F.col("p")[2].try_cast("double").alias("sd"),
        F.col("p")[3].alias("raw"),
    ).where(F.col("valence").isNotNull() & F.col("sd").isNotNull())


def render_lexicon(lexicon: DataFrame) -> DataFrame:
    """``line_no, value``: the tab-separated form, one decimal place at least."""
    valence = F.regexp_replace(F.col("valence").cast("string"), r"(\.\d+?)0+$", "$1")
    return lexicon.select(
        "line_no",
        F.concat_ws("\t", "token", valence, F.col("sd").cast("string"), "raw").alias("value"),
    )


def latest_entries(lexicon: DataFrame) -> DataFrame:
    """One row per token, the last line winning."""
    row = F.struct(*lexicon.columns)
    return lexicon.groupBy("token").agg(F.max_by(row, "line_no").alias("r")).select("r.*")


def nearest_row(
    lexicon: DataFrame, column: str = "sd", target: float = TARGET_SD, skip: int = SKIPPED_LINES
) -> DataFrame:
    """The row whose ``column`` is nearest to ``target`` after ``skip`` lines; first line on ties."""
    distance = F.abs(F.lit(target) - F.col(column))
    return lexicon.where(F.col("line_no") > skip).orderBy(distance, "line_no").limit(1)


GRAMS = (3, 6)  # lengths of the indexed pieces: words of 3 to 5 and of 6 and more characters


def _pieces(value: str, n: int) -> Column:
    """All substrings of ``n`` characters, in one pass over the text."""
    return F.regexp_extract_all(F.col(value), F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1))


def contained_words(words: DataFrame, text: DataFrame) -> DataFrame:
    """The distinct ones of ``word`` that occur anywhere in a line of ``value``.

    Lines are indexed by their pieces of a fixed length, so the index is linear in the text. A word is
    looked up by its rarest piece, of those the index counts; a word with a piece that is nowhere is in no
    line. The lines that have that piece are the word's candidates, and each is looked through. Words
    shorter than the shortest piece are compared with all pieces of their length. The empty word is in
    every line, if there is one.
    """
    lines = text.select("value").where("value IS NOT NULL").distinct()
    words = words.select("word").where("word IS NOT NULL").distinct()
    length = F.length("word")
    found = words.where(length == 0).join(lines.limit(1).select(F.lit("").alias("word")), "word")
    for n in range(1, GRAMS[0]):
        short = lines.select(F.explode(F.array_distinct(_pieces("value", n))).alias("word")).distinct()
        found = found.unionByName(words.where(length == n).join(short, "word"))
    for n, longer in zip(GRAMS, (*GRAMS[1:], None), strict=True):
        own = words.where((length >= n) & (length < longer) if longer else length >= n)
        index = lines.select("value", F.explode(F.array_distinct(_pieces("value", n))).alias("piece"))
        counts = index.groupBy("piece").agg(F.count(F.lit(1)).alias("_lines"))
        pieces = own.select("word", F.explode(F.array_distinct(_pieces("word", n))).alias("piece"))
        known = pieces.join(counts, "piece", "left").groupBy("word").agg(
            F.min(F.struct("_lines", "piece")).alias("_rare"), F.bool_and(F.col("_lines").isNotNull()).alias("_all")
        )
        rare = known.where("_all").select("word", F.col("_rare.piece").alias("piece"))
        met = rare.join(index, "piece").where(F.contains("value", "word"))
        found = found.unionByName(met.select("word").distinct())
    return found


def missing_words(
    words: DataFrame, lexicon: DataFrame, mode: str = "token", lines: DataFrame | None = None
) -> DataFrame:
    """Rows of ``words`` (column ``word``) that the lexicon lacks.

    ``token`` compares whole tokens. ``substring`` drops a word that occurs anywhere in the
    lexicon's lines (``lines`` as they stand in the file, else the parsed rows written again), see
    :func:`contained_words`.
    """
    if mode == "token":
        known = lexicon.select(F.col("token").alias("word"))
    elif mode == "substring":
        known = contained_words(words, render_lexicon(lexicon) if lines is None else lines)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return words.join(known, "word", "left_anti")


def propose_entries(words: DataFrame, model_row: DataFrame) -> DataFrame:
    """Lexicon rows for ``words``: everything but the token is copied from the one model row."""
    row = model_row.select(F.struct("valence", "sd", "raw")).scalar()
    others = [c for c in words.columns if c != "word"]
    return (
        words.select(F.col("word").alias("token"), *others, row.alias("_row"))
        .where(F.col("_row").isNotNull())
        .select("token", "_row.valence", "_row.sd", "_row.raw", *others)
    )


def append_lexicon(lexicon: DataFrame, new_rows: DataFrame) -> DataFrame:
    return lexicon.unionByName(new_rows.select(*lexicon.columns))


def new_entries(
    lexicon: DataFrame,
    vectors: DataFrame,
    seed_word: str,
    n: int = NEW_WORDS,
    target: float = TARGET_SD,
    skip: int = SKIPPED_LINES,
    mode: str = "substring",
    lines: DataFrame | None = None,
) -> DataFrame:
    """Rows for the absent ones among the n words nearest to ``seed_word``, numbered behind the last line."""
    fresh = missing_words(similar_words(vectors, seed_word, n), lexicon, mode, lines)
    # At most n words, so one small list. A word inside an earlier new word counts as present.
    listed = fresh.agg(F.array_sort(F.collect_list(F.struct("rank", "word")))["word"].alias("w"))
    if mode == "substring":
        listed = listed.select(
            F.filter(
                "w",
                lambda w, i: ~F.exists(
                    F.filter("w", lambda _, j: j < i), lambda earlier: F.contains(earlier, w)
                ),
            ).alias("w")
        )
    added = listed.select(F.posexplode("w").alias("pos", "word"))
    last = (lexicon if lines is None else lines).agg(F.max("line_no")).scalar()
    return (
        propose_entries(added, nearest_row(lexicon, "sd", target, skip))
        .withColumn("line_no", F.coalesce(last, F.lit(0)) + F.col("pos") + 1)
        .select(*lexicon.columns)
    )


def grow_lexicon(lexicon: DataFrame, vectors: DataFrame, seed_word: str, **options) -> DataFrame:
    """The lexicon with its :func:`new_entries` appended."""
    return append_lexicon(lexicon, new_entries(lexicon, vectors, seed_word, **options))
