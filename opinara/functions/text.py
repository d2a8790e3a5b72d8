"""Text expressions: tokens, stop words, tags, and embedding-corpus preprocessing.

Everything here is a built-in expression, so a text pipeline stays one JVM stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions.words import (
    CLOSED_CLASS,
    MARKUP_TOKENS,
    NOUN_TAGS,
    PUNCTUATION,
    STOP_WORDS,
)

_W = r"[\p{L}\p{M}\p{N}_]"
_END = rf"(?!{_W})"

# One alternative per token kind, first match wins. Loops are possessive: a run of a million
# letters must neither backtrack nor exhaust the matcher's stack.
TOKEN_PATTERN = "|".join(
    [
        r"\.\.\.|``|''|--",
        rf"(?i:n't){_END}",
        rf"'(?i:s|m|d|ll|re|ve){_END}",
        # halves of fused words: cannot, gimme, gonna, gotta, lemme, wanna
        rf"(?i:can(?=not{_END})|gim(?=me{_END})|gon(?=na{_END})|got(?=ta{_END})"
        rf"|lem(?=me{_END})|wan(?=na{_END}))",
        # the stem before n't
        rf"(?:(?:{_W}|[-./](?={_W}))(?!'[tT]{_END}))++(?=[nN]'[tT]{_END})",
        # words and numbers with inner hyphens, dots, slashes, digit commas and apostrophes
        rf"{_W}++(?:[-./]{_W}++|[,:]\p{{N}}++|'(?!(?i:s|m|d|ll|re|ve){_END}){_W}++)*+",
        r"[^\s\p{Z}]",
    ]
)


def array_literal(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def tokenize(text: Column, lower: bool = False) -> Column:
    """Word tokens in the manner of the Penn Treebank; case is kept unless ``lower``.

    Double quotes become two backticks (opening) or two apostrophes (closing).
    """
    text = F.coalesce(text, F.lit(""))
    quoted = F.replace(
        F.regexp_replace(text, r'(^|[\s\p{Z}(\[{<])"', "$1 `` "), F.lit('"'), F.lit(" '' ")
    )
    text = F.when(F.contains(text, F.lit('"')), quoted).otherwise(text)
    if lower:
        text = F.lower(text)
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def remove_stopwords(
    tokens: Column, words: Sequence[str] = STOP_WORDS, case_sensitive: bool = True
) -> Column:
    """Drop tokens found in ``words``; by default ``The`` survives where ``the`` does not."""
    words = list(words)
    if case_sensitive:
        return F.filter(tokens, lambda w: ~w.isin(words))
    lowered = [w.lower() for w in words]
    return F.filter(tokens, lambda w: ~F.lower(w).isin(lowered))


def remove_punctuation(tokens: Column, extra: Sequence[str] = MARKUP_TOKENS) -> Column:
    """Drop tokens equal to one ASCII mark or an ``extra`` token; ``...`` and the like stay."""
    dropped = list(dict.fromkeys([*PUNCTUATION, *extra]))
    return F.filter(tokens, lambda w: ~w.isin(dropped))


def default_tag(word: Column, low: Column | None = None) -> Column:
    """Part-of-speech guess for a word that the tag lexicon lacks: closed class, shape, suffix.

    ``low`` is the lower-cased word, for callers that hold it already.
    """
    low = F.lower(word) if low is None else low
    closed = {m: name for name, members in CLOSED_CLASS.items() for m in members}
    closed_tags = F.create_map(*[F.lit(x) for pair in closed.items() for x in pair])

    def suffix(end: str) -> Column:
        # The plain test comes first: most words fail it without running the pattern.
        return F.endswith(low, F.lit(end)) & low.rlike(f"[a-z]{{2}}{end}$")

    plural = F.endswith(low, F.lit("s")) & low.rlike("[^su]s$")
    return (
        F.when(low.isin(list(closed)), F.try_element_at(closed_tags, low))
        .when(word.rlike(r"^[-+]?\p{N}+([.,:/]\p{N}+)*$"), F.lit("CD"))
        .when(~word.rlike(r"[\p{L}\p{N}]"), F.lit("SYM"))
        .when(
            word.rlike(r"^\p{Lu}"), F.when(plural, F.lit("NNPS")).otherwise(F.lit("NNP"))
        )
        .when(suffix("ing"), F.lit("VBG"))
        .when(suffix("ed"), F.lit("VBD"))
        .when(suffix("ly"), F.lit("RB"))
        .when(low.rlike("[a-z]{2}(ous|ful|ive|able|ible|ish|less)$"), F.lit("JJ"))
        .when(plural, F.lit("NNS"))
        .otherwise(F.lit("NN"))
    )


def is_noun(tag: Column) -> Column:
    return tag.isin(list(NOUN_TAGS))


def extract_nouns(tagged: Column) -> Column:
    """Words of the noun-tagged entries of an ``array<struct<word,tag>>``."""
    return F.filter(tagged, lambda t: is_noun(t["tag"]))["word"]


def flatten_lists(nested: Column) -> Column:
    return F.flatten(nested)


def first_k(values: Column, k: int) -> Column:
    return F.slice(values, 1, k)


def simple_preprocess(text: Column, min_len: int = 2, max_len: int = 15) -> Column:
    """Lower-case alphabetic tokens of ``min_len`` to ``max_len`` letters."""
    words = F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}_]+"), F.lit(0)
    )
    return F.filter(
        words,
        lambda w: F.length(w).between(min_len, max_len) & ~F.startswith(w, F.lit("_")),
    )


def array_to_text(values: Column) -> Column:
    """``[a, b, c]``, the form the delimited outputs use for a list."""
    return values.cast("string")


def text_to_ids(text: Column) -> Column:
    """Back from ``[1, 2]`` to ``array<int>``."""
    return F.from_json(text, "array<int>")


def strip_key(line: Column, key: str) -> Column:
    """Remove the key text wherever it occurs in the line."""
    return F.replace(line, F.lit(key), F.lit(""))
