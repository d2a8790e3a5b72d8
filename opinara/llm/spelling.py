"""Spelling variants by permuterm rotations of the vocabulary.

A word is marked with a terminator and rotated to every place. Of words ``x c y`` that differ in the
character ``c`` alone, the rotations ``y $ x c`` agree in all but their last character, and the word
``x y`` without that character has ``y $ x`` itself among its rotations. Rotations are therefore grouped by
what stands before the skipped character: a group holds at most one word per letter and the shorter
word, and one pass over the sorted rotations gives each of its words its number of neighbours and the
best of them (the group's first or second). No pairs are made. A character within a run of equal ones can be
left out in several places with the same result; only the first place counts.

Groups are no larger than the alphabet, so none is hot. Rotations of a word longer than ``LONG`` code
points are named by 128 bits of hash, computed for all places in one pass, so their size stays linear in
the word; shorter ones are compared as they are.

Defined results: null text has no words; a null doc_id counts as empty in the corruption's key; rows that
repeat count again; equal counts are decided by the smaller word in code-point order; a table without
words gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.shared import ascii_lower, scratch, stage
from opinara.llm.shingles import mixed

MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10  # how many times more frequent a form is
LONG = 64
MARK = "$"
ERASED = 31
STEPS = 6  # doublings that reach the end of a chain: counts grow tenfold a step and fit 63 bits

# Fixed value: what words are made of.
RUN = f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}+"


def damaged(doc_id: Column, word: Column) -> Column:
    """``word`` less one character where the CRC of ``doc_id:word`` is a multiple of 31."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word)
    drawn = F.struct(F.crc32(key).alias("h"), word.alias("word"))

    def cut(d: Column) -> Column:
        at = (d["h"] % F.length(d["word"])).cast("int")
        shorter = F.concat(F.substring(d["word"], F.lit(1), at), F.substring(d["word"], at + 2, F.length(d["word"])))
        return F.when(d["h"] % ERASED == 0, shorter).otherwise(d["word"])

    return F.transform(F.array(drawn), cut)[0]


def document_words(docs: DataFrame) -> DataFrame:
    """``word``, one row per run of at least ``MIN_LENGTH`` letters, after the damage."""
    runs = docs.select("doc_id", F.explode_outer(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(RUN), F.lit(0))).alias("run"))
    return runs.where("run IS NOT NULL").select(damaged(F.col("doc_id"), F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``id, word, n``: distinct words with their counts; ids grow in code-point order."""
    counted = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    kept = stage(counted.where(F.col("n") >= min_count))
    return stage(kept.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"))


# ---- rotations -------------------------------------------------------------------------------


def _rotations(vocab: DataFrame) -> DataFrame:
    """``key, id, n, whole, first``: what stands before a skipped character, or the whole rotation."""
    w, at = F.col("word"), F.col("at")
    places = vocab.select("id", "word", "n", F.explode(F.sequence(F.lit(0), F.length(w))).alias("at"))
    head = F.substring(w, F.lit(1), at)
    after = F.concat(F.substring(w, at + 1, F.length(w)), F.lit(MARK), head)
    skipped = F.concat(F.substring(w, at + 2, F.length(w)), F.lit(MARK), head)
    new = (at == 0) | (F.substring(w, at + 1, F.lit(1)) != F.substring(w, at, F.lit(1)))
    entry = F.inline(
        F.filter(
            F.array(
                F.struct(after.alias("key"), F.lit(True).alias("whole"), F.lit(False).alias("first")),
                F.struct(
                    F.when(at < F.length(w), skipped).alias("key"), F.lit(False).alias("whole"), new.alias("first")
                ),
            ),
            lambda e: e["key"].isNotNull(),
        )
    )
    return places.select(entry, "id", "n").select("key", "id", "n", "whole", "first")


def _power(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _long_rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same for long words, with keys of two polynomial hashes over ``y $ x`` and its length.

    Words of ``LONG`` code points come here for their whole rotations only, which longer words meet.
    """
    bases = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
    for batch in batches:
        for i, w, count in zip(*[batch.column(c).to_pylist() for c in ("id", "word", "n")], strict=True):
            code = np.frombuffer(w.encode("utf-32-le"), np.uint32).astype(np.uint64)
            size = len(code)
            lanes = []
            for salt, base in enumerate(bases):
                power = _power(base, size + 2)
                value = mixed(code + np.uint64(1 + (salt << 32)))
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[:size])])
                inverse = _power(pow(base, -1, 1 << 64), size + 2)
                mark = mixed(np.array([1 << 40], np.uint64))[0]
                at = np.arange(size + 1)
                for skip in (0, 1):
                    p = at[: size + 1 - skip]
                    tail = (sums[size] - sums[p + skip]) * inverse[p + skip]  # y, from place 0
                    length = size - p - skip
                    lanes.append(tail + mark * power[length] + sums[p] * power[length + 1])
            whole = _names(lanes[0], lanes[2], size)
            skipped = _names(lanes[1], lanes[3], size - 1)
            new = np.append(True, code[1:] != code[:-1])
            kinds = [(whole, True, np.zeros(size + 1, bool)), (skipped, False, new)]
            for keys, is_whole, first in kinds[: 1 if size == LONG else 2]:
                k = len(keys)
                columns = [pa.array(keys), pa.array([i] * k, pa.int64()), pa.array([count] * k, pa.int64()), pa.array([is_whole] * k), pa.array(first)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "id", "n", "whole", "first"])


def _names(a: np.ndarray, b: np.ndarray, size: int) -> list[str]:
    """Names that no plain rotation has: they begin with the mark twice."""
    return [f"{MARK}{MARK}{size}:{x:016x}{y:016x}" for x, y in zip(a.tolist(), b.tolist(), strict=True)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, near, best_n, best``: each word's neighbours within the groups of sorted rotations.

    Rows come by key, then by falling count, then by id, so a group's best are its first.
    """
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        table = table.combine_chunks()
        keys = table.column("key").chunk(0) if table.num_rows else None
        if keys is None:
            continue
        changed = np.append(True, pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False))
        starts = np.flatnonzero(changed)
        if len(starts) > 1:
            yield from _groups(table.slice(0, int(starts[-1])), starts[:-1])
        rest = table.slice(int(starts[-1]))
    if rest is not None:
        yield from _groups(rest, np.zeros(1, np.int64))


def _groups(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    total = table.num_rows
    sizes = np.diff(np.append(starts, total))
    group = np.repeat(np.arange(len(starts)), sizes)
    several = sizes[group] > 1
    ids, counts = (table.column(c).to_numpy()[several] for c in ("id", "n"))
    whole, first = (table.column(c).to_numpy(zero_copy_only=False).astype(bool)[several] for c in ("whole", "first"))
    _, group = np.unique(group[several], return_inverse=True)
    n = int(group[-1]) + 1 if len(group) else 0

    def best_two(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per group the first and second row of those, -1 for none, and their number."""
        rows = np.flatnonzero(which)
        g = group[rows]
        number = np.bincount(g, minlength=n)
        begin = np.cumsum(number) - number
        one, two = np.full(n, -1), np.full(n, -1)
        one[number > 0] = rows[begin[number > 0]]
        two[number > 1] = rows[begin[number > 1] + 1]
        return one, two, number

    def found(rows: np.ndarray, near: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
        columns = [ids[rows], near, counts[best], ids[best]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "near", "best_n", "best"])

    # Replaced: any two words that skip a character differ in it alone.
    one, two, number = best_two(~whole)
    rows = np.flatnonzero(~whole & (number[group] > 1))
    g = group[rows]
    yield found(rows, number[g] - 1, np.where(one[g] == rows, two[g], one[g]))
    # Left out: the whole rotation is the word without the character.
    short, _, _ = best_two(whole)
    one, _, number = best_two(first & ~whole)
    rows = np.flatnonzero(first & ~whole & (short[group] >= 0))
    yield found(rows, np.ones(len(rows), np.int64), short[group[rows]])
    rows = np.flatnonzero(whole & (number[group] > 0))
    yield found(rows, number[group[rows]], one[group[rows]])


def neighbours(vocab: DataFrame) -> DataFrame:
    """``id, n_near, best_n, best``: how many words are one edit away, and the most frequent of them."""
    entry = "key string, id bigint, n bigint, whole boolean, first boolean"
    plain = _rotations(vocab.where(F.length("word") <= LONG))
    long_words = vocab.where(F.length("word") >= LONG).mapInArrow(_long_rotations, entry)
    rows = plain.unionByName(long_words)
    ordered = rows.repartition("key").sortWithinPartitions("key", F.desc("n"), "id")
    seen = ordered.mapInArrow(_scan, "id bigint, near bigint, best_n bigint, best bigint")
    first = F.min(F.struct((-F.col("best_n")).alias("down"), "best")).alias("first")
    return seen.groupBy("id").agg(F.sum("near").alias("n_near"), first).select(
        "id", "n_near", (-F.col("first.down")).alias("best_n"), F.col("first.best").alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``id, root``: the end of each chain of ``id, form``, by doubling."""
    links = stage(forms.select("id", F.col("form").alias("root")))
    for _ in range(STEPS):
        ahead = links.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
        links = stage(
            links.join(ahead, F.col("root") == F.col("_id"), "left").select(
                "id", F.coalesce("_root", "root").alias("root"), F.col("_id").isNotNull().alias("moved")
            )
        )
        if not links.where("moved").limit(1).count():
            break
        links = links.select("id", "root")
    return links.select("id", "root")


def variants(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of ``word``.

    The form is the most frequent word one edit away, if it is ``TIMES`` times as frequent; the root is
    where following forms ends.
    """
    with scratch(words.sparkSession) as result:
        vocab = vocabulary(words, min_length, min_count)
        near = stage(neighbours(vocab))
        counted = vocab.join(near, "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "best", "best_n"
        )
        far = F.col("best_n") >= TIMES * F.col("n")
        counted = stage(
            counted.select("id", "word", "n", "n_near", F.when(far, F.col("best")).alias("form"), F.when(far, F.col("best_n")).alias("form_n"))
        )
        roots = _roots(counted.where("form IS NOT NULL"))
        # Only words that have a form look up others.
        named = counted.select(F.col("id").alias("_id"), F.col("word").alias("_word"))
        hung = (
            counted.where("form IS NOT NULL")
            .join(roots, "id")
            .join(named, F.col("form") == F.col("_id"))
            .withColumnRenamed("_word", "_form")
            .drop("_id")
            .join(named, F.col("root") == F.col("_id"))
            .select("word", "n", "n_near", F.col("_form").alias("form"), "form_n", F.col("_word").alias("root"))
        )
        alone = counted.where("form IS NULL").select(
            "word", "n", "n_near", F.lit(None).cast("string").alias("form"), "form_n", F.col("word").alias("root")
        )
        return result(hung.unionByName(alone))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """:func:`variants` of the words of ``text``, see :func:`document_words`."""
    return variants(document_words(docs))
