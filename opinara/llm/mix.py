"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue served in shuffled order, up to three times over. A copy of a document has a
virtual finish time: the words its source has been served by its end, divided by the source's target.
Copies are sorted by that time over all sources and the line is cut at the total budget; the copy in
service at the cut gives the words before it.

Defined results: null or empty text has size 0 and takes nothing; a null source is a source of its
own, last in order; rows that repeat a doc_id are documents of their own; an empty table gives no
rows; other columns are ignored by :func:`mix` and kept by :func:`mixed_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.shared import BUCKET_ROWS, plain_names, running_total, scratch, stage, uniform, word_count
from opinara.operators.keys import global_position

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
_DRAWS = float(1 << 52)


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS
) -> DataFrame:
    """``source, n_docs, source_size, weight, target`` from ``source, size``.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes. A
    target above ``repeats`` times its source is cut there and the rest is shared again; each round
    is one sum over the sources, so their number is not bounded by one task.
    """
    totals = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")
    )
    totals = totals.withColumn("no_source", F.col("source").isNull())
    placed = global_position(totals, "no_source", "source", name="place").drop("no_source")
    turn = F.array(*[F.lit(w) for w in weights])
    weighed = stage(
        placed.withColumn(
            "weight", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")).cast("bigint")
        ).drop("place")
    )
    most = F.col("source_size") * repeats
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, shared, over = (0, 1), F.lit(False), -1
    while True:
        capped = weighed.withColumn("capped", shared)
        left = F.sum(F.when(~F.col("capped"), F.col("weight")))
        spent = F.sum(F.when(F.col("capped"), most))
        n, weight, used = capped.agg(F.count_if("capped"), left, spent).first()
        if n == over or not weight:
            break
        over, level = n, (total - (used or 0), weight)
        shared = F.col("weight") * F.lit(level[0]) > most * F.lit(level[1])
    share = (F.col("weight") * F.lit(level[0])).cast("double") / F.lit(float(level[1]))
    return weighed.withColumn("target", F.when(shared, most.cast("double")).otherwise(share))


def schedule(docs: DataFrame, seed: int = 0, repeats: int = MAX_REPEATS) -> DataFrame:
    """The served copies: ``row, doc_id, source, size, source_size, target, pass, finish, offset, taken``.

    ``offset`` is the copy's place in words in the mixed stream. A document that is never served
    keeps one row with ``taken`` 0 (its place is behind the cut).
    """
    with scratch(docs.sparkSession) as result:
        return result(_schedule(docs, seed, repeats))


def _schedule(docs: DataFrame, seed: int, repeats: int) -> DataFrame:
    sizes = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            uniform(F.lit(seed), F.col("doc_id").cast("string")).alias("draw"),
        )
    )
    targets = stage(source_targets(sizes, repeats=repeats))
    budget = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    facts = targets.select(F.col("source").alias("_source"), "n_docs", "source_size", "target")
    stretch = F.ceil(F.col("n_docs") / BUCKET_ROWS)
    queued = (
        sizes.join(facts, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("bucket", F.floor(F.col("draw") / _DRAWS * stretch))
        .select("row", "doc_id", "source", "size", "draw", "bucket", "source_size", "target")
    )
    lined = running_total(queued, ["source"], "bucket", ["draw", "doc_id", "size", "row"], "size", "before")
    words = F.round("target").cast("bigint")
    passes = F.greatest(F.ceil(words / F.greatest("source_size", F.lit(1))), F.lit(1)).cast("int")
    start = F.col("pass") * F.col("source_size") + F.col("before")
    copies = (
        lined.withColumn("pass", F.explode(F.sequence(F.lit(0), passes - 1)))
        .withColumn("finish", (start + F.col("size")) / F.greatest(F.col("target"), F.lit(1.0)))
        .withColumn("due", F.greatest(F.least(F.col("size"), words - start), F.lit(0)))
    )
    served = stage(copies.select(
        "row", "doc_id", "source", "size", "source_size", "target", "pass", "finish", "due"
    ))
    n = served.count()
    slices = max(1, -(-n // BUCKET_ROWS))
    timed = served.withColumn("all", F.lit(0)).withColumn(
        "bucket", F.least(F.floor(F.col("finish") * slices), F.lit(slices)).cast("bigint")
    )
    line = running_total(timed, ["all"], "bucket", ["finish", "source", "row", "pass"], "due", "offset")
    taken = F.greatest(F.least(F.col("due"), F.lit(budget) - F.col("offset")), F.lit(0))
    return line.withColumn("taken", taken).drop("all", "bucket", "due")


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (words, repeats counted)."""
    facts = ["row", "doc_id", "size", "source_size", "target"]
    served = schedule(docs, seed).groupBy(*facts).agg(F.sum("taken").alias("taken"))
    return served.drop("row")


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    gap = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
    rest = F.element_at(F.split(text, gap, (n + 1).cast("int")), -1)
    return F.substring(text, F.lit(1), F.length(text) - F.length(rest))


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: one row per served copy.

    A document taken twice is there twice; the copy in service at the cut keeps its first words.
    Rows that share doc_id and size are taken alike.
    """
    text, names = F.col("text"), docs.columns
    docs = plain_names(docs, "doc_id", "text", "source")
    others = docs.columns
    taken = mix(docs, seed).where(F.col("taken") > 0).groupBy(
        F.col("doc_id").alias("_id"), F.col("size").alias("_size")
    ).agg(F.max("taken").alias("_taken"))
    kept = docs.withColumn("_words", word_count(text))
    rows = kept.join(
        taken, F.expr("doc_id <=> _id AND _words = _size")
    ).withColumn(
        "_copy", F.explode(F.expr("sequence(0L, CAST(ceil(_taken / _size) AS BIGINT) - 1L)"))
    )
    here_taken = F.least(F.col("_words"), F.col("_taken") - F.col("_copy") * F.col("_words"))
    cut = F.when(here_taken < F.col("_words"), _first_words(text, here_taken)).otherwise(text)
    return rows.withColumn("text", cut).select(*others).toDF(*names)

