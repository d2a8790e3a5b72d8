"""Grouped counts, bounded collections, rankings and error measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators.keys import number_within

PART_SIZE = 1000


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def term_counts(df: DataFrame, key: str, array_col: str) -> DataFrame:
    """``key, term, n`` over all arrays of a key.

    A key whose arrays are all empty keeps one row with a null term. Counts are combined before
    the shuffle, and a hot key is spread over its terms.
    """
    return (
        df.select(key, F.explode_outer(array_col).alias("term"))
        .groupBy(key, "term")
        .agg(F.count("term").alias("n"))
    )


def top_terms(counts: DataFrame, key: str, k: int = 5) -> DataFrame:
    """``key, rank, term, n``: the k most frequent terms per key; ties in term order.

    The rank filter is applied inside each task before the shuffle (window group limit), so a key
    sends at most k rows per task. A null term ranks last.
    """
    order = [F.col("term").isNull(), F.desc("n"), F.col("term")]
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select(key, "rank", "term", "n")


def term_lists(top: DataFrame, key: str, name: str = "noun") -> DataFrame:
    """One row per key with its ranked terms as a list (empty if it has none)."""
    entry = F.when(F.col("term").isNotNull(), F.struct("rank", "term"))
    return top.groupBy(key).agg(F.array_sort(F.collect_list(entry))["term"].alias(name))


def group_collect(
    df: DataFrame, key: str, value: str, order: str, part_size: int = PART_SIZE
) -> DataFrame:
    """All values of a key as lists: ``key, part, values``, nulls skipped, in the given order.

    Part p holds rows p*part_size to (p+1)*part_size-1 of the key, so no list grows with the data
    and the parts read in order give the whole list. Null keys are a group of their own, null orders
    come first, and rows that share an order all stay, in an undefined order.
    """
    placed = number_within(df.select(*dict.fromkeys((key, order, value))), key, order)
    part = F.floor(F.col("position") / F.lit(part_size)).cast("bigint")
    entry = F.when(F.col(value).isNotNull(), F.struct(F.col("position"), F.col(value).alias("v")))
    return placed.groupBy(key, part.alias("part")).agg(
        F.array_sort(F.collect_list(entry))["v"].alias("values")
    )


def concat_reviews(
    df: DataFrame,
    key: str = "product_id",
    text: str = "review_text",
    order: str = "review_id",
    sep: str = ".",
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Texts of a key joined by ``sep``, as ``key, part, reviews``; see :func:`group_collect`."""
    parts = group_collect(df, key, text, order, part_size)
    return parts.select(key, "part", F.concat_ws(sep, "values").alias("reviews"))


def explode_rows(df: DataFrame, array_col: str, pos: str, value: str) -> DataFrame:
    """One row per array entry with its position from 0; empty and null arrays give none.

    An inner explode of a column makes Spark infer a filter on the array's size and push it below
    the projection that computes the array, so that costly arrays (tokens, cleaned reviews) are
    computed twice. The outer form with a null test on the position computes them once.
    """
    others = [c for c in df.columns if c != array_col]
    return df.select(*others, F.posexplode_outer(array_col).alias(pos, value)).where(
        F.col(pos).isNotNull()
    )


def vocabulary(df: DataFrame, array_col: str, min_count: int = 2) -> DataFrame:
    return (
        explode_rows(df.select(array_col), array_col, "_pos", "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_count)
    )


def mean_value(pairs: DataFrame, keys: list[str], value: str, scale: int = 2) -> DataFrame:
    """Average per key over exact decimals, so the result does not depend on row order."""
    exact = F.col(value).cast("decimal(18,6)")
    return pairs.groupBy(*keys).agg(
        F.round(F.sum(exact).cast("double") / F.count(exact), scale).alias(value)
    )


def rmse(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Root mean squared error, per group if asked; rows without a finite prediction are left out."""
    kept = df.where(F.col(prediction).isNotNull() & ~F.isnan(F.col(prediction).cast("double")))
    err = F.col(prediction) - F.col(label)
    return kept.groupBy(*(by or [])).agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def best_params(metrics: DataFrame, error: str = "rmse", order: str = "trial") -> DataFrame:
    """The row of least error; the first trial wins a tie and NaN never wins."""
    finite = metrics.where(F.col(error).isNotNull() & ~F.isnan(F.col(error).cast("double")))
    row = F.struct(*[F.col(c) for c in metrics.columns])
    best = finite.agg(F.min_by(row, F.struct(error, order)).alias("best"))
    return best.where(F.col("best").isNotNull()).select("best.*")


def first_row(df: DataFrame, *order: str | Column) -> DataFrame:
    return df.orderBy(*order).limit(1)


def filter_contains(df: DataFrame, column: str, needle: str) -> DataFrame:
    return df.where(F.contains(F.col(column), F.lit(needle)))
