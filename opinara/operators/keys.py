"""Dense identifiers and exact positions without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import written

BUCKET_ROWS = 100_000
MAX_BUCKETS = 1024
GROUP_BUCKETS = 1024
_SAMPLES = 8  # drawn rows per bucket border


def _bucket(key: Column, borders: Column) -> Column:
    """How many of the sorted borders are at most ``key``, by halving."""
    start = F.struct(F.lit(0).alias("lo"), F.size(borders).alias("hi"))

    def half(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        inside, reached = s["lo"] < s["hi"], F.get(borders, middle) <= key
        return F.struct(
            F.when(inside & reached, middle + 1).otherwise(s["lo"]).alias("lo"),
            F.when(inside & ~reached, middle).otherwise(s["hi"]).alias("hi"),
        )

    steps = (_SAMPLES * MAX_BUCKETS).bit_length()
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, half)["lo"]


def _numbered(placed: DataFrame, name: str) -> DataFrame:
    """Positions from ``_bucket`` and ``_order``: rows before the bucket's group, before the bucket, within it."""
    past = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        placed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_group", F.floor(F.col("_bucket") / GROUP_BUCKETS))
    )
    groups = counts.groupBy("_group").agg(F.sum("_n").alias("_sum"))
    groups = groups.select("_group", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inner = counts.select("_bucket", "_group", F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_past"))
    offsets = inner.join(groups, "_group").select("_bucket", (F.col("_base") + F.col("_past")).alias("_offset"))
    within = Window.partitionBy("_bucket").orderBy("_order")
    return (
        placed.withColumn("_at", F.row_number().over(within) - 1)
        .join(offsets, "_bucket")
        .withColumn(name, F.col("_offset") + F.col("_at"))
        .drop("_bucket", "_order", "_at", "_offset")
    )


def global_position(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Add the 0-based position of every row in the given ascending order, nulls first.

    Rows are dealt into buckets of about ``BUCKET_ROWS``, counted per bucket and numbered within theirs.
    Up to ``MAX_BUCKETS`` buckets, borders come from a bounded sample that a hash of the order draws, so
    the same rows give the same borders and nothing is written. Beyond, Spark's range partitioning
    deals them, and the buckets are written down with their rows, so that they hold when a task runs
    again. Offsets are prefix sums within groups of ``GROUP_BUCKETS`` buckets and over the groups, so no task
    reads more than the square root of the number of buckets, or that many, rows. Equal rows of the order are
    spread by a hash of the whole row; which of them comes first is undefined.
    """
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    keyed = df.withColumn(
        "_order", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(columns)], tie.alias("tie"))
    )
    buckets = -(-df.count() // BUCKET_ROWS)
    if buckets > MAX_BUCKETS:
        dealt = keyed.repartitionByRange(buckets, "_order").withColumn("_bucket", F.spark_partition_id())
        return _numbered(written(dealt), name)
    if buckets <= 1:
        placed = keyed.withColumn("_bucket", F.lit(0))
    else:
        drawn = (
            keyed.select("_order", F.xxhash64("_order", F.lit(42)).alias("_draw"))
            .orderBy("_draw", "_order")
            .limit(_SAMPLES * buckets)
        )
        borders = drawn.agg(F.array_sort(F.collect_set("_order")))
        placed = (
            keyed.withColumn("_borders", borders.scalar())
            .withColumn("_bucket", _bucket(F.col("_order"), F.col("_borders")))
            .drop("_borders")
        )
    return _numbered(placed, name)


def key_mapping(df: DataFrame, column: str, id_name: str = "id") -> DataFrame:
    """Distinct keys of ``column`` with dense ids 0..n-1 in key order, as ``int``.

    More keys than an int can hold raise an overflow error, because the factorization needs ints.
    """
    keys = df.select(column).where(F.col(column).isNotNull()).distinct()
    return global_position(keys, column, name=id_name).withColumn(
        id_name, F.col(id_name).cast("int")
    )


def map_ids(df: DataFrame, column: str, id_name: str = "id") -> tuple[DataFrame, DataFrame]:
    """Replace string keys by dense ints; returns the mapped rows and the mapping."""
    mapping = key_mapping(df, column, id_name)
    return df.join(mapping, column).drop(column), mapping


def number_within(df: DataFrame, key: str, order: str, name: str = "position") -> DataFrame:
    """Add the 0-based position of each row within its key, nulls of ``order`` first.

    Exact also for a key that holds a third of all rows, for the null key and for repeated rows:
    positions come from the global order, less the first position of the key. That first position is
    taken out of a struct, so Spark shuffles it for the join as a plain side and can split a hot key.
    """
    placed = global_position(df, key, order, name="_place")
    first = placed.groupBy(key).agg(F.min(F.struct(F.col("_place"), F.col(key).alias("_key"))).alias("_f"))
    first = first.select(F.col("_f._key").alias("_key"), F.col("_f._place").alias("_first"))
    return (
        placed.join(first, F.col(key).eqNullSafe(F.col("_key")))
        .withColumn(name, F.col("_place") - F.col("_first"))
        .drop("_key", "_place", "_first")
    )
