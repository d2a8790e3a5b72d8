"""What several operators need: staged tables, text measures, running totals, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BUCKET_ROWS = 20_000


_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_OPEN: list[list[str]] = []  # tables staged by the scratch blocks that are open, innermost last


def fresh_path(spark: SparkSession) -> str:
    """An unused path in the shared folder, removed at the end of the :func:`scratch` block, if any."""
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def stage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts lineage: the rows are fixed, later steps survive lost executors, nothing is computed twice.
    Within a :func:`scratch` block the table goes when the block ends.
    """
    spark = df.sparkSession
    path = fresh_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(
    spark: SparkSession, arrow_rows: int | None = None
) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose staged tables are removed at its end; gives a function that stages a result
    beyond it (for the block around it, if there is one). ``arrow_rows`` sets how many rows travel to
    Python workers at a time within the block, for rows that are large."""
    tables: list[str] = []
    _OPEN.append(tables)
    before = spark.conf.get(_ARROW_ROWS)
    if arrow_rows:
        spark.conf.set(_ARROW_ROWS, str(arrow_rows))

    def result(df: DataFrame) -> DataFrame:
        _OPEN.pop()
        try:
            return stage(df)
        finally:
            _OPEN.append(tables)

    try:
        yield result
    finally:
        _OPEN.pop()
        spark.conf.set(_ARROW_ROWS, before)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for name in tables:
            path = hadoop.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def plain_names(docs: DataFrame, *own: str) -> DataFrame:
    """``docs`` with every column but ``own`` renamed by its place, so that no name can clash.

    ``toDF(*docs.columns)`` gives the names back.
    """
    return docs.toDF(*[c if c in own else f"column{i}" for i, c in enumerate(docs.columns)])


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, every other character as it is; null stays null."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def word_count(text: Column) -> Column:
    """Number of words, a word being a run of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(*parts: Column) -> Column:
    """A number in [0, 2^52) drawn from the MD5 of the parts: the same on every run and engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("bigint")


def compressed(docs: DataFrame) -> DataFrame:
    """``doc_id, packed``: the texts' bytes, compressed for the way to other machines; null is empty."""
    kind = dict(docs.dtypes)["doc_id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            packed = pa.array([squeeze(t or b"") for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), packed], names=["doc_id", "packed"])

    return docs.select("doc_id", "text").mapInArrow(pack, f"doc_id {kind}, packed binary")


def unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def running_total(
    df: DataFrame, groups: list[str], bucket: str, order: list[str], value: str, name: str
) -> DataFrame:
    """Adds the sum of ``value`` over the rows before this one in its group.

    ``bucket`` cuts a group into consecutive stretches of bounded length, so that no task holds a
    group: totals per bucket are summed before the shuffle, their running sum is a window over one
    row per bucket, and rows are summed within their bucket only. ``df`` must be a staged table.
    """
    keys = [*groups, bucket]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    past = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.coalesce(F.sum("_sum").over(past), F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return (
        local.join(before, same)
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_within", "_before", *[f"_{k}" for k in keys])
    )


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of the pairs ``a, b``.

    Alternating large and small stars: each round hangs a node's larger neighbours, then its smaller
    ones, on the least of them, until the pairs stand still; rounds grow with the logarithm of a
    component's size. Minima are combined before the shuffle and staged, so that the join on a hub
    has two plain shuffles, which adaptive execution splits. No pairs give no rows; a pair of a node
    with itself or with null is ignored, repeated pairs count once.
    """
    with scratch(edges.sparkSession) as result:
        current = stage(
            edges.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct()
        )
        seen = _fingerprint(current)
        while seen[0]:
            both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = stage(
                both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
            )
            large = stage(
                both.join(least, "a")
                .where(F.col("b") > F.col("a"))
                .select(F.col("b").alias("a"), F.col("low").alias("b"))
                .distinct()
            )
            lowest = stage(large.groupBy("a").agg(F.min("b").alias("low")))
            moved = large.join(lowest, "a").where(F.col("b") != F.col("low"))
            current = stage(
                moved.select(F.col("b").alias("a"), F.col("low").alias("b"))
                .unionByName(lowest.select("a", F.col("low").alias("b")))
                .distinct()
            )
            now = _fingerprint(current)
            if now == seen:
                break
            seen = now
        roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
        hung = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        return result(hung.unionByName(roots))
