"""Readers; every schema is declared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinara import schemas
from opinara.operators.keys import global_position
from opinara.operators.lexicon import parse_lexicon

PRODUCT_KEY = "product/productId: "
TEXT_KEY = "review/text: "
_WHOLE = 2**31 - 1


def _value_of(block: Column, key: str) -> Column:
    pattern = rf"(?m)^{key}(.*)$"
    return F.when(block.rlike(pattern), F.regexp_extract(block, pattern, 1))


def parse_review_blocks(blocks: DataFrame, value: str = "value") -> DataFrame:
    """``product_id, review_text`` per record block; blocks with neither key are dropped."""
    others = [c for c in blocks.columns if c != value]
    block = F.replace(F.col(value), F.lit("\r"), F.lit(""))
    return blocks.select(
        *others,
        _value_of(block, PRODUCT_KEY).alias("product_id"),
        _value_of(block, TEXT_KEY).alias("review_text"),
    ).where(F.col("product_id").isNotNull() | F.col("review_text").isNotNull())


def _file_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, row, value``: lines in any line-end style, with their place in the input."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review records from block-structured text, blocks separated by blank lines.

    Works on lines, so line ends may be LF, CRLF or mixed and blank lines may hold blanks. A block's
    number is how many blank lines of its file come before it: counted within each split of the file
    and summed over the splits, so records that cross a border stay whole. Only the lines that matter
    are moved. ``review_id`` numbers the blocks of a file; with several files it is spread by file.
    """
    lines = _file_lines(spark, path)
    blank = F.trim(F.col("value")) == ""
    kept = lines.where(blank | F.col("value").startswith(PRODUCT_KEY) | F.col("value").startswith(TEXT_KEY))
    here = Window.partitionBy("file", "split").orderBy("row")
    numbered = kept.withColumn("blank", blank).withColumn("nth", F.sum(F.col("blank").cast("bigint")).over(here))
    # One row per split of a file.
    past = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        lines.where(blank)
        .groupBy("file", "split")
        .agg(F.count(F.lit(1)).alias("n"))
        .unionByName(lines.select("file", "split").distinct().withColumn("n", F.lit(0).cast("bigint")))
        .groupBy("file", "split")
        .agg(F.sum("n").alias("n"))
        .select("file", "split", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("before"))
    )
    placed = numbered.where(~F.col("blank")).join(before, ["file", "split"])
    block = (F.col("before") + F.col("nth")).alias("block")

    def first(key: str) -> Column:
        own = F.when(F.col("value").startswith(key), F.substring("value", len(key) + 1, _WHOLE))
        return F.min_by(own, F.when(own.isNotNull(), F.struct("split", "row")))

    records = placed.groupBy("file", block).agg(
        first(PRODUCT_KEY).alias("product_id"), first(TEXT_KEY).alias("review_text")
    )
    number = F.xxhash64("file").bitwiseAND(F.lit(0x7FFFFF << 40)).bitwiseOR(F.col("block"))
    return records.select(number.alias("review_id"), "product_id", "review_text")


def _whole_number(raw: Column) -> Column:
    """The int in a text; null for null or empty, an error for anything else."""
    text = F.nullif(F.trim(raw), F.lit(""))
    bad = F.concat(F.lit("not an id of the int type: "), text)
    return F.when(text.isNotNull(), F.coalesce(text.try_cast("int"), F.raise_error(bad).cast("int")))


def read_ratings(spark: SparkSession, path: str, keyed: bool = False) -> DataFrame:
    """``user, item, rating`` by the names in the header, whatever their order.

    Ids that are no ints and ratings that are no numbers raise an error, nothing is dropped. With
    ``keyed`` ids stay text, to be mapped by :func:`opinara.operators.keys.map_ids`.
    """
    raw = spark.read.csv(path, header=True)
    text = F.nullif(F.trim("rating"), F.lit(""))
    bad = F.concat(F.lit("not a rating: "), text)
    rating = F.when(text.isNotNull(), F.coalesce(text.try_cast("double"), F.raise_error(bad).cast("double")))
    ids = [F.col(c) if keyed else _whole_number(F.col(c)).alias(c) for c in ("user", "item")]
    return raw.select(*ids, rating.alias("rating"))


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows dealt over ``partitions`` tasks (all cores by default).

    For inputs of a few unsplittable files (gzip, one row group), whose scan has too few tasks.
    """
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """One document per line; ``partitions`` deals them out, as a gzip file is read by one task."""
    lines = spark.read.text(path)
    return lines if partitions is None else spread(lines, partitions)


def read_product_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=False).select("productId")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Lexicon rows with their line number (from 1) across all splits of the file."""
    return parse_lexicon(read_lexicon_lines(spark, path))


def read_lexicon_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, value``: every line of the file as it is, comments and malformed ones too."""
    numbered = global_position(_file_lines(spark, path), "file", "split", "row", name="line_no")
    return numbered.select((F.col("line_no") + 1).alias("line_no"), "value")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


def range_predicates(column: str, low: int | None, high: int | None, parts: int) -> list[str]:
    """Conditions that cut a numeric column into ``parts`` ranges of equal width: every row, also one without a
    value or outside of the bounds, meets exactly one."""
    if low is None or high is None or parts <= 1 or low >= high:
        return ["1 = 1"]
    parts = min(parts, high - low + 1)
    cuts = [low + (high - low + 1) * i // parts for i in range(1, parts)]
    first, last = f"{column} < {cuts[0]} OR {column} IS NULL", f"{column} >= {cuts[-1]}"
    return [first, *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)], last]


def hash_predicates(expression: str, parts: int) -> list[str]:
    """Conditions that deal rows by a non-negative whole number that the database computes; no number counts as 0."""
    if parts <= 1:
        return ["1 = 1"]
    return [f"COALESCE(MOD({expression}, {parts}), 0) = {i}" for i in range(parts)]


# How each serving table is cut: by ranges of an id, or by a hash of a text key.
_SERVING_KEYS = {"recommendations": "user_id", "users": "user_id", "products": "pro_id", "titles": None}


def _read_jdbc(spark: SparkSession, table: str, jdbc: dict[str, str], parts: int, text_hash: str) -> DataFrame:
    reader = spark.read.format("jdbc").options(**jdbc)
    key = _SERVING_KEYS[table]
    if parts <= 1:
        return reader.option("dbtable", table).load()
    if key is None:
        predicates = hash_predicates(text_hash, parts)
    else:
        bounds = f"(SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}) b"
        low, high = reader.option("dbtable", bounds).load().first()
        predicates = range_predicates(key, None if low is None else int(low), None if high is None else int(high), parts)
    rest = {k: v for k, v in jdbc.items() if k != "url"}
    return spark.read.jdbc(jdbc["url"], table, predicates=predicates, properties=rest)


def read_serving(
    spark: SparkSession,
    base: str | None = None,
    jdbc: dict[str, str] | None = None,
    parts: int = 1,
    text_hash: str = "CRC32(movie)",
) -> dict[str, DataFrame]:
    """The four serving tables, from Parquet below ``base`` or over JDBC.

    Over JDBC ``parts`` tasks read each table: by ranges of its id between the bounds that the database
    gives, titles by ``text_hash``, a hash in the database's own SQL.
    """
    tables = ("recommendations", "users", "products", "titles")
    if jdbc:
        return {t: _read_jdbc(spark, t, jdbc, parts, text_hash) for t in tables}
    return {t: spark.read.parquet(f"{base}/{t}") for t in tables}
