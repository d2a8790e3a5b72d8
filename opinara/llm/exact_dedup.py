"""Exact deduplication as a stateful stream.

Documents are read as a stream of files in bounded micro-batches. The state, kept on disk by the
RocksDB store and never expired, holds for each digest how many rows had it and the stable id and
content locator (file and row) of the row that stays. Rows are combined per task before they reach
the state, so a digest that a third of all rows share costs one state update per task. Hits are then
checked byte for byte: the text at the locator is compared with the text of each hit. Rows whose
digest is the same but whose text is not are grouped again by the text itself.

Defined results: null text counts as empty; of equal rows with equal ids the last by file and row
stays; an empty table gives no rows; columns beyond ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm.shared import ascii_lower, fresh_path, scratch, stage

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "400",
}
_STORES = "spark.sql.streaming.internal.stateStore.partitions"
BATCH_BYTES = 64 << 30
HITS_PER_COPY = 200


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _located(frame: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``doc_id, locator, digest, text`` with the normalised text."""
    text = normalised(F.col("text"))
    locator = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    return frame.select("doc_id", locator.alias("locator"), digest(text).alias("digest"), text.alias("text"))


def stream_groups(
    spark: SparkSession,
    path: str,
    digest: Callable[[Column], Column] = sha256,
    batch_bytes: int = BATCH_BYTES,
    stores: int | None = None,
) -> DataFrame:
    """Runs the stream over all files; ``digest, keep (doc_id, locator), n`` per distinct digest."""
    home = fresh_path(spark)
    path = path.rstrip("/")
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    # As a pattern, the path may also be a single file, which the stream source refuses by name.
    pattern = f"{path[:-1]}[{path[-1]}]"
    docs = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(pattern)
    state = (
        _located(docs, digest)
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("n"))
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{home}/out/{number}")

    # One store per core unless told otherwise: every store has a fixed cost of memory and disk.
    state_conf = _STATE | {_STORES: str(stores or spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k, None) for k in state_conf}
    for k, v in state_conf.items():
        spark.conf.set(k, v)
    try:
        run = (
            state.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", f"{home}/state")
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    row = "digest string, keep struct<doc_id: {0}, locator: struct<file: string, at: bigint>>, n bigint, batch int"
    schema = row.format(schema["doc_id"].dataType.simpleString())
    if run.lastProgress is None:
        return spark.createDataFrame([], schema).drop("batch")
    changes = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{home}/out")
    # A digest's last change holds its final state.
    return changes.groupBy("digest").agg(
        F.max_by("keep", "batch").alias("keep"), F.max_by("n", "batch").alias("n")
    )


def exact_dedup(
    spark: SparkSession,
    path: str,
    digest: Callable[[Column], Column] = sha256,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    with scratch(spark) as result:
        return result(_exact_dedup(spark, path, digest, batch_bytes))


def _exact_dedup(
    spark: SparkSession, path: str, digest: Callable[[Column], Column], batch_bytes: int
) -> DataFrame:
    groups = stage(stream_groups(spark, path, digest, batch_bytes))
    docs = _located(spark.read.parquet(path), digest)
    rows = docs.select("doc_id", "locator", "digest", sha256(F.col("text")).alias("text_sha256"))
    rows = stage(rows.join(groups, "digest"))

    # Full bytes on hits: the kept row's text is copied once per HITS_PER_COPY hits, so that a group
    # of any size is compared in many tasks.
    is_keep = (F.col("doc_id").eqNullSafe(F.col("keep.doc_id"))) & (F.col("locator") == F.col("keep.locator"))
    copies = F.ceil(F.col("n") / HITS_PER_COPY).cast("int")
    shared = rows.where(F.col("n") > 1).select(
        F.col("locator").alias("_locator"),
        F.col("digest").alias("_digest"),
        is_keep.alias("is_keep"),
        copies.alias("copies"),
        F.pmod(F.xxhash64("locator"), copies).cast("int").alias("slot"),
    )
    texts = docs.select("doc_id", "locator", "digest", "text")
    found = stage(
        texts.join(
            shared, (texts["digest"] == shared["_digest"]) & (texts["locator"] == shared["_locator"])
        ).drop("_digest", "_locator")
    )
    kept_text = found.where("is_keep").select(
        "digest",
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("slot"),
        F.col("text").alias("kept_text"),
    )
    hits = found.where(~F.col("is_keep")).join(kept_text, ["digest", "slot"])
    other = stage(
        hits.where(F.col("text") != F.col("kept_text")).select("doc_id", "locator", "digest", "text")
    )
    regrouped = other.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "locator")).alias("own_keep"), F.count(F.lit(1)).alias("own_n")
    )
    corrected = other.join(regrouped, ["digest", "text"]).select(
        F.col("locator").alias("_locator"), "own_keep", "own_n"
    )
    lost = other.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    keep = F.coalesce("own_keep", "keep")
    return (
        rows.join(corrected, rows["locator"] == F.col("_locator"), "left")
        .join(lost, "digest", "left")
        .select(
            "doc_id",
            keep["doc_id"].alias("keep_id"),
            F.coalesce("own_n", F.col("n") - F.coalesce("lost", F.lit(0))).alias("group_size"),
            (F.col("locator") == keep["locator"]).alias("kept"),
            "text_sha256",
        )
    )
