"""Product records as messages: encode, publish, decode, deduplicate, flatten.

All functions work alike on batch and streaming frames, apart from the two deduplications and the
two publications.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from opinara import schemas

# Fixed value: the topic of product records.
TOPIC = "Amazon_product_reviews."


def payload(records: DataFrame) -> DataFrame:
    """One JSON value per record; null fields are left out."""
    return records.select(F.to_json(F.struct("*")).alias("value"))


def array_payload(records: DataFrame) -> DataFrame:
    """One JSON array per record, the form :func:`decode_messages` reads."""
    return records.select(F.to_json(F.array(F.struct("*"))).alias("value"))


def publish(records: DataFrame, options: dict[str, str], fmt: str = "kafka") -> None:
    """Batch publication to a topic (or any sink that takes a ``value`` column)."""
    settings = {"topic": TOPIC, **options} if fmt == "kafka" else options
    array_payload(records).write.format(fmt).mode("append").options(**settings).save()


def publish_stream(
    records: DataFrame,
    checkpoint: str,
    options: dict[str, str],
    fmt: str = "kafka",
    available_now: bool = True,
    interval: str = "10 seconds",
    after_write: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Continuous publication: every record of the stream once, in the form of :func:`array_payload`.

    A batch that was written but not committed is written again after a restart, with the same number
    and the same rows. A file sink keeps each batch in a folder of its own, ``<path>/batch=<number>``,
    which the second attempt replaces. A topic can't replace messages, so each carries a ``key`` made of
    its batch and content, the same for both attempts: :func:`published_once` drops the second one.
    ``after_write`` is called with the number between the write and the commit.
    """

    def send(batch: DataFrame, number: int) -> None:
        values = array_payload(batch)
        if fmt == "kafka":
            keyed = values.select(message_key(number, F.col("value")).alias("key"), "value")
            keyed.write.format(fmt).mode("append").options(**{"topic": TOPIC, **options}).save()
        else:
            rest = {k: v for k, v in options.items() if k != "path"}
            values.write.format(fmt).mode("overwrite").options(**rest).save(f"{options['path']}/batch={number}")
        if after_write:
            after_write(number)

    writer = records.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def message_key(number: int, value: Column) -> Column:
    """``<batch>-<digest>``: the name of a message, the same whenever its batch is sent."""
    return F.concat(F.lit(f"{number}-"), F.md5(value))


def published_once(messages: DataFrame, key: str = "key", time: str = "timestamp", horizon: str = "1 day") -> DataFrame:
    """The messages of a topic without those that a restarted publication sent again, within ``horizon``."""
    return messages.withWatermark(time, horizon).dropDuplicatesWithinWatermark([key])


def read_review_stream(
    spark: SparkSession, options: dict[str, str], fmt: str = "kafka"
) -> DataFrame:
    """Raw message stream with a string ``value``; any file format can stand in for the topic."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        raw = reader.options(**{"subscribe": TOPIC, **options}).load()
        return raw.withColumn("value", F.col("value").cast("string"))
    if fmt != "text":
        reader = reader.schema("value string")
    return reader.options(**options).load()


def decode_messages(messages: DataFrame, schema=schemas.MESSAGE) -> DataFrame:
    """One row per record of each message's JSON array; malformed messages give none."""
    others = [c for c in messages.columns if c != "value"]
    return messages.select(
        *others, F.explode(F.from_json("value", schema)).alias("record")
    ).select(*others, "record.*")


def malformed_messages(messages: DataFrame, schema=schemas.MESSAGE) -> DataFrame:
    """The messages that :func:`decode_messages` can't read, unchanged."""
    return messages.where(F.col("value").isNotNull() & F.from_json("value", schema).isNull())


def latest_products(records: DataFrame, order: str, key: str = "url") -> DataFrame:
    """Batch: the last record per product. A resent product is combined before the shuffle."""
    row = F.struct(*records.columns)
    return records.groupBy(key).agg(F.max_by(row, order).alias("r")).select("r.*")


def first_products(
    records: DataFrame, key: str = "url", time: str | None = None, horizon: str | None = None
) -> DataFrame:
    """Stream: each product once. With ``time`` and ``horizon`` it is forgotten after that time.

    A product's state is the time until which it counts as known: its first record's time and the
    horizon. A record of before then is a repeat; a later one starts anew, whether or not the state has
    been cleared by then. Records of a batch are taken in order of time. State is cleared once the
    watermark, the latest time less the horizon, has passed it, and records from before the watermark
    are dropped as late; a record without time counts as one of 1970 that is never late.
    """
    if not (time and horizon):
        return records.dropDuplicates([key])
    zero = F.lit(0).cast("timestamp")
    at = F.coalesce(F.col(time), zero)
    until = F.unix_micros(at + F.expr(f"INTERVAL {horizon}"))
    columns = records.columns
    # Times travel as numbers: pandas would read them in the session's time zone.
    timed = records.withWatermark(time, horizon).withColumns(
        {"_key": F.col(key), "_at": F.unix_micros(at), "_until": until, "_null": F.col(time).isNull()}
    )
    schema = StructType(
        [f if f.name != time else StructField(time, LongType()) for f in records.schema.fields]
        + [StructField("_null", timed.schema["_null"].dataType)]
    )
    seen = timed.groupBy("_key").applyInPandasWithState(
        _first_of(time, schema.names), schema, "until bigint", "append", GroupStateTimeout.EventTimeTimeout
    )
    shown = F.when(~F.col("_null"), F.timestamp_micros(F.col(time))).alias(time)
    return seen.select(*[shown if c == time else F.col(c) for c in columns])


def _first_of(time: str, names: list[str]):
    def first(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        until = state.get[0] if state.exists else None
        for frame in frames:
            frame = frame.sort_values("_at", kind="stable")
            new = []
            for at, end in zip(frame["_at"].tolist(), frame["_until"].tolist(), strict=True):
                new.append(until is None or at >= until)
                if new[-1]:
                    until = end
            frame[time] = frame["_at"]
            yield frame.loc[new, names]
        state.update((until,))
        state.setTimeoutTimestamp(max(until // 1000, state.getCurrentWatermarkMs() + 1))

    return first


def stream_reviews(records: DataFrame) -> DataFrame:
    """One row per review; products without reviews keep one row with null review fields."""
    return records.select(
        "url", "name", F.posexplode_outer("reviews").alias("pos", "r")
    ).select("url", "name", "pos", "r.*")


def run_stream(
    df: DataFrame,
    checkpoint: str,
    sink: str = "parquet",
    path: str | None = None,
    available_now: bool = True,
    interval: str = "10 seconds",
    **options: str,
) -> StreamingQuery:
    """Start the continuous job; ``available_now`` stops when the present input is read."""
    writer = (
        df.writeStream.format(sink)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
    writer = (
        writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    )
    return writer.start(path) if path else writer.start()
