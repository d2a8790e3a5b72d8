"""A file stream stands in for the topic: same functions, same results as batch."""

import json

from pyspark.sql import functions as F

from opinara import schemas
from opinara.streaming import messages as M


def record(i, n_reviews=2):
    return {
        "url": f"u{i}", "name": f"n{i}", "price": "$1", "ratings": {"5 star": "60%"},
        "reviews": [{"review_text": f"t{i}-{k}", "review_rating": "4.0 "} for k in range(n_reviews)],
    }


def growing(n):
    """The producer resends the whole list each time."""
    return [json.dumps([record(i, i % 3) for i in range(k + 1)]) for k in range(n)]


def write(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def run(spark, tmp_path, source):
    raw = M.read_review_stream(spark, {"path": str(source)}, fmt="text")
    flat = M.stream_reviews(M.first_products(M.decode_messages(raw)))
    query = M.run_stream(flat, str(tmp_path / "cp"), path=str(tmp_path / "out"))
    query.awaitTermination(120)
    assert query.exception() is None
    return spark.read.parquet(str(tmp_path / "out"))


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    source = tmp_path / "in"
    bad = json.dumps([{"url": "e1", "error": "page not found"}])
    write(source, "a.txt", [*growing(4), "not json", bad])
    first = run(spark, tmp_path, source)
    batch_raw = spark.read.text(str(source)).withColumn("offset", F.monotonically_increasing_id())
    records = M.latest_products(M.decode_messages(batch_raw), "offset")
    batch = M.stream_reviews(records)
    rows = sorted(map(str, batch.collect()))
    assert sorted(map(str, first.collect())) == rows
    # records 0 and 3 and the error record have no reviews but keep a row
    assert len(rows) == 1 + 1 + 2 + 1 + 1
    assert sorted(map(str, run(spark, tmp_path, source).collect())) == rows
    write(source, "b.txt", growing(6))
    urls = {r["url"] for r in run(spark, tmp_path, source).select("url").collect()}
    assert urls == {f"u{i}" for i in range(6)} | {"e1"}
    assert run(spark, tmp_path, source).count() == len(rows) + 1 + 2


def test_bounded_state_with_watermark(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "a.txt", growing(3))
    raw = M.read_review_stream(spark, {"path": str(source)}, fmt="text")
    timed = M.decode_messages(raw.withColumn("ts", F.lit("2024-01-01").cast("timestamp")))
    once = M.first_products(timed, time="ts", horizon="1 hour").select("url")
    query = M.run_stream(once, str(tmp_path / "cp"), path=str(tmp_path / "out"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_publish_and_decode_round_trip(spark, tmp_path):
    df = spark.read.json(
        spark.createDataFrame([(json.dumps(record(i)),) for i in range(5)], "value string").select(
            F.col("value")
        ).rdd.map(lambda r: r[0]),
        schema=schemas.PRODUCT_RECORD,
    )
    M.publish(df, {"path": str(tmp_path / "topic")}, fmt="text")
    back = M.decode_messages(spark.read.text(str(tmp_path / "topic")))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.select(back.columns).collect()))


def test_old_products_are_forgotten_and_bad_messages_kept(spark, tmp_path):
    source = tmp_path / "in"
    times = ["2024-01-01 00:00:00", "2024-01-01 00:10:00", "2024-01-03 00:00:00", "2024-01-05 00:00:00"]
    for n, at in enumerate(times):
        write(source, f"{n}.txt", [json.dumps([record(1)]), f"bad {n}"])
        raw = M.read_review_stream(spark, {"path": str(source)}, fmt="text")
        timed = M.decode_messages(raw.withColumn("ts", F.lit(at).cast("timestamp")))
        once = M.first_products(timed, time="ts", horizon="1 hour").select("url", "ts")
        query = M.run_stream(once, str(tmp_path / "cp"), path=str(tmp_path / "out"))
        query.awaitTermination(120)
    kept = {str(r["ts"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert kept == {times[0], times[2], times[3]}
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    raw = spark.read.text(str(source))
    assert {r["value"] for r in M.malformed_messages(raw).collect()} == {f"bad {n}" for n in range(4)}


def test_late_and_resent_records(spark, tmp_path):
    """Records carry their own times: resent within the horizon, after it, too late, and out of order."""
    source = tmp_path / "in"
    batches = [
        [(1, "00:00"), (2, "00:05")],
        [(1, "00:30"), (2, "01:10"), (2, "01:20"), (4, "02:00")],  # 1 again, 2 anew, 2 again
        [(1, "01:30"), (3, "00:20"), (5, None), (5, None)],  # 1 anew, 3 from before the watermark
    ]
    for n, batch in enumerate(batches):
        lines = [json.dumps([record(i) | {"price": at and f"2024-01-01 {at}:00"}]) for i, at in batch]
        write(source, f"{n}.txt", lines)
        raw = M.read_review_stream(spark, {"path": str(source)}, fmt="text")
        timed = M.decode_messages(raw).withColumn("ts", F.to_timestamp("price"))
        once = M.first_products(timed, time="ts", horizon="1 hour")
        assert once.columns == timed.columns
        query = M.run_stream(once, str(tmp_path / "cp"), path=str(tmp_path / "out"))
        query.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    kept = sorted((r["url"], r["ts"] and f"{r['ts']:%H:%M}") for r in rows)
    urls = {i: record(i)["url"] for i in range(6)}
    expected = [(1, "00:00"), (2, "00:05"), (2, "01:10"), (4, "02:00"), (1, "01:30"), (5, None)]
    assert kept == sorted((urls[i], at) for i, at in expected)
    # Nested fields come through as they were.
    whole = spark.read.text(str(source)).select("value")
    plain = {str(r["reviews"]) + str(r["ratings"]) for r in M.decode_messages(whole).collect()}
    assert {str(r["reviews"]) + str(r["ratings"]) for r in rows} <= plain


def test_publication_is_not_repeated_after_a_crash(spark, tmp_path):
    """The job dies between the write of a batch and its commit; the restarted one replaces that batch."""
    source, topic = tmp_path / "in", tmp_path / "topic"
    schema = "url string, name string"

    def publish(crash):
        def fail(number):
            if number == crash:
                raise RuntimeError("killed")

        records = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
        query = M.publish_stream(records, str(tmp_path / "cp"), {"path": str(topic)}, "text", after_write=fail)
        try:
            query.awaitTermination(120)
        except Exception:  # noqa: BLE001
            pass

    for n in range(3):
        write(source, f"{n}.json", [json.dumps({"url": f"u{n}{i}", "name": "n"}) for i in range(4)])
    publish(crash=1)
    assert spark.read.text(str(topic)).count() == 8
    publish(crash=None)
    rows = [json.loads(r["value"])[0]["url"] for r in spark.read.text(str(topic)).select("value").collect()]
    assert sorted(rows) == sorted(f"u{n}{i}" for n in range(3) for i in range(4))
    publish(crash=None)  # nothing new
    assert spark.read.text(str(topic)).count() == 12


def test_message_keys_are_the_same_for_both_attempts(spark):
    values = spark.createDataFrame([("a",), ("b",)], "value string")
    keys = [sorted(r[0] for r in values.select(M.message_key(n, F.col("value"))).collect()) for n in (3, 3, 4)]
    assert keys[0] == keys[1] != keys[2] and len(set(keys[0])) == 2
