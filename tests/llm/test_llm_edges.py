"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, per operator."""

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinara.llm import (
    exact_dedup,
    jaccard_join,
    language,
    line_dedup,
    mix,
    packing,
    pii,
    substring_dedup,
    toxicity,
    vector_dedup,
)
from opinara.llm.catalog import packing_tokenizer

LONG = " ".join(f"w{i % 7919}" for i in range(30_000))
TEXT = "The quick brown fox jumps over the lazy dog and then sleeps for a very long time under a tree " * 2
ROWS = [
    (1, TEXT, "en", "a"),
    (2, TEXT.upper(), "en", "a"),
    (3, None, None, None),
    (4, "", "de", "b"),
    (5, " \t\n \n", "de", "b"),
    (6, LONG, "en", "c"),
    (7, "ünïcödé ß 🙂", "de", None),
    (7, "ünïcödé ß 🙂", "de", None),
    (8, TEXT + "\nan extra line\nan extra line", "en", "c"),
    (None, TEXT, "en", "a"),
    (9, "one two", None, "b"),
]
#: Names that operators use themselves.
CLASHING = "row size kept n a b id line digest at bucket target taken _id _gone _words node component".split()
KEEPING = {
    "mix": mix.mixed_documents,
    "lines": line_dedup.deduplicated,
    "join": jaccard_join.representatives,
    "pii": pii.pseudonymised,
    "toxicity": lambda d: toxicity.clean_documents(d, toxicity.fit([b"idiot fool", b"good day"], [1, 0])),
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def wide(docs):
    return docs.withColumns({c: F.lit(f"is {c}") for c in CLASHING})


def results(docs):
    spark = docs.sparkSession
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    return {
        "substrings": substring_dedup.substring_dedup(docs),
        "mix": mix.mix(docs),
        "pii": pii.pseudonymised(docs),
        "lines": line_dedup.line_dedup(docs),
        "packing": packing.packed(docs, *packing_tokenizer()),
        "language": language.identify(docs, language.train(docs)),
        "join": jaccard_join.near_groups(docs),
        "toxicity": toxicity.toxicity(docs, labels),
    }


def test_every_row_has_a_result(docs):
    for name, frame in results(docs).items():
        rows = frame.collect()
        ids = [r["doc_id"] for r in rows]
        if name in ("lines", "packing"):
            assert set(ids) == {r[0] for r in ROWS}, name
        else:
            assert sorted(ids, key=str) == sorted((r[0] for r in ROWS), key=str), name


def test_empty_tables(docs):
    for name, frame in results(docs.limit(0)).items():
        assert frame.count() == 0, name
    for name, step in KEEPING.items():
        assert step(docs.limit(0)).count() == 0, name


@pytest.mark.parametrize("name", KEEPING)
def test_clashing_columns_pass_through(wide, name):
    out = KEEPING[name](wide)
    assert out.columns[: len(wide.columns)] == wide.columns
    for row in out.collect():
        assert all(row[c] == f"is {c}" for c in CLASHING)


def test_exact_dedup(spark, docs, tmp_path):
    path = str(tmp_path / "docs.parquet")
    docs.withColumns({c: F.lit(0) for c in CLASHING}).repartition(3).write.parquet(path)
    spark.read.parquet(path).limit(0).write.parquet(f"{path}-empty")
    rows = exact_dedup.exact_dedup(spark, path, batch_bytes=1).collect()
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], []).append((r["keep_id"], r["group_size"], r["kept"]))
    assert found[1] == [(2, 3, False)] and found[2] == [(2, 3, True)] and found[None] == [(2, 3, False)]
    assert found[3] == [(4, 2, False)] and found[4] == [(4, 2, True)]
    assert sorted(found[7]) == [(7, 2, False), (7, 2, True)]
    assert exact_dedup.exact_dedup(spark, f"{path}-empty").count() == 0
    # A digest that says nothing: the bytes decide.
    rows = exact_dedup.exact_dedup(spark, path, digest=lambda t: F.lit("same")).collect()
    again = {}
    for r in rows:
        again.setdefault(r["doc_id"], []).append((r["keep_id"], r["group_size"], r["kept"]))
    assert {k: sorted(v) for k, v in again.items()} == {k: sorted(v) for k, v in found.items()}


def test_exact_dedup_over_a_hot_group(spark, tmp_path):
    path = str(tmp_path / "docs.parquet")
    spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Same").otherwise(F.col("id").cast("string")).alias("text")
    ).write.parquet(path)
    out = exact_dedup.exact_dedup(spark, path)
    hot = out.where("group_size > 1")
    assert out.count() == 3000 and hot.count() == 1000
    assert hot.select("keep_id").distinct().collect() == [(2997,)] and hot.where("kept").count() == 1


def test_vectors(spark):
    rows = [
        (1, [1.0, 0.0, 0.0], 1, "x"), (2, [2.0, 0.0, 0.0], 1, "x"), (3, [1.0, 0.01, 0.0], 1, "x"),
        (4, [1.0, 0.0, 0.0], 2, "x"), (5, [1.0, 0.0, 0.0], None, "x"), (6, None, 1, "x"),
        (7, [0.0, 0.0, 0.0], 1, "x"), (8, [1.0, None, 0.0], 1, "x"), (9, [float("nan"), 1.0, 0.0], 1, "x"),
        (10, [], 1, "x"), (11, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0, 0.0], 1, "x"), (None, [3.0, 0.0, 0.0], 1, "x"),
        (12, [1e300, 0.0, 0.0], 1, "x"), (13, [float("inf"), 0.0, 0.0], 1, "x"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, row string")
    out = vector_dedup.near_vectors(frame).collect()
    found = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in out)
    linked = {(k, 5, 1, k == "1") for k in ("1", "2", "3", "12", "None")}
    assert {f for f in found if f[1]} == linked and len(found) == len(rows)
    assert all(f[2] == int(f[0]) and f[3] for f in found if not f[1])
    assert vector_dedup.near_vectors(frame.limit(0)).count() == 0


def test_words_are_split_like_the_plain_version(docs):
    sizes = {r["doc_id"]: r["size"] for r in mix.mix(docs).collect()}
    for doc_id, text, *_ in ROWS:
        assert sizes[doc_id] == len(brute.WORD.findall(text or "")), doc_id


def test_toxicity_takes_documents_in_small_batches(spark, monkeypatch):
    """Whole documents travel to Python; the session's batch size is as before afterwards."""

    def sized(docs, machine):
        def run(batches):
            for b in batches:
                column = pa.array([float(b.num_rows > machine)] * b.num_rows)
                yield pa.RecordBatch.from_arrays([*b.columns, column], names=[*b.schema.names, "toxicity"])

        return docs.mapInArrow(run, docs.withColumn("toxicity", F.lit(0.0)).schema)

    monkeypatch.setattr(toxicity, "score", sized)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(0, 2100, 1, 1).selectExpr("id AS doc_id", "'a good day' AS text")
    found = toxicity.clean_documents(docs, 500)
    assert found.columns == docs.columns and found.count() == 2100
    assert spark.conf.get(name) == before
