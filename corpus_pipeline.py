"""A training corpus in five stages, from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)``; its rows are written as Parquet and read again as the
next one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import jaccard_join, line_dedup, mix, packing, toxicity
from opinara.llm.catalog import packing_tokenizer
from opinara.llm.shared import stage


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of text."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine does not reject."""
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    machine = toxicity.train(raw, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean_documents(docs, machine)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line once: later copies and near copies are taken out of their documents."""
    return _counted(line_dedup.deduplicated(docs))


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy of a document that the mix takes."""
    return _counted(mix.mixed_documents(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.packed(docs, *packing_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Training a machine, MinHash and token ids have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs)
    return docs
