"""The queries of this package over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opinara.llm import (
    byte_bpe,
    exact_dedup,
    jaccard_join,
    language,
    line_dedup,
    mix,
    packing,
    pii,
    prefix_trie,
    spelling,
    substring_dedup,
    toxicity,
    vector_dedup,
)


def packing_tokenizer() -> tuple[str, str]:
    """Ranks file and split pattern of the byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pii.pseudonymised(docs.select("doc_id", "text"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), *packing_tokenizer())


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return language.identify(docs, language.train(docs))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return byte_bpe.round_trip_digests(docs, *packing_tokenizer())


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.family_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_mix_sources": op3_mix_sources,
    "op4_pii": op4_pii,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_vector_dedup": op7_vector_dedup,
    "op8_language": op8_language,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_spelling": op11_spelling,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_prefix_trie": op13_prefix_trie,
}
