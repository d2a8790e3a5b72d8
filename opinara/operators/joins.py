"""Equi-joins of the review pipelines. No hints: Spark picks broadcast by measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame


def full_outer_join(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """All rows of both sides, the keys coalesced."""
    return left.join(right, list(keys), "full_outer")


def known_rows(df: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    return df.join(table.select(*keys), list(keys), "left_semi")


def missing_rows(df: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    return df.join(table.select(*keys), list(keys), "left_anti")
