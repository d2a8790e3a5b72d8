"""Compare a Spark result with its DuckDB twin: columns, types up to width, and every row."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _canon(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if value is not None and value.__class__.__name__ == "Decimal":
        return float(value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_canon(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None if equal, else a short account of the first differences."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(columns)}"
    expected = rows_of(columns, result.fetchall())
    found = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows against {sum(expected.values())}; "
        f"only Spark {list(extra)[:2]}; only SQL {list(missing)[:2]}"
    )
