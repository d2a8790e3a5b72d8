"""Writers. Output is parallel unless one file is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.text import array_to_text
from opinara.operators.lexicon import render_lexicon


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "\t",
    header: bool = False,
    single_file: bool = False,
    mode: str = "errorifexists",
) -> None:
    """UTF-8 delimited text; array columns are written as ``[a, b]``.

    ``single_file`` sends everything through one task: only for small results.
    """
    flat = df.select(
        *[
            array_to_text(F.col(n)).alias(n) if t.startswith("array") else F.col(n)
            for n, t in df.dtypes
        ]
    )
    out = flat.coalesce(1) if single_file else flat
    out.write.mode(mode).options(sep=sep, header=header, encoding="UTF-8").csv(path)


def write_recommendations(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    """Recommendations with their array column kept as an array."""
    df.write.mode(mode).format(fmt).save(path)


def write_products_json(products: DataFrame, path: str, mode: str = "errorifexists") -> None:
    products.write.mode(mode).json(path)


def write_lexicon(
    lexicon: DataFrame, path: str, mode: str = "errorifexists", lines: DataFrame | None = None
) -> None:
    """A new version of the lexicon as tab-separated lines in line order.

    With ``lines`` (the old file's lines, as they are) the rows are appended to them, so comments,
    malformed lines and the spelling of old values stay.
    """
    rows = render_lexicon(lexicon)
    whole = rows if lines is None else lines.select("line_no", "value").unionByName(rows)
    whole.orderBy("line_no").select("value").write.mode(mode).text(path)


def preview(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)
