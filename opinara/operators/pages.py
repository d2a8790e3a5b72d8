"""Product pages to product and review records."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions import cleaning as C
from opinara.operators import page_parser
from opinara.operators.aggregates import explode_rows
from opinara.operators.page_parser import PageLayout, page_pieces

# The parser travels with the task, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(page_parser)

_TEXTS = T.ArrayType(T.StringType())
_REVIEW_PIECES = T.StructType(
    [
        T.StructField(n, _TEXTS)
        for n in (
            "author", "rating", "header", "posted", "collapsed", "hidden", "comments", "plain"
        )
    ]
)
_PIECES = [
    T.StructField("names", _TEXTS),
    T.StructField("prices", _TEXTS),
    T.StructField("ratings", T.MapType(T.StringType(), T.StringType())),
    T.StructField("reviews", T.ArrayType(_REVIEW_PIECES)),
]

_PA_TEXTS = pa.list_(pa.string())
_PA_PIECES = {
    "names": _PA_TEXTS,
    "prices": _PA_TEXTS,
    "ratings": pa.map_(pa.string(), pa.string()),
    "reviews": pa.list_(pa.struct([(n, _PA_TEXTS) for n in _REVIEW_PIECES.fieldNames()])),
}


def _review_lists(found: list[dict]) -> pa.Array:
    """The pages' reviews, built field by field: records of lists take Arrow several times as long."""
    offsets = pa.array([0, *accumulate(len(f["reviews"]) for f in found)], pa.int32())
    names = _REVIEW_PIECES.fieldNames()
    fields = [pa.array([r[n] for f in found for r in f["reviews"]], _PA_TEXTS) for n in names]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names))


def page_errors(pages: DataFrame) -> DataFrame:
    """``url, error`` for the pages that were not fetched."""
    error = C.fetch_error(F.col("status"))
    return pages.select("url", error.alias("error")).where(F.col("error").isNotNull())


def raw_pieces(pages: DataFrame, layout: PageLayout = PageLayout()) -> DataFrame:
    """Pieces of every fetched page. HTML is not XML, so this is the one step in Python workers;
    it is row by row within a batch and needs no shuffle."""
    kept = pages.select("page_id", "url", C.remove_nulls(F.col("html")).alias("html"))
    schema = T.StructType([*kept.schema.fields[:2], *_PIECES])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_pieces(h or "", layout) for h in batch.column("html").to_pylist()]
            columns = {"page_id": batch.column("page_id"), "url": batch.column("url")}
            for name, kind in _PA_PIECES.items():
                columns[name] = _review_lists(found) if name == "reviews" else pa.array([f[name] for f in found], type=kind)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return kept.mapInArrow(parse, schema)


def _review_record(piece: Column) -> Column:
    def words(name: str) -> Column:
        return C.clean_text(F.array_join(piece[name], " "))

    collapsed = F.when(F.size(piece["collapsed"]) > 0, F.array_join(piece["collapsed"], " "))
    return F.struct(
        C.parse_comment_count(F.array_join(piece["comments"], "")).alias("review_comment_count"),
        C.review_text_rule(
            collapsed, F.get(piece["hidden"], F.lit(0)), F.array_join(piece["plain"], " ")
        ).alias("review_text"),
        C.normalize_date(F.array_join(piece["posted"], "")).alias("review_posted_date"),
        words("header").alias("review_header"),
        C.parse_stars(F.array_join(piece["rating"], "")).alias("review_rating"),
        words("author").alias("review_author"),
    )


def extract_products(pages: DataFrame, layout: PageLayout = PageLayout()) -> DataFrame:
    """One record per page: ``page_id, url, name, price, ratings, reviews, error``.

    Pages that were not fetched give error records with null fields.
    """
    fetched = raw_pieces(pages.where(F.col("status") == 200), layout).select(
        "page_id",
        "url",
        C.strip(F.array_join("names", "")).alias("name"),
        C.parse_price(F.array_join("prices", "")).alias("price"),
        "ratings",
        F.transform("reviews", _review_record).alias("reviews"),
        F.lit(None).cast("string").alias("error"),
    )
    failed = pages.select("page_id", "url", C.fetch_error(F.col("status")).alias("error")).where(
        F.col("error").isNotNull()
    )
    return fetched.unionByName(failed, allowMissingColumns=True)


def extract_reviews(products: DataFrame) -> DataFrame:
    """One row per review of each product record, with its position on the page."""
    return explode_rows(products.select("url", "reviews"), "reviews", "pos", "r").select(
        "url", "pos", "r.*"
    )


def rating_histogram(products: DataFrame) -> DataFrame:
    rows = products.select("url", F.explode_outer("ratings").alias("rating", "share"))
    return rows.where(F.col("rating").isNotNull())


def flat_piece(html: Column, tag: str) -> Column:
    """Text of the first ``tag`` element, tags removed; for flat marks no parser is needed."""
    return C.clean_text(C.strip_tags(F.regexp_extract(html, rf"(?s)<{tag}>(.*?)</{tag}>", 1)))


def flat_blocks(html: Column, primary: str, fallback: str) -> Column:
    """All matches of ``primary`` (group 1), or of ``fallback`` if there are none."""
    first = F.regexp_extract_all(html, F.lit(primary), F.lit(1))
    second = F.regexp_extract_all(html, F.lit(fallback), F.lit(1))
    blocks = F.when(F.size(first) > 0, first).otherwise(second)
    return F.transform(blocks, lambda b: C.clean_text(C.strip_tags(b)))
