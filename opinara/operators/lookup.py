"""From recommendation lists to titled products, for one user or for all at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.text import text_to_ids
from opinara.operators.aggregates import first_row

# Fixed value: shown for a product without a title.
NO_TITLE = "TITLE NOT AVAILABLE"


def recs_with_users(recs: DataFrame, users: DataFrame) -> DataFrame:
    """``user_id, user, rec_prods`` for users that have recommendations."""
    return recs.join(users, "user_id").select("user_id", "user", "rec_prods")


def recs_for_user(recs: DataFrame, users: DataFrame, user_id: int) -> DataFrame:
    """The one row of a user; an unknown user gives no row. The id filter reaches both scans."""
    one = F.col("user_id") == F.lit(user_id)
    return first_row(recs_with_users(recs.where(one), users.where(one)), "user_id")


def ranked_ids(recs: DataFrame) -> DataFrame:
    """``user_id, rank, pro_id``; a repeated id keeps its first place. Text lists are parsed."""
    ids = F.col("rec_prods")
    if dict(recs.dtypes)["rec_prods"] == "string":
        ids = text_to_ids(ids)
    return recs.select(
        "user_id", F.posexplode(F.array_distinct(ids)).alias("pos", "pro_id")
    ).select("user_id", (F.col("pos") + 1).alias("rank"), "pro_id")


def recommended_products(recs: DataFrame, products: DataFrame) -> DataFrame:
    """``user_id, rank, product`` for the recommended ids that are known products."""
    return ranked_ids(recs).join(products, "pro_id").select("user_id", "rank", "product")


def title_dedup(titles: DataFrame, order: str, key: str = "movie") -> DataFrame:
    """One title per product: the last one in ``order``."""
    return titles.groupBy(key).agg(F.max_by("title", order).alias("title"))


def with_titles(rows: DataFrame, titles: DataFrame, default: str = NO_TITLE) -> DataFrame:
    """Add ``title`` by ``product``; ``titles`` holds one row per product."""
    named = titles.select(F.col("movie").alias("product"), F.col("title"))
    return rows.join(named, "product", "left").withColumn(
        "title", F.coalesce("title", F.lit(default))
    )


def recommendation_report(
    recs: DataFrame,
    users: DataFrame,
    products: DataFrame,
    titles: DataFrame,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """``user_id, user, rank, product, title`` for all users, or for those in ``wanted``."""
    if wanted is not None:
        recs = recs.join(wanted.select("user_id"), "user_id", "left_semi")
    titled = with_titles(recommended_products(recs, products), titles)
    return titled.join(users, "user_id").select("user_id", "user", "rank", "product", "title")
