"""Declared schemas; nothing in the library infers one."""

from pyspark.sql import types as T

REVIEWS = "review_id bigint, product_id string, review_text string"
RATINGS = "user int, item int, rating double"
LEXICON = "line_no bigint, token string, valence decimal(28,14), sd double, raw string"
PAGES = "page_id bigint, url string, status int, html string"
RECOMMENDATIONS = "user_id int, rec_prods array<int>"
USERS = "user_id int, user string"
PRODUCTS = "pro_id int, product string"
TITLES = "movie string, title string"

_REVIEW_FIELDS = (
    "review_comment_count",
    "review_text",
    "review_posted_date",
    "review_header",
    "review_rating",
    "review_author",
)

REVIEW_RECORD = T.StructType([T.StructField(n, T.StringType()) for n in _REVIEW_FIELDS])

# A product record; error records fill only url and error.
PRODUCT_RECORD = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("ratings", T.MapType(T.StringType(), T.StringType())),
        T.StructField("reviews", T.ArrayType(REVIEW_RECORD)),
        T.StructField("error", T.StringType()),
    ]
)

# A message holds a JSON array of product records.
MESSAGE = T.ArrayType(PRODUCT_RECORD)
