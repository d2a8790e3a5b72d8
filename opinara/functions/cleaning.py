"""Cleaning rules for the pieces of a product page, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRODUCT_URL_BASE = "http://www.amazon.com/dp/"

# Date spellings after commas and dots are removed: shape, then Spark pattern.
_DATE_SHAPES = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{8}$", "yyyyMMdd"),
    # Month first; day first where that is no month.
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2} \d{1,2} \d{4}$", "M d yyyy"),
    (r"^\d{1,2} \d{1,2} \d{4}$", "d M yyyy"),
    (r"^[A-Z][a-z]{2} \d{1,2} \d{4}$", "MMM d yyyy"),
    (r"^[A-Z][a-z]{3,} \d{1,2} \d{4}$", "MMMM d yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{3,} \d{4}$", "d MMMM yyyy"),
]

# A time of day behind the date, with seconds, half of the day and zone if any.
_TIME = r"(?i)(?:[t,]|\s+(?:at\s+)?)\s*\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:[ap]\.?m\.?)?\s*(?:z|utc|gmt|[+-]\d{2}:?\d{2})?$"


def product_url(product_id: Column, base: str = PRODUCT_URL_BASE) -> Column:
    return F.concat(F.lit(base), product_id)


def remove_nulls(text: Column) -> Column:
    return F.replace(text, F.lit("\x00"), F.lit(""))


def strip(text: Column) -> Column:
    """Without blanks, tabs and line ends around it."""
    return F.btrim(text, F.lit(" \t\n\x0b\x0c\r\x85\u00a0"))


def clean_text(text: Column) -> Column:
    """No null bytes, one blank between words, none at the ends."""
    return F.trim(F.regexp_replace(remove_nulls(text), r"[\s\p{Z}]+", " "))


def parse_price(raw: Column) -> Column:
    return F.replace(raw, F.lit(","), F.lit(""))


def parse_stars(raw: Column) -> Column:
    """Star text without its unit; the blank before the unit stays."""
    return F.replace(raw, F.lit("out of 5 stars"), F.lit(""))


def stars_value(raw: Column) -> Column:
    return strip(parse_stars(raw)).try_cast("double")


def parse_comment_count(raw: Column) -> Column:
    return strip(F.regexp_replace(raw, "[A-Za-z]", ""))


def parse_date(raw: Column) -> Column:
    """A date from the usual free-form spellings, else null.

    Weekdays and times of day are dropped. A date without its day, month or year is null: nothing
    is filled in.
    """
    text = F.regexp_replace(clean_text(raw), r"(?i)^on\s+", "")
    text = F.regexp_replace(text, _TIME, "")
    text = F.regexp_replace(text, r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*[,.]?\s+", "")
    text = F.regexp_replace(text, r"(?i)(\d)(st|nd|rd|th)\b", "$1")
    text = F.regexp_replace(text, r"(?<=\d)-(?=[A-Za-z])|(?<=[A-Za-z])-(?=\d)", " ")
    text = F.initcap(F.trim(F.regexp_replace(text, r"[,.\s]+", " ")))
    text = F.regexp_replace(text, r"\bSept\b", "Sep")
    return F.coalesce(
        *[F.when(text.rlike(shape), F.try_to_date(text, fmt)) for shape, fmt in _DATE_SHAPES]
    )


def normalize_date(raw: Column) -> Column:
    return F.date_format(parse_date(raw), "dd MMM yyyy")


def strip_tags(text: Column) -> Column:
    """Remove ``<...>`` within a line."""
    return F.regexp_replace(text, r"<[^>\n]*+>", "")


def review_text_rule(collapsed: Column, hidden_json: Column, plain: Column) -> Column:
    """Collapsed text plus the tag-free rest of the hidden JSON; without collapsed text, ``plain``."""
    shown = clean_text(collapsed)
    rest = strip_tags(F.get_json_object(hidden_json, "$.rest"))
    full = F.concat(shown, F.coalesce(rest, F.lit("")))
    absent = collapsed.isNull() | (collapsed == "")
    return F.when(absent, clean_text(F.coalesce(plain, F.lit("")))).otherwise(full)


def fetch_error(status: Column) -> Column:
    """Error text for a page that was not fetched; null for status 200."""
    return F.when(status == 404, F.lit("page not found")).when(
        status.isNull() | (status != 200), F.lit("failed to process the page")
    )


def rating_map(entries: Column) -> Column:
    """``array<struct<key,value>>`` to a map; a repeated or empty key keeps its last value."""
    kept = F.filter(entries, lambda e: e["key"].isNotNull() & (e["key"] != ""))
    last = F.filter(
        kept,
        lambda e, i: ~F.exists(
            F.slice(kept, i + 2, F.greatest(F.size(kept), F.lit(1))),
            lambda later: later["key"] == e["key"],
        ),
    )
    return F.map_from_entries(last)
