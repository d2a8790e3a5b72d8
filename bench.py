"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to completion into the no-op sink. Short queries are run once to warm up and
then three times (the median counts); model fits are run once. ``als_tuning`` is timed over four points of
the grid, as in earlier rounds; the query of that name runs all 66.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from opinara.operators import recommend  # noqa: E402
from opinara.plans import tables  # noqa: E402
from opinara.plans.catalog import QUERIES  # noqa: E402
from opinara.session import local_session  # noqa: E402

WARM = [
    "top_aspects",
    "aspect_lists",
    "term_counts",
    "tag_tokens",
    "product_sentiment",
    "sentiment_basic",
    "sentiment_full",
    "page_products",
    "page_records",
    "recommendation_report",
    "concat_reviews",
    "map_ids",
    "vocabulary",
    "lexicon_missing_words",
    "nearest_vectors",
    "normalize_date",
    "stream_dedup",
    "stream_reviews",
]
ONCE = ["recommend_all", "als_tuning", "word_vectors"]


def four_points(spark, sf_dir: str):
    return recommend.tune_als(tables.ratings(spark, sf_dir), ranks=recommend.RANKS[:2], regs=recommend.REG_PARAMS[:2])


TIMED = {**QUERIES, "als_tuning": four_points}


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    TIMED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or WARM + ONCE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        first = timed(spark, sf_dir, name)
        if name in ONCE:
            seconds[name] = round(first, 3)
        else:
            runs = [timed(spark, sf_dir, name) for _ in range(3)]
            seconds[name] = round(statistics.median(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
