"""Leaders over all months from the large rows alone, with a proof.

The leaders by total clicks nearly always have large months. A round reads the rows of at least ``least`` clicks (a
filter that reaches the scan; the trend is sorted by clicks in its files). What it reads of an article is a lower bound of its total, and each
month it did not see adds less than ``least``, so an upper bound follows as well. When the k-th lower bound is above the
upper bound of every other article, seen or not, the leaders are proven. Else the next round reads further down, by FACTOR, and
the last one reads everything, where lower and upper bounds are the totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.operators.ranking import top_k
from navstream.operators.serving import not_excluded
from navstream.settings import EXCLUDED_ARTICLES

FACTOR = 4


def leaders_by_threshold(trend: DataFrame, k: int = 10, excluded: Sequence[str] = EXCLUDED_ARTICLES) -> tuple[list[str | None], int]:
    """The ``k`` articles of the most clicks over all months, ties by title, and the ``least`` of the round that proved them. The
    driver sees k + 1 rows a round."""
    rows = trend.where(not_excluded("curr", excluded))
    months, most = trend.agg(F.count_distinct("month") + F.max(F.col("month").isNull().cast("int")), F.max("monthly_clicks")).first()
    least = (most or 0) // 2
    while True:
        seen = rows.where(F.col("monthly_clicks") >= least) if least > 0 else rows
        bounds = seen.groupBy("curr").agg(F.sum("monthly_clicks").alias("low"), F.count(F.lit(1)).alias("held"))
        if least <= 0:
            return [r["curr"] for r in top_k(bounds, ["low"], ["curr"], k).collect()], 0
        # an unseen month has at most least - 1 clicks
        bounds = bounds.withColumn("high", F.col("low") + (F.lit(months) - F.col("held")) * (least - 1))
        first = top_k(bounds, ["low"], ["curr"], k)
        leaders = first.collect()
        if len(leaders) == k:
            names = [r["curr"] for r in leaders]
            others = bounds.where(~F.coalesce(F.col("curr").isin([n for n in names if n is not None]), F.lit(None in names)))
            rival = max(others.agg(F.max("high")).first()[0] or 0, months * (least - 1))
            if leaders[-1]["low"] > rival:
                return names, least
        least //= FACTOR


def trend_of_leaders_by_threshold(trend: DataFrame, k: int = 10, excluded: Sequence[str] = EXCLUDED_ARTICLES) -> DataFrame:
    """Monthly series of the leaders; only their rows are read for it."""
    names, _ = leaders_by_threshold(trend, k, excluded)
    kept = F.col("curr").isin([n for n in names if n is not None])
    if None in names:
        kept = kept | F.col("curr").isNull()
    return trend.where(kept).orderBy("month", "curr")
