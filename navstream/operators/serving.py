"""Serving-layer queries over the marts: top-k boards, trend of the leaders, stream KPIs.

These run on the (small, month-partitioned) marts; month filters prune partitions at the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.functions.events import pair_label
from navstream.operators.ranking import top_k, top_k_of_latest
from navstream.settings import EXCLUDED_ARTICLES


def not_excluded(col: str, excluded: Sequence[str]) -> F.Column:
    """True unless the value is in ``excluded``; a NULL value is kept."""
    return F.coalesce(~F.col(col).isin(*excluded), F.lit(True)) if excluded else F.lit(True)


def _month_top_k(df: DataFrame, month: str | None, measures: list[str], tie_break: list[str], k: int) -> DataFrame:
    """Top-k of one month; the latest month when ``month`` is None (a month filter prunes partitions)."""
    if month is None:
        return top_k_of_latest(df, "month", measures, tie_break, k)
    return top_k(df.filter(F.col("month") == month), measures, tie_break, k)


def top_inbound(
    indegree: DataFrame, month: str | None = None, k: int = 20, excluded: Sequence[str] = EXCLUDED_ARTICLES
) -> DataFrame:
    """Top-k targets of one month (latest when ``month`` is None), minus excluded articles.

    The latest month is the mart's latest month whatever its articles; exclusion applies after.
    """
    keep = not_excluded("curr", excluded)
    if month is None:
        return top_k_of_latest(indegree, "month", ["total_clicks"], ["curr"], k, keep=keep)
    return top_k(indegree.filter((F.col("month") == month) & keep), ["total_clicks"], ["curr"], k)


def top_outbound(outdegree: DataFrame, month: str | None = None, k: int = 20) -> DataFrame:
    """Top-k referrers of one month."""
    return _month_top_k(outdegree, month, ["total_clicks_sent"], ["prev"], k)


def top_pairs(pairs: DataFrame, month: str | None = None, k: int = 20) -> DataFrame:
    """Top-k link pairs of one month with a ``prev  →  curr`` label."""
    ranked = _month_top_k(pairs, month, ["total_clicks"], ["prev", "curr"], k)
    return ranked.withColumn("link", pair_label("prev", "curr"))


def article_totals(trend: DataFrame, excluded: Sequence[str] = EXCLUDED_ARTICLES) -> DataFrame:
    """All-months clicks per article."""
    return (
        trend.filter(not_excluded("curr", excluded))
        .groupBy("curr")
        .agg(F.sum("monthly_clicks").alias("total_clicks"))
    )


def trend_of_leaders(
    trend: DataFrame, k: int = 10, excluded: Sequence[str] = EXCLUDED_ARTICLES
) -> DataFrame:
    """Monthly series of the k articles with the most clicks over all months.

    The leader set has exactly k rows, so the semi join broadcasts a bounded side.
    """
    leaders = top_k(article_totals(trend, excluded), ["total_clicks"], ["curr"], k).select("curr")
    return trend.join(F.broadcast(leaders), "curr", "left_semi").orderBy("month", "curr")


def edit_kpis(rate: DataFrame) -> DataFrame:
    """One row: total edits, bot edits, bot share in percent (0 without edits), latest window."""
    totals = rate.agg(
        F.coalesce(F.sum("edit_count"), F.lit(0)).cast("bigint").alias("total_edits"),
        F.coalesce(F.sum("bot_edits"), F.lit(0)).cast("bigint").alias("total_bots"),
        F.max("window_start").alias("latest_window"),
    )
    return totals.select(
        "total_edits",
        "total_bots",
        F.when(F.col("total_edits") > 0, F.col("total_bots") / F.col("total_edits") * 100)
        .otherwise(F.lit(0.0))
        .alias("bot_pct"),
        "latest_window",
    )


def edit_type_totals(breakdown: DataFrame) -> DataFrame:
    """Events per type over all windows."""
    return breakdown.groupBy("type").agg(F.sum("count").alias("count"))


def edit_rate_series(rate: DataFrame, wiki: str = "enwiki") -> DataFrame:
    """Edit and bot counts of one wiki over time."""
    return (
        rate.filter(F.col("wiki") == wiki)
        .select("window_start", "edit_count", "bot_edits")
        .orderBy("window_start")
    )


def top_editors_latest_window(editors: DataFrame, k: int = 15) -> DataFrame:
    """Top-k editors of the most recent sliding window."""
    return top_k_of_latest(editors, "window_start", ["edit_count"], ["user", "wiki"], k)
