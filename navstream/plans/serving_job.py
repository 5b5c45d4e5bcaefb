"""The dashboard's questions as lazy DataFrames over the written marts.

Nothing here loads a table into the driver: each entry is a Spark plan the caller can show,
collect (all results are small: top-k boards, one KPI row, one wiki's series) or write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from navstream.operators import clickstream as C
from navstream.operators import serving as S
from navstream.settings import ServingSettings
from navstream.sources.tables import read_mart


def batch_boards(
    spark: SparkSession, batch_dir: str, month: str | None = None, settings: ServingSettings = ServingSettings()
) -> dict[str, DataFrame]:
    """Month picker, the three top-k boards of ``month`` (latest when None) and the leaders' trend."""
    indegree = read_mart(spark, batch_dir, "top_articles_indegree")
    outdegree = read_mart(spark, batch_dir, "top_articles_outdegree")
    pairs = read_mart(spark, batch_dir, "top_link_pairs")
    trend = read_mart(spark, batch_dir, "monthly_trend")
    return {
        "months": C.month_picker(indegree),
        "top_inbound": S.top_inbound(indegree, month, settings.top_k, settings.excluded_articles),
        "top_outbound": S.top_outbound(outdegree, month, settings.top_k),
        "top_pairs": S.top_pairs(pairs, month, settings.top_k),
        "trend_of_leaders": S.trend_of_leaders(trend, settings.trend_top_k, settings.excluded_articles),
    }


def stream_boards(
    spark: SparkSession, stream_dir: str, settings: ServingSettings = ServingSettings()
) -> dict[str, DataFrame]:
    """KPIs, one wiki's edit-rate series, type totals and series, top editors of the latest window."""
    rate = read_mart(spark, stream_dir, "edits_per_wiki_per_minute")
    breakdown = read_mart(spark, stream_dir, "edit_type_breakdown")
    editors = read_mart(spark, stream_dir, "top_editors_sliding")
    return {
        "kpis": S.edit_kpis(rate),
        "rate_series": S.edit_rate_series(rate, settings.rate_wiki),
        "type_totals": S.edit_type_totals(breakdown),
        "type_series": breakdown.orderBy("window_start", "type"),
        "top_editors": S.top_editors_latest_window(editors, settings.editors_top_k),
    }
