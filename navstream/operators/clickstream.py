"""Navigation-edge marts: in-degree, out-degree, link pairs, monthly trend, loaded months.

Input columns: ``prev, curr, type, n, month``. All aggregations are sums and counts, so Spark runs
them as partial (map-side) + final hash aggregation: a hub article that holds a third of all edges
is pre-summed in every map task and reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navstream.operators.ranking import top_n_per_group
from navstream.settings import MONTH_PATTERN


def internal_links(df: DataFrame) -> DataFrame:
    """Edges between two articles (``type = 'link'``)."""
    return df.filter(F.col("type") == "link")


def in_degree(df: DataFrame) -> DataFrame:
    """Inbound clicks per (month, target), all link types."""
    return df.groupBy("month", "curr").agg(F.sum("n").alias("total_clicks"))


def top_articles_by_indegree(df: DataFrame, n: int = 50) -> DataFrame:
    """Top-n targets per month by inbound clicks; ties broken by title."""
    return top_n_per_group(in_degree(df), ["month"], ["total_clicks"], ["curr"], n).select(
        "month", "curr", "total_clicks"
    )


def top_indegree_from_trend(trend: DataFrame, n: int = 50) -> DataFrame:
    """Top-n targets per month ranked from the monthly trend (the same per-(month, curr) sum)."""
    totals = trend.select("month", "curr", F.col("monthly_clicks").alias("total_clicks"))
    return top_n_per_group(totals, ["month"], ["total_clicks"], ["curr"], n).select("month", "curr", "total_clicks")


def link_pairs(df: DataFrame) -> DataFrame:
    """Clicks per (month, referrer, target) over internal links."""
    return internal_links(df).groupBy("month", "prev", "curr").agg(F.sum("n").alias("total_clicks"))


def top_link_pairs(df: DataFrame, n: int = 50, pairs: DataFrame | None = None) -> DataFrame:
    """Top-n internal link pairs per month; ties broken by (prev, curr).

    Pass ``pairs`` (the :func:`link_pairs` result) to reuse an already computed pair aggregate.
    """
    pairs = pairs if pairs is not None else link_pairs(df)
    return top_n_per_group(pairs, ["month"], ["total_clicks"], ["prev", "curr"], n).select(
        "month", "prev", "curr", "total_clicks"
    )


def out_degree_from_pairs(pairs: DataFrame) -> DataFrame:
    """Outbound clicks and exact distinct targets per (month, referrer) from the pair aggregate.

    Pairs are unique per (month, prev, curr), so counting non-NULL ``curr`` is an exact
    ``count(DISTINCT curr)`` without a second distinct-aggregation pass.
    """
    return pairs.groupBy("month", "prev").agg(
        F.sum("total_clicks").alias("total_clicks_sent"),
        F.count("curr").alias("unique_targets"),
    )


def out_degree(df: DataFrame) -> DataFrame:
    """Outbound internal-link clicks and distinct targets per (month, referrer)."""
    return out_degree_from_pairs(link_pairs(df))


def top_articles_by_outdegree(df: DataFrame, n: int = 50, pairs: DataFrame | None = None) -> DataFrame:
    """Top-n referrers per month by outbound internal clicks; ties broken by title.

    Pass ``pairs`` (the :func:`link_pairs` result) to reuse an already computed pair aggregate.
    """
    degree = out_degree_from_pairs(pairs if pairs is not None else link_pairs(df))
    return top_n_per_group(degree, ["month"], ["total_clicks_sent"], ["prev"], n).select(
        "month", "prev", "total_clicks_sent", "unique_targets"
    )


def monthly_trend(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Clicks per (month, target) for every target, ordered by (curr, month) when ``ordered``.

    A writer should take ``ordered=False``: a global sort before a month-partitioned write only
    adds a range shuffle that the writer's own clustering replaces.
    """
    out = df.groupBy("month", "curr").agg(F.sum("n").alias("monthly_clicks"))
    return out.orderBy("curr", "month") if ordered else out


def months_loaded(df: DataFrame) -> DataFrame:
    """Distinct months present, ascending."""
    return df.select("month").distinct().orderBy("month")


def month_picker(df: DataFrame) -> DataFrame:
    """Distinct non-NULL months, latest first (the serving layer's month choice)."""
    return df.select("month").dropna().distinct().orderBy(F.desc("month"))


def _first_of_month(col: str) -> F.Column:
    return F.try_to_date(F.concat(F.col(col), F.lit("-01")), "yyyy-MM-dd")


def month_coverage(
    df: DataFrame, expected_months: Iterable[str] = ()
) -> DataFrame:
    """Per month of the calendar span of ``df`` (plus ``expected_months``): rows loaded and a flag.

    Months outside the data come back with ``rows = 0, loaded = false``: the months a loader still
    has to fetch. The calendar is generated from a one-row min/max aggregate, so it is bounded by
    the number of months in the span, never by the data volume.
    """
    valid = df.filter(F.col("month").rlike(MONTH_PATTERN) & _first_of_month("month").isNotNull())
    counts = valid.groupBy("month").agg(F.count(F.lit(1)).alias("rows"))
    # One row holds every month's count (bounded by the calendar), so the input is scanned once.
    whole = counts.agg(
        F.min("month").alias("lo"),
        F.max("month").alias("hi"),
        F.map_from_entries(F.collect_list(F.struct("month", "rows"))).alias("counts"),
    )
    span = F.transform(
        F.sequence(_first_of_month("lo"), _first_of_month("hi"), F.expr("INTERVAL 1 MONTH")),
        lambda d: F.date_format(d, "yyyy-MM"),
    )
    expected = F.array(*[F.lit(m) for m in expected_months]).cast("array<string>")
    months = F.array_union(F.coalesce(span, F.array().cast("array<string>")), expected)
    rows = F.try_element_at("counts", F.col("month"))
    return whole.select("counts", F.explode(months).alias("month")).select(
        "month", F.coalesce(rows, F.lit(0)).cast("bigint").alias("rows"), rows.isNotNull().alias("loaded")
    )


def missing_months(df: DataFrame, expected_months: Iterable[str], spark: SparkSession | None = None) -> DataFrame:
    """Expected months with no rows in ``df`` (the loader's skip-if-present rule, inverted)."""
    spark = spark or df.sparkSession
    expected = spark.createDataFrame([(m,) for m in expected_months], "month string")
    loaded = df.select("month").distinct()
    return expected.join(loaded, "month", "left_anti")
