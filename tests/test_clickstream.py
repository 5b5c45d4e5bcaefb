"""Marts: sums, exact distinct targets, deterministic top-N with ties, trend, months."""

from __future__ import annotations

from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from navstream.operators import clickstream as C
from navstream.plans import catalog as K

SCHEMA = "prev string, curr string, type string, n bigint, month string"


def _edges(spark):
    data = [
        ("a", "x", "link", 5, "2024-10"),
        ("a", "x", "link", 5, "2024-10"),
        ("a", "y", "link", 3, "2024-10"),
        ("b", "x", "external", 7, "2024-10"),
        ("b", "y", "link", 13, "2024-10"),
        ("c", "z", "other", 13, "2024-10"),
        ("a", "x", "link", 1, "2024-11"),
        ("b", "z", "link", 1, "2024-11"),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_in_degree_counts_all_types(spark):
    got = rows(C.in_degree(_edges(spark)), "month", "curr", "total_clicks")
    assert got == [("2024-10", "x", 17), ("2024-10", "y", 16), ("2024-10", "z", 13), ("2024-11", "x", 1), ("2024-11", "z", 1)]


def test_top_indegree_ties_break_on_title(spark):
    got = rows(C.top_articles_by_indegree(_edges(spark), n=1), "month", "curr")
    assert got == [("2024-10", "x"), ("2024-11", "x")]  # 2024-11: x and z tie at 1 -> x


def test_out_degree_links_only_with_exact_distinct(spark):
    got = rows(C.out_degree(_edges(spark)), "month", "prev", "total_clicks_sent", "unique_targets")
    assert got == [("2024-10", "a", 13, 2), ("2024-10", "b", 13, 1), ("2024-11", "a", 1, 1), ("2024-11", "b", 1, 1)]


def test_out_degree_distinct_ignores_null_target(spark):
    df = spark.createDataFrame([("a", None, "link", 2, "m"), ("a", "x", "link", 1, "m")], SCHEMA)
    (r,) = C.out_degree(df).collect()
    assert (r["total_clicks_sent"], r["unique_targets"]) == (3, 1)


def test_top_outdegree_tie_break_and_reuse(spark):
    df = _edges(spark)
    top = rows(C.top_articles_by_outdegree(df, n=1), "month", "prev")
    assert top == [("2024-10", "a"), ("2024-11", "a")]
    reused = C.top_articles_by_outdegree(df, n=1, pairs=C.link_pairs(df))
    assert rows(reused) == rows(C.top_articles_by_outdegree(df, n=1))


def test_link_pairs_and_top_pairs(spark):
    df = _edges(spark)
    assert ("2024-10", "a", "x", 10) in rows(C.link_pairs(df), "month", "prev", "curr", "total_clicks")
    top = rows(C.top_link_pairs(df, n=2), "month", "prev", "curr", "total_clicks")
    assert top == [("2024-10", "a", "x", 10), ("2024-10", "b", "y", 13), ("2024-11", "a", "x", 1), ("2024-11", "b", "z", 1)]


def test_monthly_trend_is_unranked_and_ordered(spark):
    trend = C.monthly_trend(_edges(spark)).collect()
    assert [(r["curr"], r["month"]) for r in trend] == sorted((r["curr"], r["month"]) for r in trend)
    assert len(trend) == 5
    assert C.top_indegree_from_trend(C.monthly_trend(_edges(spark), ordered=False), 1).count() == 2


def test_months_and_picker(spark):
    df = _edges(spark).unionByName(spark.createDataFrame([("a", "b", "link", 1, None)], SCHEMA))
    assert [r["month"] for r in C.months_loaded(_edges(spark)).collect()] == ["2024-10", "2024-11"]
    assert [r["month"] for r in C.month_picker(df).collect()] == ["2024-11", "2024-10"]


def test_month_coverage_and_missing(spark):
    df = spark.createDataFrame(
        [("a", "b", "link", 1, "2024-10"), ("a", "b", "link", 1, "2024-12"), ("a", "b", "link", 1, "bad")], SCHEMA
    )
    cov = rows(C.month_coverage(df, ["2025-01"]), "month", "rows", "loaded")
    assert cov == [("2024-10", 1, True), ("2024-11", 0, False), ("2024-12", 1, True), ("2025-01", 0, False)]
    missing = rows(C.missing_months(df, ["2024-10", "2024-11"]), "month")
    assert missing == [("2024-11",)]


def test_properties_on_lineitem(spark):
    clean = K._clean(spark, SF_SMALL)
    total_n = clean.agg(F.sum("n")).first()[0]
    assert C.in_degree(clean).agg(F.sum("total_clicks")).first()[0] == total_n
    top = C.top_articles_by_indegree(clean, 5)
    assert top.groupBy("month").count().agg(F.max("count")).first()[0] <= 5


def test_top_n_plans_partial_group_limit(spark):
    plan = K.top_articles_indegree(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
