"""Serving queries: top-k boards, exclusions, leaders' trend, KPIs, latest window."""

from __future__ import annotations

from datetime import datetime

from helpers import rows
from navstream.operators import serving as S


def _indegree(spark):
    data = [
        ("2024-10", "Main_Page", 100),
        ("2024-10", "A", 5),
        ("2024-11", "Main_Page", 90),
        ("2024-11", "B", 7),
        ("2024-11", "A", 7),
        ("2024-11", None, 3),
        ("2024-11", "Hyphen-minus", 50),
    ]
    return spark.createDataFrame(data, "month string, curr string, total_clicks bigint")


def test_top_inbound_latest_excluded_null_kept(spark):
    got = [(r["curr"], r["total_clicks"]) for r in S.top_inbound(_indegree(spark), k=20).collect()]
    assert got == [("A", 7), ("B", 7), (None, 3)]
    assert [r["curr"] for r in S.top_inbound(_indegree(spark), month="2024-10", k=1).collect()] == ["A"]
    assert S.top_inbound(_indegree(spark), month="2024-10", excluded=()).first()["curr"] == "Main_Page"


def test_top_outbound_and_pairs(spark):
    out = spark.createDataFrame(
        [("2024-11", "x", 3, 1), ("2024-11", "y", 9, 2), ("2024-10", "z", 99, 1)],
        "month string, prev string, total_clicks_sent bigint, unique_targets bigint",
    )
    assert [r["prev"] for r in S.top_outbound(out, k=5).collect()] == ["y", "x"]
    pairs = spark.createDataFrame(
        [("2024-11", "x", "y", 3), ("2024-11", None, "z", 4)], "month string, prev string, curr string, total_clicks bigint"
    )
    got = [(r["link"], r["total_clicks"]) for r in S.top_pairs(pairs).collect()]
    assert got == [(None, 4), ("x  →  y", 3)]


def test_trend_of_leaders(spark):
    trend = spark.createDataFrame(
        [("2024-10", "A", 5), ("2024-11", "A", 5), ("2024-10", "B", 20), ("2024-10", "Main_Page", 99), ("2024-11", "C", 1)],
        "month string, curr string, monthly_clicks bigint",
    )
    got = [(r["month"], r["curr"]) for r in S.trend_of_leaders(trend, k=2).collect()]
    assert got == [("2024-10", "A"), ("2024-10", "B"), ("2024-11", "A")]
    assert rows(S.article_totals(trend), "curr", "total_clicks") == [("A", 10), ("B", 20), ("C", 1)]


def _rate(spark, data):
    return spark.createDataFrame(
        data,
        "window_start timestamp, window_end timestamp, wiki string, edit_count bigint, bot_edits bigint, avg_size_delta double",
    )


def test_kpis(spark):
    t1, t2 = datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 1)
    rate = _rate(spark, [(t1, t2, "enwiki", 8, 2, 1.0), (t2, t2, "dewiki", 2, 0, None)])
    (k,) = S.edit_kpis(rate).collect()
    assert (k["total_edits"], k["total_bots"], k["bot_pct"], k["latest_window"]) == (10, 2, 20.0, t2)
    (empty,) = S.edit_kpis(_rate(spark, [])).collect()
    assert (empty["total_edits"], empty["total_bots"], empty["bot_pct"], empty["latest_window"]) == (0, 0, 0.0, None)
    series = S.edit_rate_series(rate, "enwiki").collect()
    assert [(r["edit_count"], r["bot_edits"]) for r in series] == [(8, 2)]


def test_type_totals_and_latest_editors(spark):
    t1, t2 = datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 1)
    breakdown = spark.createDataFrame(
        [(t1, "edit", 3), (t2, "edit", 4), (t2, "new", 1)], "window_start timestamp, type string, count bigint"
    )
    assert rows(S.edit_type_totals(breakdown), "type", "count") == [("edit", 7), ("new", 1)]
    editors = spark.createDataFrame(
        [(t1, "u9", "enwiki", 50), (t2, "u2", "enwiki", 3), (t2, "u1", "dewiki", 3), (t2, "u3", "enwiki", 1)],
        "window_start timestamp, user string, wiki string, edit_count bigint",
    )
    got = [(r["user"], r["edit_count"]) for r in S.top_editors_latest_window(editors, k=2).collect()]
    assert got == [("u1", 3), ("u2", 3)]


def test_latest_month_chosen_before_exclusion(spark):
    df = spark.createDataFrame(
        [("2024-10", "A", 5), ("2024-11", "Main_Page", 90)], "month string, curr string, total_clicks bigint"
    )
    assert S.top_inbound(df).count() == 0  # the latest month holds only excluded articles
    assert [r["curr"] for r in S.top_inbound(df, excluded=()).collect()] == ["Main_Page"]
    mixed = df.unionByName(spark.createDataFrame([("2024-11", f"x{i}", i) for i in range(30)], df.schema))
    got = S.top_inbound(mixed, k=20).collect()
    assert len(got) == 20 and {r["month"] for r in got} == {"2024-11"}
    assert [r["total_clicks"] for r in got] == list(range(29, 9, -1))
