"""Physical-plan properties the design relies on at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from navstream.operators import edits as E
from navstream.operators.ranking import top_n_per_group
from navstream.plans.catalog import QUERIES, _edits
from navstream.sources import standins
from helpers import SF_SMALL
from navstream.operators import serving as S
from navstream.sinks.tables import write_partitioned
from navstream.sources.tables import read_mart

WRITING = {n for n in QUERIES if n.startswith(("job_", "rerun_", "serve_", "tsv_", "quarantine_step")) or "_stream" in n} | {"edits_per_wiki_stream", "edit_type_stream", "top_editors_stream", "edits_dedup_stream", "edits_per_wiki_stream_silver_first"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cross_joins_or_python(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert not [op for op in FORBIDDEN if op in plan]


@pytest.mark.parametrize("name", ["top_articles_indegree", "top_articles_outdegree", "top_link_pairs"])
def test_top_n_is_limited_before_the_month_shuffle(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_edit_scans_are_pruned(spark):
    plan = _plan(entry.queries()["edit_type_breakdown"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


def test_month_filter_prunes_mart_partitions(spark, workdir):
    mart = spark.createDataFrame(
        [(f"c{i}", i, f"2024-{10 + i % 3:02d}") for i in range(30)], "curr string, total_clicks bigint, month string"
    )
    write_partitioned(mart, str(workdir / "top_articles_indegree"), sort_by=("curr",))
    df = read_mart(spark, str(workdir), "top_articles_indegree")
    board = S.top_inbound(df, month="2024-11", k=5)
    plan = _plan(board)
    assert "PartitionFilters: [isnotnull(month" in plan and "(month#" in plan
    assert board.count() == 5


def test_broadcasts_are_bounded(spark):
    # the only broadcast sides: one-row maxima and the k-row leader set
    for name in ("dash_top_in", "dash_trend_top10", "top_editors_latest_window"):
        plan = _plan(entry.queries()[name](spark, SF_SMALL))
        for part in plan.split("BroadcastExchange")[1:]:
            head = part[:2000]
            assert ("max(" in head) or ("TakeOrderedAndProject(limit=" in head) or ("GlobalLimit" in head)


def test_sliding_window_expands_by_window_over_slide(spark):
    plan = _plan(entry.queries()["top_editors_sliding"](spark, SF_SMALL))
    assert "Expand" in plan
    human = E.human_edits(_edits(spark, SF_SMALL)).count()
    total = entry.queries()["top_editors_sliding"](spark, SF_SMALL).agg(F.sum("edit_count")).first()[0]
    assert total == 5 * human


@pytest.mark.parametrize("n", [50, 5000])
def test_top_n_ranks_a_group_in_buckets_whatever_n(spark, n):
    rows = spark.range(20_000).select(F.when(F.col("id") >= 0, "g").alias("g"), F.col("id").cast("string").alias("k"), (F.col("id") % 997).alias("v"))
    top = top_n_per_group(rows, ["g"], ["v"], ["k"], n)
    plan = _plan(top)
    assert plan.count("hashpartitioning(g#") == 2 and "_bucket" in plan
    want = sorted(((int(i) % 997, str(i)) for i in range(20_000)), key=lambda x: (-x[0], x[1]))[:n]
    assert sorted((r["v"], r["k"]) for r in top.collect()) == sorted(want)


@pytest.mark.parametrize("name", ["edit_silver", "edits_dedup_batch"])
def test_payload_is_parsed_once(spark, name):
    records = standins.edit_records_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    table = spark.createDataFrame(records.limit(50).collect(), records.schema)
    plan = _plan(E.parse_edit_records(table))
    assert plan.split("(1) ")[0].count("from_json") <= plan.count("from_json") and plan.count("Generate inline") + plan.count("Generate\n") >= 1
    formatted = table.transform(E.parse_edit_records)._jdf.queryExecution().optimizedPlan().toString()
    assert formatted.count("from_json") == 1


def test_month_coverage_scans_once(spark):
    assert _plan(entry.queries()["month_coverage"](spark, SF_SMALL)).count("FileScan parquet") == 1


def test_hot_keys_are_combined_before_every_shuffle(spark):
    """A key holding a third of all rows must reach each shuffle pre-aggregated (one row per task)."""
    from navstream.operators import clickstream as C

    n = 3000
    hot = [("hub", f"t{i % 50}", "link", 1, "2024-10") for i in range(n // 3)]
    rest = [(f"p{i}", f"t{i % 50}", "link", 1, "2024-10") for i in range(n - n // 3)]
    df = spark.createDataFrame(hot + rest, "prev string, curr string, type string, n bigint, month string")
    for out in (C.in_degree(df), C.out_degree(df), C.link_pairs(df), C.monthly_trend(df, ordered=False)):
        plan = _plan(out)
        for stage in plan.split("Exchange hashpartitioning")[1:]:
            # directly below every hash exchange sits a partial (map-side) aggregate
            assert "HashAggregate" in stage.split("\n", 3)[1] + stage.split("\n", 3)[2] and "partial_" in stage
    (row,) = C.out_degree(df).filter("prev = 'hub'").collect()
    assert (row["total_clicks_sent"], row["unique_targets"]) == (n // 3, 50)
    # whole rows with strings: a partial and a final sort aggregate, one row per key and task through the shuffle
    silver = E.parse_edit_records(standins.edit_records_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")))
    dedup_plan = _plan(E.drop_duplicate_events(silver))
    assert dedup_plan.count("SortAggregate") == 2 and "partial_min" in dedup_plan
