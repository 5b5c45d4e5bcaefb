"""Data contract: one test per rule, the NULL-flag decision (no row lost), split, summary."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from navstream.operators import quality as Q
from navstream.schemas import CLICKSTREAM_WITH_MONTH_SCHEMA

# (prev, curr, type, n, month) -> expected reason ('' = clean)
CASES = [
    (("A", "B", "link", 5, "2024-10"), ""),
    (('"Heroes"', "B", "link", 7, "2024-10"), ""),
    (('"Open_quote', "C", "link", 3, "2024-10"), ""),
    ((None, "B", "link", 2, "2024-10"), "null_prev"),
    ((" ", "C", "other", 9, "2024-10"), "null_prev"),
    (("A", "", "link", 2, "2024-10"), "null_curr"),
    (("A", "B", None, 4, "2024-10"), "bad_type"),
    (("A", "B", "bogus", 1, "2024-10"), "bad_type"),
    (("A", "B", "link", -1, "2024-10"), "neg_n"),
    (("A", "B", "link", 0, "2024-10"), "neg_n"),
    (("A", "B", "link", None, "2024-10"), "neg_n"),
    ((None, None, "bogus", 0, "2024-10"), "null_prev|null_curr|bad_type|neg_n"),
    (("A", "B", "link", 1, ""), "bad_month"),
    (("A", "B", "link", 1, None), "bad_month"),
    (("A", "B", "link", 1, "2024-1"), "bad_month"),
    (("A", "B", "link", 1, "2024-99"), ""),  # shape rule only, as in the original contract
    (("  ", "", None, None, "x"), "null_prev|null_curr|bad_type|neg_n|bad_month"),
]


def _df(spark, records):
    return spark.createDataFrame([r for r in records], CLICKSTREAM_WITH_MONTH_SCHEMA)


def test_each_rule_and_reason_order(spark):
    df = Q.with_contract_flags(_df(spark, [c for c, _ in CASES]))
    got = [r[Q.REASON] for r in df.collect()]
    assert got == [reason for _, reason in CASES]


def test_null_flags_never_lose_rows(spark):
    split = Q.split_by_contract(_df(spark, [c for c, _ in CASES]))
    clean, bad = split.clean.count(), split.quarantine.count()
    assert clean + bad == len(CASES)
    assert clean == sum(1 for _, r in CASES if r == "")


def test_split_columns(spark):
    split = Q.split_by_contract(_df(spark, [c for c, _ in CASES]))
    assert split.clean.columns == ["prev", "curr", "type", "n", "month"]
    assert split.quarantine.columns == ["prev", "curr", "type", "n", "month", "_reason"]
    assert split.quarantine.filter(F.col("_reason") == "").count() == 0


def test_summary_is_whole_and_ordered(spark):
    q = Q.quarantine_rows(_df(spark, [c for c, _ in CASES]))
    summary = Q.quarantine_summary(q).collect()
    assert len(summary) == q.select("month", "_reason").distinct().count()
    keys = [(r["month"] or "", -r["count"], r["_reason"]) for r in summary]
    assert keys == sorted(keys)
    assert summary[0]["month"] is None or summary[0]["month"] <= summary[-1]["month"]
    one_month = Q.quarantine_summary(q, month="2024-10").collect()
    assert {r["month"] for r in one_month} == {"2024-10"}
    counts = [r["count"] for r in one_month]
    assert counts == sorted(counts, reverse=True)


cell = st.one_of(st.none(), st.sampled_from(["", " ", "A", '"q', "link", "2024-10"]))
row = st.tuples(
    cell,
    cell,
    st.one_of(st.none(), st.sampled_from(["link", "external", "other", "bogus", ""])),
    st.one_of(st.none(), st.integers(-3, 3)),
    st.one_of(st.none(), st.sampled_from(["2024-10", "", "2024-1", "abcd-ef", "1999-12"])),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=30))
def test_property_clean_plus_bad_is_raw(spark, records):
    split = Q.split_by_contract(_df(spark, records))
    assert split.clean.count() + split.quarantine.count() == len(records)
