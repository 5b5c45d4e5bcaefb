"""Tables published by manifest: all or nothing, conflicts, partial reads, clean-up; marts kept up by deltas."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from navstream.operators.deltas import merged, pair_deltas, signed, target_deltas
from navstream.plans.upkeep_job import TABLES, apply_delivery, read_kept
from navstream.sinks.published import Manifest, PublishConflict, current_manifest, publish, read_published, stage, vacuum
from navstream.sources.tables import read_table
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("v", T.LongType()), T.StructField("month", T.StringType())])
EDGES = "prev string, curr string, type string, n long, month string"


def _month(spark, values, month):
    return spark.createDataFrame([(v, month) for v in values], SCHEMA)


def test_publishing_replaces_named_partitions_only(spark, workdir):
    root = str(workdir)
    assert rows(read_published(spark, root, "t", SCHEMA, "month")) == []
    one = stage(_month(spark, [1, 2], "2024-01").unionByName(_month(spark, [3], "2024-02")), root, "t", "1", "month")
    assert rows(read_published(spark, root, "t", SCHEMA, "month")) == []  # staged is not published
    first = publish(spark, root, Manifest(), {"t": one}, {"note": 7})
    two = stage(_month(spark, [9], "2024-02"), root, "t", "2", "month")
    second = publish(spark, root, first, {"t": two})
    assert rows(read_published(spark, root, "t", SCHEMA, "month")) == [(1, "2024-01"), (2, "2024-01"), (9, "2024-02")]
    assert rows(read_published(spark, root, "t", SCHEMA, "month", manifest=first))[-1] == (3, "2024-02")
    assert second.notes == {"note": 7} and current_manifest(spark, root).version == 2
    publish(spark, root, second, {"t": {"2024-01": None}})
    assert rows(read_published(spark, root, "t", SCHEMA, "month")) == [(9, "2024-02")]


def test_of_two_publishers_one_starts_over(spark, workdir):
    root = str(workdir)
    base = current_manifest(spark, root)
    publish(spark, root, base, {"t": stage(_month(spark, [1], "a"), root, "t", "x", "month")})
    with pytest.raises(PublishConflict):
        publish(spark, root, base, {"t": stage(_month(spark, [2], "a"), root, "t", "y", "month")})
    assert rows(read_published(spark, root, "t", SCHEMA, "month")) == [(1, "a")]


def test_only_asked_partitions_are_read(spark, workdir):
    root = str(workdir)
    publish(spark, root, Manifest(), {"t": stage(_month(spark, [1], "a").unionByName(_month(spark, [2], "b")), root, "t", "1", "month")})
    files = read_published(spark, root, "t", SCHEMA, "month", only=["b"]).inputFiles()
    assert files and all("month=b" in f for f in files)


def test_vacuum_keeps_what_recent_manifests_name(spark, workdir):
    root, base = str(workdir), Manifest()
    for k in range(4):
        base = publish(spark, root, base, {"t": stage(_month(spark, [k], "a"), root, "t", str(k), "month")})
    stage(_month(spark, [99], "a"), root, "t", "dead", "month")
    assert sorted(vacuum(spark, root, keep=2)) == ["t/run=0", "t/run=1", "t/run=dead"]
    assert rows(read_published(spark, root, "t", SCHEMA, "month")) == [(3, "a")]


# ---------------------------------------------------------------------------------------------
# upkeep

FIRST = [
    ("a", "x", "link", 5, "2024-01"), ("a", "y", "link", 1, "2024-01"), ("a", "x", "external", 7, "2024-01"), ("b", "x", "link", 2, "2024-02"),
    ("b", None, "link", 2, "2024-02"), ("c", "z", "other", 3, "2024-03"), ("a", "x", "link", 4, "2024-03"),
]
AGAIN = [("a", "x", "link", 6, "2024-01"), ("a", "w", "link", 1, "2024-01"), ("a", "w", "link", 2, "2024-01")]


def _state(edges):
    """Sums by plain loops: trend, pairs, out-degrees, totals."""
    trend, pairs, totals, targets = {}, {}, {}, {}
    for prev, curr, kind, n, month in edges:
        for table, key in ((trend, (month, curr)), (totals, (curr,))):
            table[key] = table.get(key, 0) + n
        if kind == "link":
            pairs[month, prev, curr] = pairs.get((month, prev, curr), 0) + n
            sent, seen = targets.get((month, prev), (0, set()))
            targets[month, prev] = sent + n, seen | ({curr} - {None})
    flat = lambda d: sorted(((*k, v) for k, v in d.items()), key=repr)
    return flat(trend), flat(pairs), sorted(((*k, n, len(s)) for k, (n, s) in targets.items()), key=repr), flat(totals)


def _read(spark, root):
    return (
        rows(read_kept(spark, root, "trend"), "month", "curr", "clicks"), rows(read_kept(spark, root, "pairs"), "month", "prev", "curr", "clicks"),
        rows(read_kept(spark, root, "out_degree"), "month", "prev", "clicks", "targets"), rows(read_kept(spark, root, "totals"), "curr", "clicks"),
    )


def test_deltas_equal_a_rebuild_and_read_changed_months_only(spark, workdir):
    root = str(workdir)
    edges = lambda data: spark.createDataFrame(data, EDGES)
    apply_delivery(spark, root, edges(FIRST), ["2024-01", "2024-02", "2024-03"])
    assert _read(spark, root) == _state(FIRST)
    base = current_manifest(spark, root)
    # a month delivered anew, one without rows
    made = apply_delivery(spark, root, edges(AGAIN), ["2024-01", "2024-03"])
    assert _read(spark, root) == _state(AGAIN + [r for r in FIRST if r[4] == "2024-02"])
    for table, (_, partition) in TABLES.items():
        if partition == "month":
            assert "2024-03" not in made.tables[table]
            assert made.tables[table]["2024-02"] == base.tables[table]["2024-02"]  # not written again
    # the same delivery again changes nothing
    apply_delivery(spark, root, edges(AGAIN), ["2024-01", "2024-03"])
    assert _read(spark, root) == _state(AGAIN + [r for r in FIRST if r[4] == "2024-02"])


def test_a_run_killed_between_two_marts_leaves_the_old_state(spark, workdir):
    root = str(workdir)
    edges = lambda data: spark.createDataFrame(data, EDGES)
    apply_delivery(spark, root, edges(FIRST), ["2024-01", "2024-02", "2024-03"])
    for killed in ("edges", "pairs", "top_articles_indegree"):

        def die(table, at=killed):
            if table == at:
                raise KeyboardInterrupt

        with pytest.raises(KeyboardInterrupt):
            apply_delivery(spark, root, edges(AGAIN), ["2024-01"], on_staged=die)
        assert _read(spark, root) == _state(FIRST)
    apply_delivery(spark, root, edges(AGAIN), ["2024-01"])
    assert _read(spark, root) == _state(AGAIN + [r for r in FIRST if r[4] != "2024-01"])


def test_unchanged_groups_cancel_out(spark):
    edges = lambda data: spark.createDataFrame(data, EDGES)
    old, new = edges(FIRST), edges([*FIRST[1:], ("a", "x", "link", 9, "2024-01")])
    deltas = pair_deltas(signed(new, old))
    assert rows(deltas) == [("2024-01", "a", "x", 4, 0)]
    stored = edges(FIRST).where("type = 'link'").groupBy("month", "prev", "curr").agg(F.sum("n").alias("clicks"), F.count("*").alias("rows"))
    assert rows(target_deltas(stored, deltas)) == [("2024-01", "a", 4, 0, 0)]
    assert ("2024-01", "a", "x", 9, 1) in rows(merged(stored, deltas, ["month", "prev", "curr"]))


def test_missing_tables_read_as_empty(spark, workdir):
    assert rows(read_kept(spark, str(workdir / "none"), "trend")) == []
    assert read_table(spark, str(workdir / "none"), SCHEMA).columns == ["v", "month"]


def test_a_delivery_names_its_months_itself(spark, workdir):
    edges = lambda data: spark.createDataFrame(data, EDGES)
    named, unnamed = str(workdir / "named"), str(workdir / "unnamed")
    apply_delivery(spark, named, edges(FIRST), sorted({r[4] for r in FIRST}))
    apply_delivery(spark, unnamed, edges(FIRST))
    assert _read(spark, unnamed) == _read(spark, named) == _state(FIRST)
    apply_delivery(spark, unnamed, edges(AGAIN))
    assert _read(spark, unnamed) == _state(AGAIN + [r for r in FIRST if r[4] != "2024-01"])


def test_targets_from_written_pairs_equal_those_from_deltas(spark):
    rng = random.Random(3)
    some = lambda: [(rng.choice("abc"), rng.choice(["x", "y", "z", None]), "link", rng.randint(0, 3), rng.choice(["2024-01", "2024-02"])) for _ in range(30)]
    edges = lambda data: spark.createDataFrame(data, EDGES)
    pairs = lambda data: edges(data).groupBy("month", "prev", "curr").agg(F.sum("n").alias("clicks"), F.count("*").alias("rows"))
    old, new = some(), some()
    after = pairs(new)
    assert rows(target_deltas(pairs(old), after=after)) == rows(target_deltas(pairs(old), pair_deltas(signed(edges(new), edges(old)))))


def test_a_union_with_an_unpublished_table_costs_no_exchange(spark, workdir):
    sums = spark.range(100).withColumn("clicks", F.lit(1)).withColumn("rows", F.lit(1)).groupBy("id").agg(F.sum("clicks").alias("clicks"), F.sum("rows").alias("rows"))
    stored = read_published(spark, str(workdir), "none", T.StructType([T.StructField(c, T.LongType()) for c in ("id", "clicks", "rows")]), "id")
    plan = merged(stored, sums, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("Exchange") == sums._jdf.queryExecution().executedPlan().toString().count("Exchange")
