"""Open windows, delivery outcomes, first editors by summaries, leaders by threshold, distinct targets by sketches."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows
from navstream.operators import edits as E
from navstream.operators.heavy_hitters import summaries, top_editors_per_window
from navstream.operators.sketches import BOUND, month_sketches, targets_over, union_of_months
from navstream.operators.threshold import leaders_by_threshold, trend_of_leaders_by_threshold
from navstream.operators.serving import trend_of_leaders
from navstream.sinks.published import current_manifest
from navstream.streaming.delivery import ROCKSDB, delay_ms, delivery_outcomes
from navstream.streaming.upsert import merge_batch, read_upserted, upsert_mart

START = datetime(2024, 5, 1, 23, 0)
EVENTS = "event_key string, event_time timestamp, wiki string, bot boolean, size_delta long, _ingested_at string, extra struct<a: int>"


def _event(key, seconds, wiki="enwiki"):
    return (key, START + timedelta(seconds=seconds), wiki, False, 1, "now", (1,))


def _land(spark, folder, events):
    spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(str(folder))


def _stream(spark, folder):
    schema = spark.createDataFrame([], EVENTS).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def _rate(stream):
    return E.edits_per_wiki(stream.withWatermark("event_time", "5 minutes"), "30 minutes")


def _run(spark, workdir, stream):
    query = upsert_mart(_rate(stream), str(workdir / "marts"), "rate", str(workdir / "ck"), ("window_start", "wiki"), available_now=True)
    query.awaitTermination()


def test_open_windows_show_and_grow_over_restarts(spark, workdir):
    feed = [_event("a", 0), _event("b", 60), _event("c", 3000, "dewiki")], [_event("d", 3100, "dewiki"), _event("e", 9000)], [_event("f", 0), _event("g", 9001)]
    schema = _rate(spark.createDataFrame([], EVENTS)).schema
    late = {"f"}
    seen = []
    for part in feed:
        _land(spark, workdir / "in", part)
        _run(spark, workdir, _stream(spark, workdir / "in"))
        seen += [e for e in part if e[0] not in late]
        got = rows(read_upserted(spark, str(workdir / "marts"), "rate", schema), "window_start", "wiki", "edit_count")
        assert got == rows(_rate(spark.createDataFrame(seen, EVENTS)), "window_start", "wiki", "edit_count")


def test_a_replayed_batch_changes_nothing(spark, workdir):
    root = str(workdir / "marts")
    batch = lambda n: _rate(spark.createDataFrame([_event(str(k), 60 * k) for k in range(n)], EVENTS))
    read = lambda: rows(read_upserted(spark, root, "rate", batch(1).schema), "window_start", "edit_count")
    assert merge_batch(batch(3), 0, root, "rate", ("window_start", "wiki"), "window_start")
    assert merge_batch(batch(9), 1, root, "rate", ("window_start", "wiki"), "window_start")
    before, version = read(), current_manifest(spark, root).version
    for old in (0, 1):
        assert not merge_batch(batch(40), old, root, "rate", ("window_start", "wiki"), "window_start")
    assert read() == before and current_manifest(spark, root).version == version
    assert merge_batch(batch(0), 2, root, "rate", ("window_start", "wiki"), "window_start")  # a batch without rows commits as well
    assert read() == before and not merge_batch(batch(5), 2, root, "rate", ("window_start", "wiki"), "window_start")


def test_a_batch_that_died_before_its_commit_is_merged_anew(spark, workdir, monkeypatch):
    from navstream.streaming import upsert

    root, keys = str(workdir / "marts"), ("window_start", "wiki")
    batch = lambda n: _rate(spark.createDataFrame([_event(str(k), 60 * k) for k in range(n)], EVENTS))
    merge_batch(batch(2), 0, root, "rate", keys, "window_start")
    with monkeypatch.context() as m:
        m.setattr(upsert, "publish", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            merge_batch(batch(7), 1, root, "rate", keys, "window_start")
    assert rows(read_upserted(spark, root, "rate", batch(1).schema), "edit_count") == [(2,)]
    assert merge_batch(batch(7), 1, root, "rate", keys, "window_start")
    assert rows(read_upserted(spark, root, "rate", batch(1).schema), "edit_count") == [(7,)]


def test_every_delivery_has_an_outcome_and_state_empties(spark, workdir):
    feed = [
        [_event("a", 0), _event("a", 0), _event("b", 60), _event("z", 600)],  # watermark then 300 s
        [_event("a", 0), _event("z", 600), _event("c", 400), _event("d", 100)],
        [_event("c", 400), _event("e", 2000)],
        [_event("e", 2000), _event("f", 3000)],
        [_event("g", 9000)],
    ]
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        for part in feed:
            _land(spark, workdir / "in", part)
        out = delivery_outcomes(_stream(spark, workdir / "in"))
        query = (
            out.writeStream.format("parquet").option("path", str(workdir / "out")).option("checkpointLocation", str(workdir / "ck"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = spark.read.parquet(str(workdir / "out"))
    assert got.columns == [*spark.createDataFrame([], EVENTS).columns, "outcome"]
    counts = Counter((r["event_key"], r["outcome"]) for r in got.collect())
    assert sum(counts.values()) == sum(map(len, feed))
    assert counts == {
        ("a", "kept"): 1, ("a", "duplicate"): 1, ("a", "late"): 1, ("b", "kept"): 1, ("z", "kept"): 1, ("z", "duplicate"): 1, ("c", "kept"): 1,
        ("c", "duplicate"): 1, ("d", "late"): 1, ("e", "kept"): 1, ("e", "duplicate"): 1, ("f", "kept"): 1, ("g", "kept"): 1,
    }
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held) >= 3 and held[-1] <= 1
    assert delay_ms("5 minutes") == 300_000 and delay_ms("1 day") == 86_400_000


@pytest.mark.parametrize("frame", [2, 10_000])
def test_outcomes_of_many_keys_take_a_bounded_number_of_groups(spark, workdir, frame):
    rng = random.Random(7)
    feed = [[_event(rng.choice([*map(str, range(90)), None]), 400 * t + rng.randint(-500, 400), rng.choice("ab")) for _ in range(60)] for t in range(7)]
    known, watermark, latest, expected = {}, 0, 0, Counter()
    for part in feed:  # one state a key, forgotten at the end of the trigger whose watermark has passed it
        for key, at, wiki, *_ in part:
            ms = int(at.timestamp() * 1000)
            outcome = "late" if ms <= watermark else "duplicate" if key in known else "kept"
            if outcome == "kept":  # the first in order of time is kept
                ms = min(int(a.timestamp() * 1000) for k, a, *_ in part if k == key and int(a.timestamp() * 1000) > watermark)
                known[key] = ms + 300_000
            expected[key, outcome] += 1
        known = {k: until for k, until in known.items() if until > watermark}
        latest = max(latest, *(int(e[1].timestamp() * 1000) for e in part))
        watermark = latest - 300_000
        _land(spark, workdir / "in", part)
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.execution.arrow.maxRecordsPerBatch": str(frame)}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = delivery_outcomes(_stream(spark, workdir / "in"), buckets=3)
        query = (
            out.writeStream.format("parquet").option("path", str(workdir / "out")).option("checkpointLocation", str(workdir / "ck"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert Counter((r["event_key"], r["outcome"]) for r in spark.read.parquet(str(workdir / "out")).collect()) == expected
    assert min(expected[k] for k in expected) >= 1 and {o for _, o in expected} == {"kept", "duplicate", "late"}
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert 0 < max(held) <= 3 * 3  # values and timers of three buckets, not of ninety keys


def _editors(seed, n=3000, users=60):
    rng = random.Random(seed)
    weights = [1 / (k + 1) for k in range(users)]
    out = []
    for _ in range(n):
        user = rng.choices([*(f"u{k}" for k in range(users - 1)), None], weights)[0]
        out.append((START + timedelta(seconds=rng.randint(0, 3600)), user, rng.choice(["en", "de", None]), rng.choice([False, False, True, None])))
    return out


@pytest.mark.parametrize("width", [1, 3, 20, 256])
def test_first_editors_equal_the_exact_ranking(spark, width):
    data = _editors(1) + _editors(2, 200, 200)  # flat windows cannot be proven from few counters
    edits = spark.createDataFrame(data, "event_time timestamp, user string, wiki string, bot boolean").repartition(5)
    counts = Counter()
    for at, user, wiki, bot in data:
        if bot is False:
            pane = at.replace(second=0, microsecond=0)
            for k in range(5):
                counts[pane - timedelta(minutes=k), user, wiki] += 1
    last = lambda x: (x is None, x or "")
    want = []
    for window in {w for w, _, _ in counts}:
        here = sorted(((-n, last(u), last(w), u, w) for (s, u, w), n in counts.items() if s == window))
        want += [(window, u, w, -n) for n, _, _, u, w in here[:15]]
    got = top_editors_per_window(edits, "5 minutes", "1 minute", 15, width=width)
    assert rows(got) == sorted(want, key=repr)


def test_summaries_bound_what_they_lose(spark):
    rng = random.Random(5)
    data = [(START, rng.choice("abcdefghij") + str(int(rng.expovariate(0.3)))) for _ in range(4000)]
    true = Counter(k for _, k in data)
    keyed = spark.createDataFrame(data, "pane timestamp, key string").repartition(3)
    found = summaries(keyed, 8, held=5).collect()  # handed on after every batch
    error = sum(r["error"] for r in found)
    counters = Counter()
    for r in found:
        if r["key"] is not None:
            counters[r["key"]] += r["counter"]
    assert error <= len(data) / 9
    assert all(counters[k] <= n <= counters[k] + error for k, n in true.items())


TREND = "month string, curr string, monthly_clicks long"


@pytest.mark.parametrize("seed", range(4))
def test_leaders_by_threshold_equal_the_full_ranking(spark, seed):
    rng = random.Random(seed)
    data = [(f"2024-{m:02d}", rng.choice([None, "Main_Page", *(f"a{k}" for k in range(40))]), rng.choice([1, 2, 3, rng.randint(1, 10_000)])) for m in range(1, 9) for _ in range(60)]
    trend = spark.createDataFrame([*dict.fromkeys((m, c) for m, c, _ in data)], "month string, curr string")
    value = {(m, c): n for m, c, n in data}
    trend = spark.createDataFrame([(r["month"], r["curr"], value[r["month"], r["curr"]]) for r in trend.collect()], TREND)
    for k in (1, 5, 100):
        full = trend.where("curr IS NULL OR curr <> 'Main_Page'").groupBy("curr").agg(F.sum("monthly_clicks").alias("s"))
        want = [r["curr"] for r in full.orderBy(F.desc("s"), F.asc_nulls_last("curr")).limit(k).collect()]
        assert leaders_by_threshold(trend, k)[0] == want
    assert rows(trend_of_leaders_by_threshold(trend.where("curr IS NOT NULL"))) == rows(trend_of_leaders(trend.where("curr IS NOT NULL")), "month", "curr", "monthly_clicks")


def test_clear_leaders_are_proven_from_a_prefix(spark):
    data = [(f"2024-{m:02d}", f"big{k}", 10_000 + k) for m in range(1, 7) for k in range(10)] + [("2024-01", f"small{k}", 5) for k in range(500)]
    trend = spark.createDataFrame(data, TREND)
    names, least = leaders_by_threshold(trend, 10)
    assert set(names) == {f"big{k}" for k in range(10)} and least > 5
    assert leaders_by_threshold(trend.limit(0), 10) == ([], 0)


def test_sketches_estimate_any_set_of_months(spark):
    rng = random.Random(7)
    data = [(f"p{rng.randint(0, 3)}", f"c{rng.randint(0, 9000)}", "link", 1, f"2024-0{rng.randint(1, 6)}") for _ in range(30_000)]
    edges = spark.createDataFrame(data + [("p0", None, "link", 1, "2024-01"), ("p9", "c", "other", 1, "2024-01")], "prev string, curr string, type string, n long, month string")
    sketches = month_sketches(edges)
    exact = {(p, m): len({c for q, c, *_, n in data if q == p and n == m}) for p, m in {(p, m) for p, _, _, _, m in data}}
    assert {(r["prev"], r["month"]): r["targets"] for r in sketches.collect()} == exact
    for months in (("2024-01",), ("2024-02", "2024-05", "2024-06")):
        held = targets_over(sketches, months, edges).collect()
        assert len(held) == 4 and all(r["within"] for r in held)
        assert union_of_months(sketches, months).count() == 4
    assert BOUND < 0.09
