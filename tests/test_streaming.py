"""Streaming: windows emitted once when closed, replays removed, late rows dropped, restart resumes."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from helpers import rows
from navstream.operators import edits as E
from navstream.plans.stream_job import start_streaming
from navstream.settings import StreamSettings
from navstream.sources.bus import RECORD_SCHEMA, read_record_files_stream
from navstream.streaming.pipeline import StreamLayout, drain, silver_edits, start_marts


def _epoch(hh, mm, ss=0):
    return int(datetime(2024, 5, 1, hh, mm, ss, tzinfo=timezone.utc).timestamp())


def _rec(key, t, wiki="enwiki", user="u1", bot=False, kind="edit"):
    payload = {"wiki": wiki, "title": "P", "user": user, "type": kind, "bot": bot, "timestamp": t,
               "length": {"old": 1, "new": 3}, "revision": {"old": 0, "new": int(key[1:])}}
    return (key, json.dumps(payload))


BATCH_1 = [
    _rec("k1", _epoch(10, 0, 10)),
    _rec("k2", _epoch(10, 0, 50), bot=True),
    _rec("k3", _epoch(10, 1, 30), wiki="dewiki"),
    _rec("k1", _epoch(10, 0, 10)),  # replay inside the same batch
    _rec("k4", _epoch(10, 10, 0)),  # moves the watermark to 10:05
]
BATCH_2 = [
    _rec("k3", _epoch(10, 1, 30), wiki="dewiki"),  # replay older than the watermark: late, dropped
    _rec("k4", _epoch(10, 10, 0)),  # replay within the watermark: removed by dedup state
    _rec("k5", _epoch(10, 10, 20)),
    _rec("k7", _epoch(10, 2, 0), wiki="dewiki"),  # new but late: dropped
    _rec("k6", _epoch(10, 20, 0)),  # moves the watermark to 10:15
]


def _land(spark, folder, name, records):
    spark.createDataFrame(records, RECORD_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def _settings(workdir):
    return StreamSettings(output_dir=str(workdir / "out"), checkpoint_dir=str(workdir / "chk"))


def _rate(spark, workdir):
    df = spark.read.parquet(str(workdir / "out" / "edits_per_wiki_per_minute"))
    return rows(df.select(F.date_format("window_start", "HH:mm").alias("w"), "wiki", "edit_count", "bot_edits"))


def test_stream_windows_replays_late_rows_and_restart(spark, workdir):
    landing = workdir / "landing"
    _land(spark, landing, "b1", BATCH_1)
    settings = _settings(workdir)
    source = lambda: read_record_files_stream(spark, f"{landing}/*")
    drain(start_streaming(spark, settings, records=source(), available_now=True, silver_first=False, console=False))
    assert _rate(spark, workdir) == [("10:00", "enwiki", 2, 1), ("10:01", "dewiki", 1, 0)]

    _land(spark, landing, "b2", BATCH_2)
    queries = start_streaming(spark, settings, records=source(), available_now=True, silver_first=False, console=False)
    drain(queries)
    assert _rate(spark, workdir) == [("10:00", "enwiki", 2, 1), ("10:01", "dewiki", 1, 0), ("10:10", "enwiki", 2, 0)]
    dropped = sum(
        op.get("numRowsDroppedByWatermark", 0)
        for p in queries["edits_per_wiki_per_minute"].recentProgress
        for op in p["stateOperators"]
    )
    assert dropped >= 2

    types = spark.read.parquet(str(workdir / "out" / "edit_type_breakdown"))
    assert types.agg(F.sum("count")).first()[0] == 5  # k1, k2, k3, k4, k5 in closed windows
    editors = spark.read.parquet(str(workdir / "out" / "top_editors_sliding"))
    # humans only (k2 is a bot); each edit falls in 5 sliding windows, all closed except k4/k5's later ones
    assert editors.filter(F.col("user") == "u1").agg(F.sum("edit_count")).first()[0] > 0
    assert editors.filter(F.col("edit_count") <= 0).count() == 0


def test_silver_first_matches_direct(spark, workdir):
    landing = workdir / "landing"
    _land(spark, landing, "b1", BATCH_1 + BATCH_2)
    direct, staged = workdir / "direct", workdir / "staged"
    for target, silver_first in ((direct, False), (staged, True)):
        settings = _settings(target)
        records = read_record_files_stream(spark, f"{landing}/*")
        drain(start_streaming(spark, settings, records=records, available_now=True, silver_first=silver_first, console=False))
    assert _rate(spark, staged) == _rate(spark, direct)
    silver = spark.read.parquet(str(staged / "out" / "silver_edits"))
    assert silver.count() == len({k for k, _ in BATCH_1 + BATCH_2})


def test_console_monitor_and_stream_equals_batch(spark, workdir):
    landing = workdir / "landing"
    _land(spark, landing, "b1", BATCH_1)
    records = read_record_files_stream(spark, f"{landing}/*")
    layout = StreamLayout(str(workdir / "out"), str(workdir / "chk"))
    queries = start_marts(silver_edits(records), layout, StreamSettings(), available_now=True, console=True)
    assert "console" in queries
    drain(queries)
    batch = E.edits_per_wiki(E.drop_duplicate_events(E.parse_edit_records(spark.createDataFrame(BATCH_1, RECORD_SCHEMA))))
    closed = batch.filter(F.col("window_end") <= F.lit("2024-05-01 10:05:00").cast("timestamp"))
    got = spark.read.parquet(layout.output("edits_per_wiki_per_minute"))
    assert rows(got.select("window_start", "wiki", "edit_count", "bot_edits")) == rows(
        closed.select("window_start", "wiki", "edit_count", "bot_edits")
    )


def test_processing_time_queries_stop_together(spark, workdir):
    from navstream.streaming.pipeline import await_any

    landing = workdir / "landing"
    _land(spark, landing, "b1", BATCH_1)
    settings = StreamSettings(output_dir=str(workdir / "out"), checkpoint_dir=str(workdir / "chk"), trigger_seconds=1)
    queries = start_streaming(spark, settings, records=read_record_files_stream(spark, f"{landing}/*"), silver_first=False, console=False)
    assert all(q.isActive for q in queries.values())
    for q in queries.values():
        q.processAllAvailable()
    seen = sum(p["numInputRows"] for p in queries["edit_type_breakdown"].recentProgress)
    assert seen == len(BATCH_1)
    await_any(spark, queries, timeout=2)
    assert not any(q.isActive for q in queries.values())


from hypothesis import HealthCheck, given, settings as hsettings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

event = st.tuples(
    st.integers(1, 40),  # event id (repeats are replays of the same event)
    st.integers(0, 45 * 60),  # seconds after 10:00
    st.sampled_from(["enwiki", "dewiki", "frwiki"]),
    st.sampled_from(["u1", "u2", "u3"]),
    st.sampled_from([True, False, None]),
)


@hsettings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=40))
def test_property_stream_equals_batch_on_closed_windows(spark, workdir, events):
    # a replay is an exact copy: the first occurrence of an id defines the event
    first = {}
    for eid, sec, wiki, user, bot in events:
        first.setdefault(eid, (sec, wiki, user, bot))
    records = []
    for eid, _, _, _, _ in events:
        sec, wiki, user, bot = first[eid]
        payload = {"wiki": wiki, "title": "P", "user": user, "type": "edit", "timestamp": _epoch(10, 0) + sec,
                   "length": {"old": 5, "new": 5 + eid}, "revision": {"old": 0, "new": eid}}
        if bot is not None:
            payload["bot"] = bot
        records.append((f"k{eid}", json.dumps(payload)))
    run = workdir / f"run{len(list(workdir.iterdir()))}"
    _land(spark, run / "landing", "b1", records)
    settings = _settings(run)
    drain(start_streaming(spark, settings, records=read_record_files_stream(spark, f"{run}/landing/*"),
                          available_now=True, console=False))
    batch = E.edits_per_wiki(E.drop_duplicate_events(E.parse_edit_records(spark.createDataFrame(records, RECORD_SCHEMA))))
    watermark = datetime.fromtimestamp(_epoch(10, 0) + max(s for s, _, _, _ in first.values()) - 300, tz=timezone.utc)
    closed = batch.filter(F.col("window_end") <= F.lit(watermark.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))
    got = spark.read.parquet(str(run / "out" / "edits_per_wiki_per_minute"))
    cols = ("window_start", "wiki", "edit_count", "bot_edits", "avg_size_delta")
    assert rows(got.select(*cols)) == rows(closed.select(*cols))
