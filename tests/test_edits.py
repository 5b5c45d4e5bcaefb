"""Edit-event parsing and windows (batch form): payload cases, message key, size delta, windows."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from navstream.functions.events import message_key, pair_label
from navstream.operators import edits as E
from navstream.plans import catalog as K
from navstream.sinks.bus import enrich, kafka_sink_options, to_bus_records
from navstream.sources.bus import kafka_source_options, read_topic_stream
from navstream.settings import KafkaSettings

T0 = 1_700_000_000  # 2023-11-14 22:13:20 UTC


def _event(**kw):
    base = {
        "wiki": "enwiki",
        "title": "Page",
        "user": "u1",
        "type": "edit",
        "bot": False,
        "timestamp": T0,
        "comment": "c",
        "length": {"old": 10, "new": 25},
        "revision": {"old": 1, "new": 2},
    }
    base.update(kw)
    return {k: v for k, v in base.items() if v is not ...}


def _records(spark, items):
    return spark.createDataFrame([(k, v) for k, v in items], "key string, value string")


def test_parse_payload_cases(spark):
    items = [
        ("enwiki:2", json.dumps(_event())),
        ("enwiki:3", json.dumps(_event(length={"new": 5}, revision={"old": 2, "new": 3}))),
        (None, json.dumps(_event(revision=..., title="NoRev"))),
        ("enwiki:5", json.dumps(_event(bot=..., revision={"old": 4, "new": 5}))),
        ("enwiki:6", json.dumps(_event(timestamp="abc"))),
        ("enwiki:7", json.dumps(_event(timestamp=1.5))),
        ("enwiki:8", "{broken json"),
        ("enwiki:9", "   "),
        ("enwiki:10", None),
    ]
    out = {r["event_key"]: r for r in E.parse_edit_records(_records(spark, items)).collect()}
    assert set(out) == {"enwiki:2", "enwiki:3", f"enwiki:{T0}:NoRev", "enwiki:5"}
    assert out["enwiki:2"]["size_delta"] == 15
    assert out["enwiki:2"]["event_time"] == datetime(2023, 11, 14, 22, 13, 20)
    assert out["enwiki:3"]["size_delta"] is None
    assert out["enwiki:5"]["bot"] is None
    assert E.human_edits(E.parse_edit_records(_records(spark, items))).count() == 3


def test_message_key_rules(spark):
    df = spark.createDataFrame(
        [
            ("enwiki", 42, 100, "T"),
            ("enwiki", 0, 100, "T"),
            ("", 42, 100, "T"),
            (None, None, None, None),
            ("dewiki", None, 7, None),
        ],
        "wiki string, rev long, ts long, title string",
    )
    got = [r[0] for r in df.select(message_key("wiki", "rev", "ts", "title")).collect()]
    assert got == ["enwiki:42", "enwiki:100:T", ":100:T", "::", "dewiki:7:"]


def test_size_delta_does_not_overflow(spark):
    payload = json.dumps(_event(length={"old": -2147483648, "new": 2147483647}))
    (r,) = E.parse_edit_records(_records(spark, [("k", payload)])).collect()
    assert r["size_delta"] == 4294967295


def test_wiki_filter_and_dedup_batch(spark):
    items = [("a", json.dumps(_event())), ("a", json.dumps(_event())), ("b", json.dumps(_event(wiki="dewiki")))]
    parsed = E.parse_edit_records(_records(spark, items))
    assert E.only_wiki(parsed, "dewiki").count() == 1
    assert E.only_wiki(parsed, None).count() == 3
    assert E.drop_duplicate_events(parsed).count() == 2


def test_bus_roundtrip_and_enrich(spark):
    edits = K._edits(spark, SF_SMALL).select("wiki", "title", "user", "type", "bot", F.lit(T0).alias("timestamp"))
    records = to_bus_records(enrich(edits))
    first = json.loads(records.first()["value"])
    assert first["_ingested_at"].endswith("+00:00") and "T" in first["_ingested_at"]
    back = E.parse_edit_records(records)
    assert back.count() == edits.count()


def test_option_builders():
    src = kafka_source_options(KafkaSettings())
    assert src == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "wiki-edits",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10000",
        "failOnDataLoss": "false",
    }
    sink = kafka_sink_options(KafkaSettings())
    assert sink["kafka.compression.type"] == "lz4" and sink["kafka.acks"] == "1" and sink["topic"] == "wiki-edits"
    assert sink["kafka.linger.ms"] == "10" and sink["kafka.batch.size"] == str(128 * 1024)


def test_kafka_source_needs_connector(spark):
    try:
        read_topic_stream(spark)
    except Exception as exc:  # connector jar is a deployment dependency
        assert "kafka" in str(exc).lower()


def test_windows_tumbling_and_sliding(spark):
    edits = K._edits(spark, SF_SMALL)
    n = edits.count()
    rate = E.edits_per_wiki(edits, "1 hour")
    assert rate.agg(F.sum("edit_count")).first()[0] == n
    assert rate.agg(F.sum("bot_edits")).first()[0] == edits.filter(F.col("bot")).count()
    sliding = E.top_editors_sliding(edits, "5 minutes", "1 minute")
    humans = E.human_edits(edits).count()
    assert sliding.agg(F.sum("edit_count")).first()[0] == 5 * humans
    types = E.edit_type_breakdown(edits, "1 minute")
    assert types.agg(F.sum("count")).first()[0] == n
    assert set(rate.columns) == {"window_start", "window_end", "wiki", "edit_count", "bot_edits", "avg_size_delta"}


def test_pair_label_null(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b")], "prev string, curr string")
    assert [r[0] for r in df.select(pair_label()).collect()] == ["a  →  b", None]


def test_publishable_filters_wiki_and_parses_back(spark):
    edits = K._edits(spark, SF_SMALL).select("wiki", "title", "user", "type", "bot", F.lit(T0).alias("timestamp"))
    records = __import__("navstream.sinks.bus", fromlist=["publishable"]).publishable(edits, "frwiki")
    back = E.parse_edit_records(records)
    assert back.count() == edits.filter(F.col("wiki") == "frwiki").count()
    assert {r["wiki"] for r in back.select("wiki").distinct().collect()} == {"frwiki"}


def test_timestamps_out_of_range_are_rejected_and_counted(spark):
    body = '{"wiki":"enwiki","title":"t","timestamp":%s}'
    rows = [("a", body % 9000000000000000000), ("b", body % (T0 * 1000)), ("c", body % T0), ("d", "{broken")]
    parsed = E.parse_edit_payloads(spark.createDataFrame(rows, "key string, value string"))
    assert [r["event_key"] for r in E.valid_events(parsed).collect()] == ["c"]
    assert tuple(E.rejected_events(parsed).first()) == (4, 3, 1, 2)


def test_blank_keys_fall_back_to_the_payload(spark):
    body = '{"wiki":"enwiki","title":"t","timestamp":%d,"revision":{"new":%d}}'
    rows = [("", body % (T0, 1)), ("", body % (T0, 2)), (None, body % (T0, 3)), (" ", body % (T0, 3))]
    silver = E.parse_edit_records(spark.createDataFrame(rows, "key string, value string"))
    kept = E.drop_duplicate_events(silver)
    assert sorted(r["event_key"] for r in kept.collect()) == ["enwiki:1", "enwiki:2", "enwiki:3"]


def test_batch_dedup_keeps_the_least_copy(spark):
    schema = "event_key string, event_time timestamp, v string"
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [("k", t, "b"), ("k", t, "a"), ("k", t + dt.timedelta(seconds=1), "0"), (None, t, "x"), (None, t, "x")]
    for order in (rows, rows[::-1]):
        got = E.drop_duplicate_events(spark.createDataFrame(order, schema)).collect()
        assert sorted((r["event_key"] or "", r["v"]) for r in got) == [("", "x"), ("k", "a")]
