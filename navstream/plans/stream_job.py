"""The streaming job: edit topic -> silver edits -> three windowed marts (+ console monitor)."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from navstream.session import build_session
from navstream.settings import KafkaSettings, StreamSettings
from navstream.sources.bus import read_topic_stream
from navstream.streaming.pipeline import StreamLayout, await_any, silver_edits, start_marts, start_silver_first

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session_conf(settings: StreamSettings) -> dict[str, str]:
    """Session settings the streaming layer needs (state store provider)."""
    return {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER} if settings.rocksdb_state else {}


def start_streaming(
    spark: SparkSession,
    settings: StreamSettings = StreamSettings(),
    records: DataFrame | None = None,
    available_now: bool = False,
    silver_first: bool = True,
    console: bool = True,
) -> dict[str, StreamingQuery]:
    """Starts every query of the streaming layer and returns them by name.

    ``records`` defaults to the Kafka topic; any streaming frame of ``key, value`` works (files
    in tests and backfills).
    """
    records = records if records is not None else read_topic_stream(spark, settings.kafka)
    layout = StreamLayout(settings.output_dir, settings.checkpoint_dir)
    if silver_first:
        return start_silver_first(spark, records, layout, settings, available_now, console)
    return start_marts(silver_edits(records, settings), layout, settings, available_now, console)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="edit-stream job")
    parser.add_argument("--bootstrap-servers", default=KafkaSettings.bootstrap_servers)
    parser.add_argument("--topic", default=KafkaSettings.topic)
    parser.add_argument("--output-dir", default=StreamSettings.output_dir)
    parser.add_argument("--checkpoint-dir", default=StreamSettings.checkpoint_dir)
    parser.add_argument("--direct", action="store_true", help="every mart reads the topic itself (no silver stream)")
    parser.add_argument("--heap-state", action="store_true", help="keep streaming state in the JVM heap, not RocksDB")
    parser.add_argument("--wiki", default=StreamSettings.wiki_filter, help="keep one wiki (default: all)")
    parser.add_argument("--max-offsets-per-trigger", type=int, default=KafkaSettings.max_offsets_per_trigger)
    args = parser.parse_args(argv)
    settings = StreamSettings(
        output_dir=args.output_dir,
        checkpoint_dir=args.checkpoint_dir,
        rocksdb_state=not args.heap_state,
        wiki_filter=args.wiki,
        kafka=KafkaSettings(
            bootstrap_servers=args.bootstrap_servers, topic=args.topic, max_offsets_per_trigger=args.max_offsets_per_trigger
        ),
    )
    spark = build_session("navstream-streaming", extra=session_conf(settings))
    queries = start_streaming(spark, settings, silver_first=not args.direct)
    await_any(spark, queries)


if __name__ == "__main__":
    main()
