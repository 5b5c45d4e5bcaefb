"""Structured Streaming layer: bus records -> silver edits (watermark, dedup) -> windowed marts.

The same transforms from :mod:`navstream.operators.edits` run here on streaming frames; only the
watermark, the deduplication state and the sinks are streaming-specific.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from navstream.operators import edits as E
from navstream.settings import StreamSettings
from navstream.sinks import streams


def silver_edits(records: DataFrame, settings: StreamSettings = StreamSettings()) -> DataFrame:
    """Parse, declare the watermark once (widest delay downstream), drop malformed and re-delivered events.

    The event-time filter sits above the watermark on purpose: Catalyst does not push a predicate
    on the event-time column through it, so the JSON payload is parsed once per record instead of
    being re-parsed inside a pushed-down filter.
    """
    parsed = E.only_wiki(E.parse_edit_payloads(records), settings.wiki_filter)
    watermarked = E.with_event_watermark(parsed, settings.watermark)
    valid = E.valid_events(watermarked)
    return E.drop_duplicate_events(valid)


def edit_marts(silver: DataFrame, settings: StreamSettings = StreamSettings()) -> dict[str, DataFrame]:
    """The three windowed marts over one silver stream."""
    return {
        "edits_per_wiki_per_minute": E.edits_per_wiki(silver, settings.rate_window),
        "top_editors_sliding": E.top_editors_sliding(silver, settings.editor_window, settings.editor_slide),
        "edit_type_breakdown": E.edit_type_breakdown(silver, settings.type_window),
    }


@dataclass
class StreamLayout:
    """Where each query writes its output and keeps its checkpoint (one checkpoint per query)."""

    output_dir: str
    checkpoint_dir: str

    def output(self, name: str) -> str:
        return f"{self.output_dir.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoint_dir.rstrip('/')}/{name}"


def start_marts(
    silver: DataFrame,
    layout: StreamLayout,
    settings: StreamSettings = StreamSettings(),
    available_now: bool = False,
    console: bool = True,
) -> dict[str, StreamingQuery]:
    """Starts one append-mode Parquet query per mart (plus a console monitor of the edit rate)."""
    trigger = None if available_now else settings.trigger_seconds
    queries = {
        name: streams.parquet_append(
            mart, layout.output(name), layout.checkpoint(name), trigger, available_now, query_name=None
        )
        for name, mart in edit_marts(silver, settings).items()
    }
    if console:
        queries["console"] = streams.console_update(
            E.edits_per_wiki(silver, settings.rate_window),
            layout.checkpoint("edits_per_wiki_per_minute_console"),
            settings.console_rows,
            trigger,
            available_now,
        )
    return queries


def start_silver_first(
    spark: SparkSession,
    records: DataFrame,
    layout: StreamLayout,
    settings: StreamSettings = StreamSettings(),
    available_now: bool = False,
    console: bool = False,
) -> dict[str, StreamingQuery]:
    """Dedups once into a silver Parquet stream, then feeds the marts from it.

    With one query per mart reading the bus directly, every query repeats parsing and keeps its own
    copy of the dedup state; here the state exists once and the marts read columnar silver files.
    With ``available_now`` the silver query is drained before the marts start.
    """
    trigger = None if available_now else settings.trigger_seconds
    silver = silver_edits(records, settings)
    silver_query = streams.parquet_append(
        silver, layout.output("silver_edits"), layout.checkpoint("silver_edits"), trigger, available_now
    )
    if available_now:
        silver_query.awaitTermination()
    silver_stream = spark.readStream.schema(silver.schema).parquet(layout.output("silver_edits"))
    watermarked = E.with_event_watermark(silver_stream, settings.watermark)
    queries = start_marts(watermarked, layout, settings, available_now, console)
    queries["silver_edits"] = silver_query
    return queries


def await_any(spark: SparkSession, queries: dict[str, StreamingQuery], timeout: float | None = None, poll: float = 0.2) -> None:
    """Blocks until any of these queries ends (or ``timeout``); on interrupt stops all of them gracefully.

    Only the given queries count: what other queries of the session came to, failures that were handled among them, is not
    theirs. A failure of one of them is raised once all are stopped.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        while all(q.isActive for q in queries.values()) and (deadline is None or time.monotonic() < deadline):
            time.sleep(poll)
        failed = [e for q in queries.values() if not q.isActive and (e := q.exception()) is not None]
    except KeyboardInterrupt:
        failed = []
    finally:
        for query in queries.values():
            if query.isActive:
                query.stop()
    if failed:
        raise RuntimeError(f"streaming query failed: {failed[0]}")


def drain(queries: dict[str, StreamingQuery]) -> None:
    """Waits for ``availableNow`` queries to finish; surfaces the first failure."""
    for query in queries.values():
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"streaming query failed: {query.exception()}")
