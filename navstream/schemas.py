"""Declared schemas of every input and output table."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types below are fixed values: they are set by the input and output formats.

# Header-less, tab-separated navigation dump: one row per (referrer, target, link type) in a month.
# File sources relax nullability, so the contract in operators.quality is what enforces it.
CLICKSTREAM_SCHEMA = T.StructType(
    [
        T.StructField("prev", T.StringType(), True),
        T.StructField("curr", T.StringType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("n", T.LongType(), True),
    ]
)

CLICKSTREAM_WITH_MONTH_SCHEMA = T.StructType(
    CLICKSTREAM_SCHEMA.fields + [T.StructField("month", T.StringType(), True)]
)

QUARANTINE_SCHEMA = T.StructType(
    CLICKSTREAM_SCHEMA.fields
    + [
        T.StructField("_reason", T.StringType(), True),
        T.StructField("raw_month", T.StringType(), True),
        T.StructField("month", T.StringType(), True),
    ]
)

# Every raw row after the contract, partitioned by (status, month).
CHECKED_SCHEMA = T.StructType(
    CLICKSTREAM_SCHEMA.fields
    + [
        T.StructField("_reason", T.StringType(), True),
        T.StructField("raw_month", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("month", T.StringType(), True),
    ]
)

# JSON payload of one edit event on the topic.
EDIT_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("wiki", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("user", T.StringType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("bot", T.BooleanType(), True),
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("comment", T.StringType(), True),
        T.StructField(
            "length",
            T.StructType(
                [T.StructField("old", T.IntegerType(), True), T.StructField("new", T.IntegerType(), True)]
            ),
            True,
        ),
        T.StructField(
            "revision",
            T.StructType(
                [T.StructField("old", T.LongType(), True), T.StructField("new", T.LongType(), True)]
            ),
            True,
        ),
        T.StructField("_ingested_at", T.StringType(), True),
    ]
)

# Output marts (partition column last, as a partitioned read returns it).
MART_SCHEMAS: dict[str, T.StructType] = {
    "top_articles_indegree": T.StructType(
        [
            T.StructField("curr", T.StringType(), True),
            T.StructField("total_clicks", T.LongType(), True),
            T.StructField("month", T.StringType(), True),
        ]
    ),
    "top_articles_outdegree": T.StructType(
        [
            T.StructField("prev", T.StringType(), True),
            T.StructField("total_clicks_sent", T.LongType(), True),
            T.StructField("unique_targets", T.LongType(), True),
            T.StructField("month", T.StringType(), True),
        ]
    ),
    "top_link_pairs": T.StructType(
        [
            T.StructField("prev", T.StringType(), True),
            T.StructField("curr", T.StringType(), True),
            T.StructField("total_clicks", T.LongType(), True),
            T.StructField("month", T.StringType(), True),
        ]
    ),
    "monthly_trend": T.StructType(
        [
            T.StructField("curr", T.StringType(), True),
            T.StructField("monthly_clicks", T.LongType(), True),
            T.StructField("month", T.StringType(), True),
        ]
    ),
    "edits_per_wiki_per_minute": T.StructType(
        [
            T.StructField("window_start", T.TimestampType(), True),
            T.StructField("window_end", T.TimestampType(), True),
            T.StructField("wiki", T.StringType(), True),
            T.StructField("edit_count", T.LongType(), True),
            T.StructField("bot_edits", T.LongType(), True),
            T.StructField("avg_size_delta", T.DoubleType(), True),
        ]
    ),
    "edit_type_breakdown": T.StructType(
        [
            T.StructField("window_start", T.TimestampType(), True),
            T.StructField("type", T.StringType(), True),
            T.StructField("count", T.LongType(), True),
        ]
    ),
    "top_editors_sliding": T.StructType(
        [
            T.StructField("window_start", T.TimestampType(), True),
            T.StructField("user", T.StringType(), True),
            T.StructField("wiki", T.StringType(), True),
            T.StructField("edit_count", T.LongType(), True),
        ]
    ),
}
MART_SCHEMAS["quarantine"] = QUARANTINE_SCHEMA
# Link-pair sums of every month: the boards over pairs and referrers are ranked from it.
MART_SCHEMAS["link_pairs"] = MART_SCHEMAS["top_link_pairs"]
