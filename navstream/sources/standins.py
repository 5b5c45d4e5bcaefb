"""Views over the shared test tables that stand in for the application's inputs.

``lineitem`` plays the navigation dump (supplier -> part edges, one month per ship month) and
``events`` plays the edit feed. Faults are injected deterministically from key residues; every row
of the source table stays in the view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navstream.sinks.bus import to_bus_records


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _link_type() -> F.Column:
    flag = F.col("l_returnflag")
    return F.when(flag == "A", "link").when(flag == "N", "external").otherwise("other")


def _month_of_shipdate() -> F.Column:
    return F.substring(F.col("l_shipdate").cast("string"), 1, 7)


def clickstream_from_lineitem(lineitem: DataFrame, *carry: F.Column) -> DataFrame:
    """``prev, curr, type, n, month`` edges (and ``carry``): supplier -> part, flag -> link type, quantity -> clicks."""
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("prev"),
        F.col("l_partkey").cast("string").alias("curr"),
        _link_type().alias("type"),
        F.col("l_quantity").cast("bigint").alias("n"),
        _month_of_shipdate().alias("month"),
        *carry,
    )


def dirty_clickstream_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The same edges with every contract fault injected (NULL/blank titles, bad types/counts/months)."""
    k = F.col("l_orderkey")
    return lineitem.select(
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .when(k % 89 == 0, F.lit("  "))
        .otherwise(F.col("l_suppkey").cast("string"))
        .alias("prev"),
        F.when(k % 83 == 0, F.lit("")).otherwise(F.col("l_partkey").cast("string")).alias("curr"),
        F.when(k % 79 == 0, F.lit(None).cast("string"))
        .when(k % 73 == 0, F.lit("bogus"))
        .otherwise(_link_type())
        .alias("type"),
        F.when(k % 71 == 0, F.lit(None).cast("bigint"))
        .when(k % 67 == 0, F.lit(-1).cast("bigint"))
        .otherwise(F.col("l_quantity").cast("bigint"))
        .alias("n"),
        F.when(k % 61 == 0, F.lit("")).otherwise(_month_of_shipdate()).alias("month"),
    )


def edits_from_events(events: DataFrame, time_type: str = "timestamp_ntz", carry: tuple[str, ...] = ()) -> DataFrame:
    """Edit rows: wiki/title/user/type/bot/event_time/size_delta/rev_new, with NULL bots and deltas (and ``carry`` columns)."""
    uid, eid = F.col("user_id"), F.col("event_id")
    wiki = F.when(uid % 4 == 0, "dewiki").when(uid % 4 == 1, "frwiki").otherwise("enwiki")
    return events.select(
        "event_id",
        wiki.alias("wiki"),
        F.concat(F.lit("page_"), (uid % 50).cast("string")).alias("title"),
        uid.cast("string").alias("user"),
        F.col("event_type").alias("type"),
        F.when(eid % 11 == 0, F.lit(None).cast("boolean")).otherwise(eid % 7 == 0).alias("bot"),
        F.col("ts").cast(time_type).alias("event_time"),
        F.when(eid % 5 == 0, F.lit(None).cast("int"))
        .otherwise(F.floor("value").cast("int") - 50)
        .alias("size_delta"),
        F.when(eid % 13 == 0, F.lit(None).cast("bigint")).otherwise(eid).alias("rev_new"),
        F.col("props").alias("comment"),
        *[c for c in carry if c != "event_id"],
    )


def edit_payloads_from_events(events: DataFrame, *carry: str) -> DataFrame:
    """Edit events as the feed delivers them (after the ``carry`` columns).

    Derived columns: epoch-second timestamp, a ``length`` struct whose difference is the size delta
    (``old`` absent when the delta is unknown) and a ``revision`` struct (absent without a revision).
    """
    edits = edits_from_events(events, time_type="timestamp", carry=carry)
    base_len = (F.col("rev_new") % 1000 + 100).cast("int")
    payload = edits.select(
        *carry,
        "wiki",
        "title",
        "user",
        "type",
        "bot",
        F.unix_seconds("event_time").alias("timestamp"),
        "comment",
        F.struct(
            F.when(F.col("size_delta").isNotNull(), F.coalesce(base_len, F.lit(100))).alias("old"),
            (F.coalesce(base_len, F.lit(100)) + F.coalesce(F.col("size_delta"), F.lit(0))).alias("new"),
        ).alias("length"),
        F.when(
            F.col("rev_new").isNotNull(),
            F.struct((F.col("rev_new") - 1).alias("old"), F.col("rev_new").alias("new")),
        ).alias("revision"),
    )
    return payload


def edit_records_from_events(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``key, value`` records as the producer publishes them: keyed JSON edit events (after the ``carry`` columns)."""
    return to_bus_records(edit_payloads_from_events(events, *carry), carry=carry)


def dirty_edit_records_from_events(events: DataFrame) -> DataFrame:
    """The same records as binary, with every fault injected by residues of the event id: broken JSON, blank
    payloads, timestamps out of range and in milliseconds, missing and empty keys."""
    k = F.col("event_id")
    stamp = F.col("timestamp")
    payload = edit_payloads_from_events(events, "event_id")
    payload = payload.withColumn(
        "timestamp", F.when(k % 23 == 0, F.lit(9_000_000_000_000_000_000)).when(k % 29 == 0, stamp * 1000).otherwise(stamp)
    )
    records = to_bus_records(payload, carry=("event_id",))
    key = F.when(k % 31 == 0, F.lit(None)).when(k % 37 == 0, F.lit("")).otherwise(F.col("key"))
    value = F.when(k % 17 == 0, F.concat(F.lit("{broken "), F.col("value"))).when(k % 19 == 0, F.lit("  ")).otherwise(F.col("value"))
    return records.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"))
