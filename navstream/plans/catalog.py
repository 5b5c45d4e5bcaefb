"""Registered queries over the shared test tables, each with an equivalent DuckDB SQL oracle.

Each query is ``(spark, sf_dir) -> DataFrame`` and runs over whole tables. ``lineitem`` stands in
for the navigation dump and ``events`` for the edit feed (see ``sources.standins``). Streaming
queries run their stream to completion (``availableNow``) into the shared checkpoint folder and
return the sink's table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navstream.functions.events import message_key
from navstream.operators import clickstream as C
from navstream.operators import edits as E
from navstream.operators import quality as Q
from navstream.operators import serving as S
from navstream.plans.quality_job import validate_and_quarantine
from navstream.session import ensure_utc, run_folder
from navstream.settings import BatchSettings, StreamSettings
from navstream.plans.batch_job import CHECKED, STATUS, run_batch
from navstream.plans.feeds import record_stream_in_slices
from navstream.sinks.bus import publishable
from navstream.sinks.streams import parquet_append
from navstream.sinks.tables import write_partitioned
from navstream.sources import standins
from navstream.sources.bus import RECORD_SCHEMA
from navstream.sources.clickstream import read_clickstream
from navstream.schemas import CHECKED_SCHEMA
from navstream.sources.tables import read_mart, read_quarantine, read_table
from navstream.streaming.pipeline import StreamLayout, drain, silver_edits, start_silver_first

Query = Callable[[SparkSession, str], DataFrame]
TOP_N = BatchSettings().top_n
STREAM = StreamSettings()


# ---------------------------------------------------------------------------------------------
# inputs


def _clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return standins.clickstream_from_lineitem(standins.table(spark, sf_dir, "lineitem"))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean side of the contract: what every mart is computed from."""
    return Q.clean_rows(_clickstream(spark, sf_dir))


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return standins.dirty_clickstream_from_lineitem(standins.table(spark, sf_dir, "lineitem"))


def _edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return standins.edits_from_events(standins.table(spark, sf_dir, "events"))


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps as wall-clock UTC (TIMESTAMP_NTZ), the type the SQL oracle returns."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# ---------------------------------------------------------------------------------------------
# batch marts


def top_articles_indegree(spark, sf_dir):
    return C.top_articles_by_indegree(_clean(spark, sf_dir), TOP_N)


def top_articles_outdegree(spark, sf_dir):
    return C.top_articles_by_outdegree(_clean(spark, sf_dir), TOP_N)


def top_link_pairs(spark, sf_dir):
    return C.top_link_pairs(_clean(spark, sf_dir), TOP_N)


def monthly_trend(spark, sf_dir):
    return C.monthly_trend(_clean(spark, sf_dir))


def months_loaded(spark, sf_dir):
    return C.months_loaded(_clean(spark, sf_dir))


def month_picker(spark, sf_dir):
    return C.month_picker(top_articles_indegree(spark, sf_dir))


def month_coverage(spark, sf_dir):
    return C.month_coverage(_clean(spark, sf_dir), BatchSettings().months)


def clickstream_row_count(spark, sf_dir):
    return _clean(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------------------------------------
# data contract


def dq_clean(spark, sf_dir):
    return Q.clean_rows(_dirty(spark, sf_dir))


def dq_quarantine(spark, sf_dir):
    return Q.quarantine_rows(_dirty(spark, sf_dir))


def dq_counts(spark, sf_dir):
    flagged = Q.with_contract_flags(_dirty(spark, sf_dir))
    return flagged.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~F.col(Q.ANY_VIOLATION)).alias("clean_rows"),
        F.count_if(F.col(Q.ANY_VIOLATION)).alias("quarantined_rows"),
    )


def dq_reason_counts(spark, sf_dir):
    return Q.reason_counts(dq_quarantine(spark, sf_dir))


def dq_summary(spark, sf_dir):
    return Q.quarantine_summary(dq_quarantine(spark, sf_dir))


# ---------------------------------------------------------------------------------------------
# serving over the batch marts


def dash_top_in(spark, sf_dir):
    return S.top_inbound(top_articles_indegree(spark, sf_dir))


def dash_top_out(spark, sf_dir):
    return S.top_outbound(top_articles_outdegree(spark, sf_dir))


def dash_top_pairs(spark, sf_dir):
    return S.top_pairs(top_link_pairs(spark, sf_dir))


def dash_trend_top10(spark, sf_dir):
    return S.trend_of_leaders(C.monthly_trend(_clean(spark, sf_dir), ordered=False))


# ---------------------------------------------------------------------------------------------
# edit events, batch form of the streaming transforms


def edits_per_wiki_per_minute(spark, sf_dir):
    return _ntz(E.edits_per_wiki(_edits(spark, sf_dir), "1 minute"), "window_start", "window_end")


def edits_per_wiki_per_hour(spark, sf_dir):
    return _ntz(E.edits_per_wiki(_edits(spark, sf_dir), "1 hour"), "window_start", "window_end")


def edit_type_breakdown(spark, sf_dir):
    return _ntz(E.edit_type_breakdown(_edits(spark, sf_dir), "1 minute"), "window_start")


def edit_type_breakdown_hourly(spark, sf_dir):
    return _ntz(E.edit_type_breakdown(_edits(spark, sf_dir), "1 hour"), "window_start")


def top_editors_sliding(spark, sf_dir):
    return _ntz(E.top_editors_sliding(_edits(spark, sf_dir), "5 minutes", "1 minute"), "window_start")


def top_editors_sliding_hourly(spark, sf_dir):
    return _ntz(E.top_editors_sliding(_edits(spark, sf_dir), "5 hours", "1 hour"), "window_start")


def edit_message_key(spark, sf_dir):
    edits = _edits(spark, sf_dir)
    epoch = F.unix_seconds(F.col("event_time").cast("timestamp"))
    return edits.select("event_id", message_key("wiki", "rev_new", epoch, "title").alias("event_key"))


def _silver_columns(df: DataFrame) -> DataFrame:
    out = df.select("event_key", "wiki", "title", "user", "type", "bot", "event_time", "size_delta", "comment")
    return _ntz(out, "event_time")


def edit_silver(spark, sf_dir):
    """Producer records (keyed JSON) parsed back into silver rows."""
    ensure_utc(spark)
    records = standins.edit_records_from_events(standins.table(spark, sf_dir, "events"))
    return _silver_columns(E.parse_edit_records(records))


def edits_dedup_batch(spark, sf_dir):
    """Every record delivered twice, then deduplicated on the event identity."""
    ensure_utc(spark)
    records = standins.edit_records_from_events(standins.table(spark, sf_dir, "events"))
    return _silver_columns(E.drop_duplicate_events(E.parse_edit_records(records.unionByName(records))))


def edit_kpis(spark, sf_dir):
    return _ntz(S.edit_kpis(E.edits_per_wiki(_edits(spark, sf_dir), "1 minute")), "latest_window")


def edit_type_totals(spark, sf_dir):
    return S.edit_type_totals(E.edit_type_breakdown(_edits(spark, sf_dir), "1 minute"))


def edit_rate_series(spark, sf_dir):
    return _ntz(S.edit_rate_series(E.edits_per_wiki(_edits(spark, sf_dir), "1 minute"), "enwiki"), "window_start")


def top_editors_latest_window(spark, sf_dir):
    editors = E.top_editors_sliding(_edits(spark, sf_dir), "5 minutes", "1 minute")
    return _ntz(S.top_editors_latest_window(editors, 15), "window_start")


# ---------------------------------------------------------------------------------------------
# edit events, streamed


def _event_record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream, published as keyed JSON records."""
    ensure_utc(spark)
    schema = standins.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events*.parquet")
    return standins.edit_records_from_events(events).select(*RECORD_SCHEMA.fieldNames())


def _run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Runs an append-mode stream to completion and returns what its Parquet sink committed."""
    root = run_folder(spark, name)
    query = parquet_append(stream, f"{root}/out", f"{root}/checkpoint", available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.parquet(f"{root}/out")


def edits_per_wiki_stream(spark, sf_dir):
    """Hourly edit rate, streamed: windows closed by the 5-minute watermark, each emitted once."""
    silver = silver_edits(_event_record_stream(spark, sf_dir), STREAM)
    out = _run_to_table(spark, E.edits_per_wiki(silver, "1 hour"), "edits_per_wiki_stream")
    return _ntz(out, "window_start", "window_end")


def edit_type_stream(spark, sf_dir):
    silver = silver_edits(_event_record_stream(spark, sf_dir), STREAM)
    out = _run_to_table(spark, E.edit_type_breakdown(silver, "1 minute"), "edit_type_stream")
    return _ntz(out, "window_start")


def top_editors_stream(spark, sf_dir):
    silver = silver_edits(_event_record_stream(spark, sf_dir), STREAM)
    out = _run_to_table(spark, E.top_editors_sliding(silver, "5 minutes", "1 minute"), "top_editors_stream")
    return _ntz(out, "window_start")


def edits_dedup_stream(spark, sf_dir):
    """Every record delivered twice (two subscriptions to the same feed), deduplicated in-stream."""
    records = _event_record_stream(spark, sf_dir)
    replayed = records.unionByName(_event_record_stream(spark, sf_dir))
    return _silver_columns(_run_to_table(spark, silver_edits(replayed, STREAM), "edits_dedup_stream"))


# ---------------------------------------------------------------------------------------------
# the batch job end to end (dirty dump -> checked table -> quarantine + marts), read back


def _job_layout(spark: SparkSession, name: str) -> BatchSettings:
    root = run_folder(spark, name)
    return BatchSettings(output_dir=f"{root}/marts", quarantine_dir=f"{root}/quarantine", top_n=TOP_N)


def batch_job_output(spark: SparkSession, sf_dir: str, name: str = "batch_job") -> BatchSettings:
    """Runs the batch job on the dirty stand-in into a fresh folder; returns its layout."""
    settings = _job_layout(spark, name)
    run_batch(spark, settings, raw=_dirty(spark, sf_dir))
    return settings


#: Months of the second run: all its rows break the contract / none of its rows is a link.
FAULTY_MONTH, LINKLESS_MONTH = "1995-03", "1996-07"


def _rerun_output(spark: SparkSession, sf_dir: str, name: str) -> BatchSettings:
    """The batch job twice over every row: the second delivery has one month of faulty rows only and one month
    without links, so the first run's marts of those months must go."""
    settings = _job_layout(spark, name)
    raw = _clickstream(spark, sf_dir)
    run_batch(spark, settings, raw=raw)
    faulty, linkless = F.col("month") == FAULTY_MONTH, F.col("month") == LINKLESS_MONTH
    again = raw.withColumns(
        {"n": F.when(faulty, -F.col("n")).otherwise(F.col("n")), "type": F.when(linkless, F.lit("external")).otherwise(F.col("type"))}
    )
    run_batch(spark, settings, raw=again)
    return settings


def rerun_monthly_trend(spark, sf_dir):
    layout = _rerun_output(spark, sf_dir, "rerun_monthly_trend")
    return read_mart(spark, layout.output_dir, "monthly_trend").select("month", "curr", "monthly_clicks")


def rerun_boards(spark, sf_dir):
    """The three boards after the re-run, one below the other."""
    layout = _rerun_output(spark, sf_dir, "rerun_boards")
    none = F.lit(None).cast("string")
    read = lambda mart: read_mart(spark, layout.output_dir, mart)
    return (
        read("top_articles_indegree").select(F.lit("in").alias("board"), "month", none.alias("prev"), "curr", F.col("total_clicks").alias("clicks"))
        .unionByName(read("top_articles_outdegree").select(F.lit("out").alias("board"), "month", "prev", none.alias("curr"), F.col("total_clicks_sent").alias("clicks")))
        .unionByName(read("top_link_pairs").select(F.lit("pair").alias("board"), "month", "prev", "curr", F.col("total_clicks").alias("clicks")))
    )


def quarantine_step(spark, sf_dir):
    """The contract gate as a job step: what it quarantined, read back ('' months read back as NULL)."""
    path = f"{run_folder(spark, 'quarantine_step')}/quarantine"
    validate_and_quarantine(spark, _dirty(spark, sf_dir), path)
    return read_quarantine(spark, path).select("month", "prev", "curr", "type", "n", "_reason")


# ---------------------------------------------------------------------------------------------
# serving over written marts


def _special(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean edges in which the two excluded titles are the most clicked targets."""
    k = F.col("curr").cast("bigint") % 50
    name = F.when(k == 0, "Main_Page").when(k == 1, "Hyphen-minus").otherwise(F.col("curr"))
    return _clean(spark, sf_dir).withColumn("curr", name)


def _written(spark: SparkSession, name: str, mart: str, df: DataFrame) -> DataFrame:
    """``df`` written as the named mart and read back as the serving layer reads it."""
    root = run_folder(spark, name)
    write_partitioned(df, f"{root}/{mart}", rebalance=True)
    return read_mart(spark, root, mart)


#: The explicit month of the boards.
BOARD_MONTH = "1995-03"


def _inbound(spark, sf_dir, name):
    return _written(spark, name, "top_articles_indegree", C.top_articles_by_indegree(_special(spark, sf_dir), TOP_N))


def serve_top_in(spark, sf_dir):
    return S.top_inbound(_inbound(spark, sf_dir, "serve_top_in")).select("month", "curr", "total_clicks")


def serve_top_in_month(spark, sf_dir):
    return S.top_inbound(_inbound(spark, sf_dir, "serve_top_in_month"), BOARD_MONTH).select("month", "curr", "total_clicks")


def serve_month_picker(spark, sf_dir):
    return C.month_picker(_inbound(spark, sf_dir, "serve_month_picker"))


def serve_top_out_month(spark, sf_dir):
    mart = _written(spark, "serve_top_out_month", "top_articles_outdegree", C.top_articles_by_outdegree(_special(spark, sf_dir), TOP_N))
    return S.top_outbound(mart, BOARD_MONTH).select("month", "prev", "total_clicks_sent", "unique_targets")


def serve_top_pairs_month(spark, sf_dir):
    mart = _written(spark, "serve_top_pairs_month", "top_link_pairs", C.top_link_pairs(_special(spark, sf_dir), TOP_N))
    return S.top_pairs(mart, BOARD_MONTH).select("month", "prev", "curr", "total_clicks", "link")


def serve_trend_top10(spark, sf_dir):
    mart = _written(spark, "serve_trend_top10", "monthly_trend", C.monthly_trend(_special(spark, sf_dir), ordered=False))
    return S.trend_of_leaders(mart).select("month", "curr", "monthly_clicks")


def serve_top_editors(spark, sf_dir):
    """Latest board over the written editor mart, in windows wide enough that the cut at 15 bites."""
    root = run_folder(spark, "serve_top_editors")
    editors = E.top_editors_sliding(_edits(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp")), "24 hours", "12 hours")
    editors.write.parquet(f"{root}/top_editors_sliding")
    return _ntz(S.top_editors_latest_window(read_mart(spark, root, "top_editors_sliding"), 15), "window_start")


# ---------------------------------------------------------------------------------------------
# the TSV scan


def _dumps(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The edges as gzip TSV dumps by month, read back by the scan: titles with quotes, rows without a count."""
    lineitem = standins.table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    view = standins.clickstream_from_lineitem(lineitem, k.alias("k"))
    prev = F.when(F.col("k") % 47 == 0, F.concat(F.lit('"'), "prev")).when(F.col("k") % 43 == 0, F.concat(F.lit('"'), "prev", F.lit('"'))).otherwise(F.col("prev"))
    line = F.when(F.col("k") % 53 == 0, F.concat_ws("\t", prev, "curr", "type")).otherwise(F.concat_ws("\t", prev, "curr", "type", F.col("n").cast("string")))
    root = run_folder(spark, name)
    lines = view.select(line.alias("value"), F.col("month").alias("dump")).hint("rebalance", "dump")
    lines.write.option("compression", "gzip").partitionBy("dump").text(f"{root}/raw")
    return read_clickstream(spark, f"{root}/raw/*/*.gz", r"dump=(\d{4}-\d{2})/")


def tsv_scan(spark, sf_dir):
    ensure_utc(spark)
    return _dumps(spark, sf_dir, "tsv_scan")


def tsv_missing_months(spark, sf_dir):
    """Months a loader would still have to fetch."""
    ensure_utc(spark)
    return C.missing_months(_dumps(spark, sf_dir, "tsv_missing_months"), (*BatchSettings().months, "1992-01", "1995-03"))


# ---------------------------------------------------------------------------------------------
# edits with faults, one wiki, and streams in several batches


def edit_silver_dirty(spark, sf_dir):
    """Records with every fault a feed can carry, parsed into silver rows."""
    ensure_utc(spark)
    return _silver_columns(E.parse_edit_records(standins.dirty_edit_records_from_events(standins.table(spark, sf_dir, "events"))))


def edits_only_wiki(spark, sf_dir):
    """One wiki published and parsed back."""
    ensure_utc(spark)
    payload = standins.edit_payloads_from_events(standins.table(spark, sf_dir, "events"))
    return _silver_columns(E.parse_edit_records(publishable(payload, wiki="enwiki")))


def edits_dedup_stream_slices(spark, sf_dir):
    records = record_stream_in_slices(spark, sf_dir, "edits_dedup_stream_slices")
    return _silver_columns(_run_to_table(spark, silver_edits(records, STREAM), "edits_dedup_stream_slices"))


def edits_per_wiki_stream_slices(spark, sf_dir):
    records = record_stream_in_slices(spark, sf_dir, "edits_per_wiki_stream_slices")
    out = _run_to_table(spark, E.edits_per_wiki(silver_edits(records, STREAM), "1 hour"), "edits_per_wiki_stream_slices")
    return _ntz(out, "window_start", "window_end")


def _job_mart(spark, sf_dir, name):
    return read_mart(spark, batch_job_output(spark, sf_dir, f"job_{name}").output_dir, name)


def job_top_articles_indegree(spark, sf_dir):
    return _job_mart(spark, sf_dir, "top_articles_indegree").select("month", "curr", "total_clicks")


def job_top_articles_outdegree(spark, sf_dir):
    return _job_mart(spark, sf_dir, "top_articles_outdegree").select(
        "month", "prev", "total_clicks_sent", "unique_targets"
    )


def job_top_link_pairs(spark, sf_dir):
    return _job_mart(spark, sf_dir, "top_link_pairs").select("month", "prev", "curr", "total_clicks")


def job_monthly_trend(spark, sf_dir):
    return _job_mart(spark, sf_dir, "monthly_trend").select("month", "curr", "monthly_clicks")


def job_quarantine_reasons(spark, sf_dir):
    """Rejects per month and reason as written ('' months read back as NULL)."""
    return Q.reason_counts(read_quarantine(spark, batch_job_output(spark, sf_dir, "job_quarantine").quarantine_dir))


def job_status_counts(spark, sf_dir):
    """Rows per status of the checked table (clean + quarantine = raw)."""
    checked = read_table(spark, f"{batch_job_output(spark, sf_dir, 'job_status').output_dir}/{CHECKED}", CHECKED_SCHEMA)
    return checked.groupBy(STATUS).agg(F.count(F.lit(1)).alias("rows"))


def edits_per_wiki_stream_silver_first(spark, sf_dir):
    """Hourly edit rate through the silver-first layout: one dedup stream, marts fed from silver."""
    ensure_utc(spark)
    root = run_folder(spark, "silver_first")
    layout = StreamLayout(f"{root}/out", f"{root}/checkpoint")
    settings = StreamSettings(rate_window="1 hour")
    drain(start_silver_first(spark, _event_record_stream(spark, sf_dir), layout, settings, available_now=True))
    out = spark.read.parquet(layout.output("edits_per_wiki_per_minute"))
    return _ntz(out, "window_start", "window_end")


QUERIES: dict[str, Query] = {
    "top_articles_indegree": top_articles_indegree,
    "top_articles_outdegree": top_articles_outdegree,
    "top_link_pairs": top_link_pairs,
    "monthly_trend": monthly_trend,
    "months_loaded": months_loaded,
    "month_picker": month_picker,
    "month_coverage": month_coverage,
    "clickstream_row_count": clickstream_row_count,
    "dq_clean": dq_clean,
    "dq_quarantine": dq_quarantine,
    "dq_counts": dq_counts,
    "dq_reason_counts": dq_reason_counts,
    "dq_summary": dq_summary,
    "dash_top_in": dash_top_in,
    "dash_top_out": dash_top_out,
    "dash_top_pairs": dash_top_pairs,
    "dash_trend_top10": dash_trend_top10,
    "edits_per_wiki_per_minute": edits_per_wiki_per_minute,
    "edits_per_wiki_per_hour": edits_per_wiki_per_hour,
    "edit_type_breakdown": edit_type_breakdown,
    "edit_type_breakdown_hourly": edit_type_breakdown_hourly,
    "top_editors_sliding": top_editors_sliding,
    "top_editors_sliding_hourly": top_editors_sliding_hourly,
    "edit_message_key": edit_message_key,
    "edit_silver": edit_silver,
    "edits_dedup_batch": edits_dedup_batch,
    "edit_kpis": edit_kpis,
    "edit_type_totals": edit_type_totals,
    "edit_rate_series": edit_rate_series,
    "top_editors_latest_window": top_editors_latest_window,
    "edits_per_wiki_stream": edits_per_wiki_stream,
    "edit_type_stream": edit_type_stream,
    "top_editors_stream": top_editors_stream,
    "edits_dedup_stream": edits_dedup_stream,
    "edits_per_wiki_stream_silver_first": edits_per_wiki_stream_silver_first,
    "job_top_articles_indegree": job_top_articles_indegree,
    "job_top_articles_outdegree": job_top_articles_outdegree,
    "job_top_link_pairs": job_top_link_pairs,
    "job_monthly_trend": job_monthly_trend,
    "job_quarantine_reasons": job_quarantine_reasons,
    "job_status_counts": job_status_counts,
    "rerun_monthly_trend": rerun_monthly_trend,
    "rerun_boards": rerun_boards,
    "quarantine_step": quarantine_step,
    "serve_top_in": serve_top_in,
    "serve_top_in_month": serve_top_in_month,
    "serve_month_picker": serve_month_picker,
    "serve_top_out_month": serve_top_out_month,
    "serve_top_pairs_month": serve_top_pairs_month,
    "serve_trend_top10": serve_trend_top10,
    "serve_top_editors": serve_top_editors,
    "tsv_scan": tsv_scan,
    "tsv_missing_months": tsv_missing_months,
    "edit_silver_dirty": edit_silver_dirty,
    "edits_only_wiki": edits_only_wiki,
    "edits_dedup_stream_slices": edits_dedup_stream_slices,
    "edits_per_wiki_stream_slices": edits_per_wiki_stream_slices,
}
