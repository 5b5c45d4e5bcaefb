"""Registered queries of the live and incremental layers; each has an oracle in ``live_oracle``."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navstream.operators import edits as E
from navstream.operators import quality as Q
from navstream.operators.heavy_hitters import top_editors_per_window
from navstream.operators.clickstream import link_pairs, monthly_trend
from navstream.operators.layout import clustered_both_ways
from navstream.operators.sketches import month_sketches, targets_over
from navstream.operators.threshold import trend_of_leaders_by_threshold
from navstream.plans.feeds import record_stream_in_slices
from navstream.plans.load_job import load_changed
from navstream.plans.upkeep_job import apply_delivery, read_kept
from navstream.schemas import MART_SCHEMAS
from navstream.session import ensure_utc, run_folder
from navstream.settings import StreamSettings
from navstream.sinks.streams import parquet_append
from navstream.sinks.tables import drop_partitions, write_partitioned
from navstream.sources import standins
from navstream.sources.lookup import INDEX_SCHEMA, file_index, lookup
from navstream.sources.tables import read_mart
from navstream.streaming.delivery import ROCKSDB, delivery_outcomes
from navstream.streaming.pipeline import silver_edits
from navstream.streaming.supervision import RestartPolicy, supervise
from navstream.streaming.upsert import merge_batch, read_upserted, upsert_mart

Query = Callable[[SparkSession, str], DataFrame]
STREAM = StreamSettings()
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of one query."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# ---------------------------------------------------------------------------------------------
# windows that are still open


def edits_update_mart(spark, sf_dir):
    """Hourly edit rate from the first event of a window on: the mart of the update-mode stream, open windows included."""
    root = run_folder(spark, "edits_update_mart")
    rate = E.edits_per_wiki(silver_edits(record_stream_in_slices(spark, sf_dir, "edits_update_mart"), STREAM), "1 hour")
    upsert_mart(rate, f"{root}/marts", "edits_per_wiki", f"{root}/checkpoint", ("window_start", "wiki"), available_now=True).awaitTermination()
    return _ntz(read_upserted(spark, f"{root}/marts", "edits_per_wiki", rate.schema), "window_start", "window_end")


class _Killed(RuntimeError):
    """A failure on purpose."""


#: Batches that fail once: before their merge, and after it but before the stream knows.
FAIL_BEFORE, FAIL_AFTER = 1, 3


def edits_supervised_mart(spark, sf_dir):
    """The same mart from a stream that fails twice and is started again: nothing is lost and nothing counts twice."""
    root = run_folder(spark, "edits_supervised_mart")
    rate = E.edits_per_wiki(silver_edits(record_stream_in_slices(spark, sf_dir, "edits_supervised_mart"), STREAM), "1 hour")
    failed: set[int] = set()

    def merge(changed: DataFrame, batch_id: int) -> None:
        fails = batch_id in (FAIL_BEFORE, FAIL_AFTER) and batch_id not in failed
        failed.add(batch_id)
        if fails and batch_id == FAIL_BEFORE:
            raise _Killed(f"before the merge of batch {batch_id}")
        merge_batch(changed, batch_id, f"{root}/marts", "edits_per_wiki", ("window_start", "wiki"), "window_start")
        if fails:
            raise _Killed(f"behind the merge of batch {batch_id}")

    def start():
        writer = rate.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", f"{root}/checkpoint")
        return writer.trigger(availableNow=True).start()

    if len(supervise(start, RestartPolicy(pause=0.0))) != 2:
        raise RuntimeError("the stream was to fail twice")
    return _ntz(read_upserted(spark, f"{root}/marts", "edits_per_wiki", rate.schema), "window_start", "window_end")


# ---------------------------------------------------------------------------------------------
# late and repeated deliveries

#: How long a delivered event is remembered, and may come late.
REMEMBERED = "1 day"


def edits_delivery_outcomes(spark, sf_dir):
    """Every delivered record with what became of it."""
    root = run_folder(spark, "edits_delivery_outcomes")
    events = E.valid_events(E.parse_edit_payloads(record_stream_in_slices(spark, sf_dir, "edits_delivery_outcomes", recent_seconds=86_400)))
    with _setting(spark, STATE_STORE, ROCKSDB):
        told = delivery_outcomes(events.select("event_key", "event_time", "wiki"), REMEMBERED)
        parquet_append(told, f"{root}/out", f"{root}/checkpoint", available_now=True).awaitTermination()
    return _ntz(spark.read.parquet(f"{root}/out"), "event_time")


# ---------------------------------------------------------------------------------------------
# first editors of every window


def _edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return standins.edits_from_events(standins.table(spark, sf_dir, "events"))


def top_editors_top15(spark, sf_dir):
    return _ntz(top_editors_per_window(_edits(spark, sf_dir), "5 minutes", "1 minute", 15), "window_start")


def top_editors_top15_daily(spark, sf_dir):
    """Windows wide enough that the cut bites, and summaries narrow enough that counters are lost."""
    return _ntz(top_editors_per_window(_edits(spark, sf_dir), "48 hours", "12 hours", 15, width=24), "window_start")


# ---------------------------------------------------------------------------------------------
# marts kept up by deltas, published together

#: Months delivered again: one with rows taken out and clicks changed, one without any row.
CORRECTED, EMPTIED = "1995-03", "1996-07"


def _delivered(spark: SparkSession, sf_dir: str, corrected: bool) -> DataFrame:
    ensure_utc(spark)
    edges = standins.clickstream_from_lineitem(standins.table(spark, sf_dir, "lineitem"), F.col("l_orderkey").alias("k"))
    if corrected:
        edges = edges.where((F.col("month") == CORRECTED) & (F.col("k") % 3 != 0))
        edges = edges.withColumn("n", F.col("n") + F.when(F.col("k") % 5 == 0, 1).otherwise(0))
    return Q.clean_rows(edges.drop("k"))


def _first_delivery(spark: SparkSession, sf_dir: str, name: str) -> str:
    root = f"{run_folder(spark, name)}/published"
    apply_delivery(spark, root, _delivered(spark, sf_dir, corrected=False))
    return root


def _stacked(spark: SparkSession, root: str, tables: tuple[str, ...]) -> DataFrame:
    """Published tables one below the other."""
    none = F.lit(None).cast("string")
    shapes = {
        "trend": ("month", none, "curr", "clicks", F.lit(None)),
        "pairs": ("month", "prev", "curr", "clicks", F.lit(None)),
        "out_degree": ("month", "prev", none, "clicks", "targets"),
        "totals": (none, none, "curr", "clicks", F.lit(None)),
        "top_articles_indegree": ("month", none, "curr", "total_clicks", F.lit(None)),
        "top_articles_outdegree": ("month", "prev", none, "total_clicks_sent", "unique_targets"),
        "top_link_pairs": ("month", "prev", "curr", "total_clicks", F.lit(None)),
    }
    out = None
    for table in tables:
        cols = [F.col(c) if isinstance(c, str) else c for c in shapes[table]]
        month, prev, curr, clicks, targets = cols
        part = read_kept(spark, root, table).select(
            F.lit(table).alias("mart"), month.alias("month"), prev.alias("prev"), curr.alias("curr"), clicks.alias("clicks"), targets.cast("long").alias("targets")
        )
        out = part if out is None else out.unionByName(part)
    return out


BOARDS = ("top_articles_indegree", "top_articles_outdegree", "top_link_pairs")


def upkeep_marts(spark, sf_dir):
    """Stored sums after two months were delivered again."""
    root = _first_delivery(spark, sf_dir, "upkeep_marts")
    apply_delivery(spark, root, _delivered(spark, sf_dir, corrected=True), (CORRECTED, EMPTIED))
    return _stacked(spark, root, ("trend", "pairs", "out_degree", "totals"))


def upkeep_boards(spark, sf_dir):
    """Boards after two months were delivered again."""
    root = _first_delivery(spark, sf_dir, "upkeep_boards")
    apply_delivery(spark, root, _delivered(spark, sf_dir, corrected=True), (CORRECTED, EMPTIED))
    return _stacked(spark, root, BOARDS)


def published_boards_after_crash(spark, sf_dir):
    """What readers see when the second delivery dies between two of its marts: all of the first one."""
    root = _first_delivery(spark, sf_dir, "published_boards_after_crash")

    def die(table: str) -> None:
        if table == "top_articles_outdegree":
            raise _Killed(table)

    try:
        apply_delivery(spark, root, _delivered(spark, sf_dir, corrected=True), (CORRECTED, EMPTIED), on_staged=die)
    except _Killed:
        pass
    return _stacked(spark, root, ("totals", *BOARDS))


def incremental_load(spark, sf_dir):
    """Marts loaded from gzip dumps by a ledger of files: all dumps, the same dumps (nothing is read), then one month's dump
    changed and one gone. What each run loaded, and the totals behind it."""
    root = run_folder(spark, "incremental_load")
    edges = _delivered(spark, sf_dir, corrected=False)
    corrected = _delivered(spark, sf_dir, corrected=True)
    line = F.concat_ws("\t", "prev", "curr", "type", F.col("n").cast("string")).alias("value")

    def dump(df: DataFrame, mode: str) -> None:
        files = df.select(line, F.col("month").alias("dump")).hint("rebalance", "dump")
        files.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("dump").text(f"{root}/raw")

    def load():
        return load_changed(spark, f"{root}/published", f"{root}/raw/dump=*/*.gz", r"dump=(\d{4}-\d{2})/")

    dump(edges, "overwrite")
    runs = [load(), load()]
    dump(corrected, "overwrite")  # dynamic: the corrected month alone
    drop_partitions(spark, f"{root}/raw", "dump", [EMPTIED])
    runs.append(load())
    loaded = [(f"run {k}", m, len(r.digested)) for k, r in enumerate(runs, 1) for m in r.months if k > 1] + [("run 2", None, len(runs[1].digested))]
    log = spark.createDataFrame(loaded, "mart string, month string, clicks long")
    none = F.lit(None).cast("string")
    totals = read_kept(spark, f"{root}/published", "totals").select(F.lit("totals").alias("mart"), none.alias("month"), "curr", "clicks")
    # the number of files depends on the writer: only whether any was read is compared
    log = log.select("mart", "month", none.alias("curr"), F.least("clicks", F.lit(1)).cast("long").alias("clicks"))
    return totals.unionByName(log)


# ---------------------------------------------------------------------------------------------
# leaders from a prefix of the trend; distinct targets over any months


def _written_trend(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    root = run_folder(spark, name)
    trend = monthly_trend(_delivered(spark, sf_dir, corrected=False), ordered=False)
    write_partitioned(trend, f"{root}/monthly_trend", sort_by=("monthly_clicks",), rebalance=True)
    return read_mart(spark, root, "monthly_trend").select(*MART_SCHEMAS["monthly_trend"].fieldNames())


def dash_trend_top10_threshold(spark, sf_dir):
    return trend_of_leaders_by_threshold(_written_trend(spark, sf_dir, "dash_trend_top10_threshold")).select("month", "curr", "monthly_clicks")


def targets_over_months(spark, sf_dir):
    """Distinct targets of every referrer over a set of months, from stored monthly sketches; held against the exact
    count, which the stated bound has to cover."""
    path = f"{run_folder(spark, 'targets_over_months')}/sketches"
    edges = _delivered(spark, sf_dir, corrected=False)
    write_partitioned(month_sketches(edges), path, rebalance=True)
    months = ("1994-01", "1994-02", "1994-03", "1995-03", "1996-07")
    kept = spark.read.schema("prev string, targets long, sketch binary, month string").parquet(path)
    return targets_over(kept, months, edges)


# ---------------------------------------------------------------------------------------------
# lookups

#: Titles looked up, among them one that no file has.
TITLES = ("17", "404", "no such title")
PAIR_SCHEMA = "month string, prev string, curr string, total_clicks long"


def title_lookup(spark, sf_dir):
    """Trend rows of a few titles, from the files that an index of titles names."""
    path = f"{run_folder(spark, 'title_lookup')}/monthly_trend"
    trend = monthly_trend(_delivered(spark, sf_dir, corrected=False), ordered=False)
    trend.repartitionByRange(32, "curr", "month").sortWithinPartitions("curr", "month").write.parquet(path)
    schema = "month string, curr string, monthly_clicks long"
    index = file_index(spark.read.schema(schema).parquet(path), "curr")
    index.write.parquet(f"{path}_index")
    return lookup(spark, path, schema, spark.read.schema(INDEX_SCHEMA).parquet(f"{path}_index"), "curr", TITLES)


def pair_lookup_both_ways(spark, sf_dir):
    """Links from one title and links to one title, from pairs laid out along a curve."""
    path = f"{run_folder(spark, 'pair_lookup_both_ways')}/link_pairs"
    clustered_both_ways(link_pairs(_delivered(spark, sf_dir, corrected=False)), 16).write.parquet(path)
    kept = spark.read.schema(PAIR_SCHEMA).parquet(path)
    return kept.where("prev = '7'").withColumn("asked", F.lit("from")).unionByName(kept.where("curr = '17'").withColumn("asked", F.lit("to")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        edits_update_mart, edits_supervised_mart, edits_delivery_outcomes, top_editors_top15, top_editors_top15_daily, upkeep_marts, upkeep_boards,
        published_boards_after_crash, incremental_load, dash_trend_top10_threshold, targets_over_months,
        title_lookup, pair_lookup_both_ways,
    )
}
