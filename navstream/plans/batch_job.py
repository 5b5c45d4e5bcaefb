"""The batch job: raw dumps -> contract -> checked silver table -> four monthly marts.

Data passes over the raw input once:

1. scan + contract flags -> ``clickstream_checked`` partitioned by (status, month); the write
   observes row and violation counts in the same pass (no separate count job);
2. quarantine = copy of ``status=quarantine`` folders of this run (rare rows);
3. ``monthly_trend`` = sum by (month, curr) over the clean folders of this run; the in-degree
   board is ranked from that written mart, not recomputed from silver;
4. link-pair sums are written once as the month-partitioned table ``link_pairs``; the pair board and the
   out-degree board (sum + exact distinct targets) are ranked from it.

Marts that do not feed each other are written at the same time. All writes replace only the months of this run (dynamic
overwrite), and partitions this run emptied (months without clean rows, months without links) are removed from every mart, so re-running a
month is idempotent.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from navstream.operators import clickstream as C
from navstream.operators.quality import ANY_VIOLATION, RAW_MONTH, REASON, month_key, with_contract_flags
from navstream.operators.ranking import top_k
from navstream.plans.quality_job import QUARANTINE_SORT
from navstream.schemas import CHECKED_SCHEMA, CLICKSTREAM_SCHEMA, MART_SCHEMAS
from navstream.session import build_session, together
from navstream.settings import BatchSettings
from navstream.sinks.tables import drop_partitions, preview, write_partitioned
from navstream.sources.clickstream import read_clickstream
from navstream.sources.tables import read_table

STATUS = "status"
CHECKED = "clickstream_checked"
LINK_PAIRS = "link_pairs"


@dataclass
class BatchReport:
    raw_rows: int = 0
    quarantined_rows: int = 0
    months: list[str] = field(default_factory=list)
    written: list[str] = field(default_factory=list)

    @property
    def clean_rows(self) -> int:
        return self.raw_rows - self.quarantined_rows


def _out(settings: BatchSettings, name: str) -> str:
    return f"{settings.output_dir.rstrip('/')}/{name}"


def write_checked(raw: DataFrame, path: str, by_month: bool = False) -> Observation:
    """Flags every row and writes clean and quarantined rows in one pass.

    The same pass observes the row counts and the sets of months seen with clean rows, with clean links and
    with quarantined rows. Values that are no month share the key '' (their text stays in ``raw_month``), so
    these sets and the folders are bounded by the month pattern, not by the data. ``by_month`` says that each
    scan task holds one month.
    """
    observation = Observation("contract")
    is_bad = F.col(STATUS) == "quarantine"
    month, is_link = F.col("month"), F.col("type") == "link"
    checked = with_contract_flags(raw).select(
        *CLICKSTREAM_SCHEMA.fieldNames(),
        REASON,
        F.col("month").alias(RAW_MONTH),
        F.when(F.col(ANY_VIOLATION), F.lit("quarantine")).otherwise(F.lit("clean")).alias(STATUS),
        month_key().alias("month"),
    )
    # No shuffle where a scan task holds one input file (one month) and writes into its own folders only; other
    # inputs are rebalanced by folder, before the observation, which an empty exchange would otherwise take away.
    if not by_month:
        checked = checked.hint("rebalance", STATUS, "month")
    checked = checked.observe(
        observation,
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(is_bad).alias("quarantined_rows"),
        F.collect_set(month).alias("months"),
        F.collect_set(F.when(~is_bad, month)).alias("clean_months"),
        F.collect_set(F.when(~is_bad & is_link, month)).alias("link_months"),
        F.collect_set(F.when(is_bad, month)).alias("bad_months"),
    )
    # The local sort clusters row groups by target title.
    write_partitioned(checked, path, partition_by=(STATUS, "month"), sort_by=("curr",), shuffle=False)
    return observation


def _month_filter(months: list[str]) -> F.Column:
    named = F.col("month").isin([m for m in months if m])
    # '' is written to the default partition and reads back as NULL.
    return (named | F.col("month").isNull()) if "" in months else named


def run_batch(spark: SparkSession, settings: BatchSettings = BatchSettings(), raw: DataFrame | None = None) -> BatchReport:
    by_month = raw is None and not settings.scan_partitions
    if raw is None:
        raw = read_clickstream(spark, settings.raw_glob, settings.month_from_path_pattern, settings.scan_partitions)
    report = BatchReport()
    checked_path = _out(settings, CHECKED)

    metrics = write_checked(raw, checked_path, by_month).get
    report.raw_rows, report.quarantined_rows = int(metrics["raw_rows"]), int(metrics["quarantined_rows"])
    months = sorted(metrics["months"])
    report.months = [m for m in months if m]
    no_clean = sorted(set(months) - set(metrics["clean_months"]))
    no_links = sorted(set(months) - set(metrics["link_months"]))
    no_bad = sorted(set(months) - set(metrics["bad_months"]))
    # A dynamic overwrite cannot empty a partition: remove folders this run left without rows.
    drop_partitions(spark, f"{checked_path}/{STATUS}=clean", "month", no_clean)
    drop_partitions(spark, f"{checked_path}/{STATUS}=quarantine", "month", no_bad)
    for mart in ("monthly_trend", "top_articles_indegree"):
        drop_partitions(spark, _out(settings, mart), "month", no_clean)
    for mart in (LINK_PAIRS, "top_link_pairs", "top_articles_outdegree"):
        drop_partitions(spark, _out(settings, mart), "month", no_links)
    report.written.append(checked_path)

    this_run = read_table(spark, checked_path, CHECKED_SCHEMA).filter(_month_filter(months))
    clean = this_run.filter(F.col(STATUS) == "clean").select(*CLICKSTREAM_SCHEMA.fieldNames(), "month")
    bad = this_run.filter(F.col(STATUS) == "quarantine").select(*CLICKSTREAM_SCHEMA.fieldNames(), REASON, RAW_MONTH, "month")

    trend_path, indegree_path = _out(settings, "monthly_trend"), _out(settings, "top_articles_indegree")
    links_path, pairs_path, outdegree_path = (_out(settings, m) for m in (LINK_PAIRS, "top_link_pairs", "top_articles_outdegree"))

    def quarantine() -> None:
        write_partitioned(bad, settings.quarantine_dir, sort_by=QUARANTINE_SORT, rebalance=True)
        drop_partitions(spark, settings.quarantine_dir, "month", no_bad)

    # Top-N marts hold at most n rows per month: AQE joins their folders into few tasks, and nothing is sampled.
    def trend_and_board() -> None:
        write_partitioned(C.monthly_trend(clean, ordered=False), trend_path, sort_by=("curr",), rebalance=True)
        trend = read_table(spark, trend_path, MART_SCHEMAS["monthly_trend"]).filter(_month_filter(months))
        write_partitioned(C.top_indegree_from_trend(trend, settings.top_n), indegree_path, sort_by=("curr",), rebalance=True)

    # The pair aggregate feeds two marts: it is written once, compressed and pruned by month, and a lost
    # executor costs a re-read of it, not the scan and the shuffle.
    def pairs_and_boards() -> None:
        write_partitioned(C.link_pairs(clean), links_path, sort_by=("prev", "curr"), rebalance=True)
        pairs = read_table(spark, links_path, MART_SCHEMAS[LINK_PAIRS]).filter(_month_filter(months))
        top_pairs = C.top_link_pairs(clean, settings.top_n, pairs=pairs)
        top_out = C.top_articles_by_outdegree(clean, settings.top_n, pairs=pairs)
        together(
            spark,
            lambda: write_partitioned(top_pairs, pairs_path, sort_by=("prev", "curr"), rebalance=True),
            lambda: write_partitioned(top_out, outdegree_path, sort_by=("prev",), rebalance=True),
        )

    together(spark, quarantine, trend_and_board, pairs_and_boards)
    report.written.append(settings.quarantine_dir)
    report.written += [trend_path, indegree_path, links_path, pairs_path, outdegree_path]
    return report


def show_latest(spark: SparkSession, settings: BatchSettings, month: str) -> None:
    """Top 10 of the latest month from the written marts, by clicks (not by file order)."""
    indegree = spark.read.parquet(_out(settings, "top_articles_indegree")).filter(F.col("month") == month)
    preview(top_k(indegree, ["total_clicks"], ["curr"], 10))
    pairs = spark.read.parquet(_out(settings, "top_link_pairs")).filter(F.col("month") == month)
    preview(top_k(pairs, ["total_clicks"], ["prev", "curr"], 10))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="navigation-dump batch job")
    parser.add_argument("--raw-glob", default=BatchSettings.raw_glob)
    parser.add_argument("--output-dir", default=BatchSettings.output_dir)
    parser.add_argument("--quarantine-dir", default=BatchSettings.quarantine_dir)
    parser.add_argument("--top-n", type=int, default=BatchSettings.top_n)
    parser.add_argument("--scan-partitions", type=int, default=None)
    args = parser.parse_args(argv)
    settings = BatchSettings(
        raw_glob=args.raw_glob,
        output_dir=args.output_dir,
        quarantine_dir=args.quarantine_dir,
        top_n=args.top_n,
        scan_partitions=args.scan_partitions,
    )
    spark = build_session("navstream-batch")
    report = run_batch(spark, settings)
    print(f"{report.clean_rows:,} clean rows, {report.quarantined_rows:,} quarantined, months: {', '.join(report.months)}")
    if report.months:
        show_latest(spark, settings, report.months[-1])


if __name__ == "__main__":
    main()
