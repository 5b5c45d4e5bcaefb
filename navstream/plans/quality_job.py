"""Contract gate as a reusable job step: quarantine the bad rows, hand back the clean ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from navstream.operators.quality import ANY_VIOLATION, REASON, RAW_MONTH, month_key, quarantine_summary, split_by_contract
from navstream.sinks.tables import drop_partitions, write_partitioned
from navstream.sources.tables import read_quarantine

# Range key of the quarantine write: the titles split a month whose rows all fail the same rule
# over many tasks instead of one.
QUARANTINE_SORT = (REASON, "prev", "curr")


def validate_and_quarantine(spark: SparkSession, df: DataFrame, quarantine_path: str) -> tuple[DataFrame, int]:
    """Writes the rows that break the contract to ``quarantine_path`` (partitioned by month) and
    returns ``(clean rows, number quarantined)``.

    The write replaces only the months present in ``df``; a month of ``df`` without violations has
    its old quarantine partition removed, so a re-run never leaves stale rejects behind. The count
    and the month sets are observed during the write (no extra pass). Values that are no month share one partition
    and keep their text in ``raw_month``.
    """
    split = split_by_contract(df)
    observation = Observation("quarantine")
    month = F.col("month")
    observed = split.flagged.withColumns({RAW_MONTH: month, "month": month_key()}).observe(
        observation,
        F.count_if(F.col(ANY_VIOLATION)).alias("bad"),
        F.collect_set(month).alias("months"),
        F.collect_set(F.when(F.col(ANY_VIOLATION), month)).alias("bad_months"),
    )
    bad = observed.filter(F.col(ANY_VIOLATION)).select(*[c for c in df.columns if c != "month"], REASON, RAW_MONTH, "month")
    # No exchange: a range exchange would sample by re-running the scan of ``df`` (a second pass
    # over the raw input, double-counted metrics). Each task writes its own rejects, sorted.
    write_partitioned(bad, quarantine_path, sort_by=QUARANTINE_SORT, shuffle=False)
    metrics = observation.get
    drop_partitions(spark, quarantine_path, "month", sorted(set(metrics["months"]) - set(metrics["bad_months"])))
    return split.clean, int(metrics["bad"])


def quarantine_report(spark: SparkSession, quarantine_path: str, month: str | None = None) -> DataFrame:
    """Reason breakdown of the quarantine (empty when nothing was ever quarantined)."""
    return quarantine_summary(read_quarantine(spark, quarantine_path, month))
