"""Upkeep of the marts from re-delivered months, published all at once.

``apply_delivery`` takes whole new deliveries of some months. It reads the stored rows of those months alone, turns
the difference into signed deltas and merges them into the stored sums of those months and into the totals over all
months. All tables of the run, boards included, become visible with one manifest: readers see the state before or after a
delivery, never a mixture, and a run that dies leaves the old state in place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navstream.operators import deltas as D
from navstream.operators.ranking import top_n_per_group
from navstream.schemas import CLICKSTREAM_WITH_MONTH_SCHEMA
from navstream.session import together
from navstream.sinks.published import Manifest, current_manifest, publish, read_published, stage

#: Folders of the totals over all months.
BUCKETS = 16


def _table(*columns: str, strings: tuple[str, ...] = ("prev", "curr", "month", "bucket")) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType() if c in strings else T.LongType()) for c in columns])


TABLES: dict[str, tuple[T.StructType, str]] = {
    "edges": (CLICKSTREAM_WITH_MONTH_SCHEMA, "month"),
    "trend": (_table("curr", "clicks", "rows", "month"), "month"),
    "pairs": (_table("prev", "curr", "clicks", "rows", "month"), "month"),
    "out_degree": (_table("prev", "clicks", "rows", "targets", "month"), "month"),
    "totals": (_table("curr", "clicks", "rows", "bucket"), "bucket"),
    "top_articles_indegree": (_table("curr", "total_clicks", "month"), "month"),
    "top_articles_outdegree": (_table("prev", "total_clicks_sent", "unique_targets", "month"), "month"),
    "top_link_pairs": (_table("prev", "curr", "total_clicks", "month"), "month"),
}
SORTED = {"edges": ("curr",), "trend": ("curr",), "pairs": ("prev", "curr"), "out_degree": ("prev",), "totals": ("curr",)}


def read_kept(spark: SparkSession, root: str, table: str, only: Sequence[str] | None = None, manifest: Manifest | None = None) -> DataFrame:
    """A table as published."""
    schema, partition = TABLES[table]
    return read_published(spark, root, table, schema, partition, only, manifest)


class _Run:
    """What one delivery has staged so far."""

    def __init__(self, spark: SparkSession, root: str, base: Manifest, months: Sequence[str], on_staged: Callable[[str], None] | None):
        self.spark, self.root, self.base, self.months, self.on_staged = spark, root.rstrip("/"), base, list(months), on_staged
        self.name, self.changes = str(base.version + 1), {}

    def stored(self, table: str) -> DataFrame:
        only = self.months if TABLES[table][1] == "month" else None
        return read_kept(self.spark, self.root, table, only, self.base)

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Stages a table's changed partitions and reads them back; partitions of the run left without rows go."""
        schema, partition = TABLES[table]
        made = stage(df.select(*schema.fieldNames()), self.root, table, self.name, partition, SORTED.get(table, ()))
        dropped = self.months if partition == "month" else self.base.partitions(table)
        self.changes[table] = {**dict.fromkeys(dropped), **made}
        if self.on_staged:
            self.on_staged(table)
        only = Manifest(0, {table: made})
        return read_published(self.spark, self.root, table, schema, partition, manifest=only)


def apply_delivery(
    spark: SparkSession, root: str, delivery: DataFrame, months: Sequence[str] | None = None, top_n: int = 50,
    on_staged: Callable[[str], None] | None = None, notes: Mapping[str, object] | None = None, base: Manifest | None = None,
) -> Manifest:
    """Replaces ``months`` by ``delivery`` (clean edges ``prev, curr, type, n, month`` of those months; a month without rows
    becomes empty) in all tables; without ``months``, those that the delivery has rows of. ``on_staged`` hears of every table written; ``notes`` commit with them. ``base`` is the manifest
    the delivery starts from, the newest by default. Raises ``PublishConflict`` if another delivery
    was published meanwhile: apply it again."""
    base = base or current_manifest(spark, root)
    run = _Run(spark, root, base, months or (), on_staged)
    new = run.write("edges", delivery if months is None else delivery.where(F.col("month").isin(list(months))))
    if months is None:
        run.months = sorted(run.changes["edges"])  # the folders written: no pass over the delivery to ask for its months
    old = run.stored("edges")
    changes = D.signed(new, old)

    def ranked(df: DataFrame, keys: list[str]) -> DataFrame:
        return top_n_per_group(df, ["month"], [D.CLICKS], keys, top_n)

    def trend_and_board() -> None:
        deltas = D.sum_deltas(changes, ["month", "curr"])
        trend = run.write("trend", D.merged(run.stored("trend"), deltas, ["month", "curr"]))
        board = ranked(trend, ["curr"]).withColumnRenamed(D.CLICKS, "total_clicks")
        together(spark, lambda: run.write("top_articles_indegree", board), lambda: totals(trend))

    def pairs_and_boards() -> None:
        pairs = run.write("pairs", D.merged(run.stored("pairs"), D.pair_deltas(changes), ["month", "prev", "curr"]))
        board = ranked(pairs, ["prev", "curr"]).withColumnRenamed(D.CLICKS, "total_clicks")
        together(spark, lambda: run.write("top_link_pairs", board), lambda: degrees_and_board(pairs))

    # Degrees and totals follow from the written pairs and trend, before and after: the edges are read once for each of the two.
    def degrees_and_board(pairs: DataFrame) -> None:
        deltas = D.target_deltas(run.stored("pairs"), after=pairs)
        degree = run.write("out_degree", D.merged(run.stored("out_degree"), deltas, ["month", "prev"], (D.CLICKS, D.ROWS, "targets")))
        named = ranked(degree, ["prev"]).withColumnsRenamed({D.CLICKS: "total_clicks_sent", "targets": "unique_targets"})
        run.write("top_articles_outdegree", named)

    def totals(trend: DataFrame) -> None:
        # one change an article, from the months' changes
        bucket = F.lpad(F.pmod(F.xxhash64("curr"), F.lit(BUCKETS)).cast("string"), 2, "0")
        run.write("totals", D.merged(run.stored("totals"), D.stored_deltas(trend, run.stored("trend"), ["curr"]), ["curr"]).withColumn("bucket", bucket))

    together(spark, trend_and_board, pairs_and_boards)
    return publish(spark, root, base, run.changes, notes)
