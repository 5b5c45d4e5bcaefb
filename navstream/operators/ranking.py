"""Deterministic ranking: top-N per group, global top-k, rows of the latest key.

Every ranking breaks ties on the group's key columns (ascending, NULLs last) so the cut at rank N
never depends on scan order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Tasks that rank one group in the first step.
RANK_BUCKETS = 16


def _ordering(measures: Sequence[str], tie_break: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(m) for m in measures] + [F.asc_nulls_last(k) for k in tie_break]


def top_n_per_group(
    df: DataFrame,
    group_by: Sequence[str],
    measures: Sequence[str],
    tie_break: Sequence[str],
    n: int,
    rank_col: str = "_rank",
    keep_rank: bool = False,
) -> DataFrame:
    """The ``n`` rows with the largest ``measures`` inside each ``group_by`` group.

    In two steps for every ``n``: the top ``n`` of each (group, bucket of the tie-break key), then the top ``n`` of
    the buckets' winners. A group that holds a third of the data is ranked in RANK_BUCKETS tasks, and its last
    step sees at most RANK_BUCKETS * n rows, whatever Spark's own limit for partial ranking is. Where ``n`` is
    below that limit, a ``WindowGroupLimit`` cuts the rows before each shuffle as well.
    """
    order = _ordering(measures, tie_break)
    bucket = F.pmod(F.xxhash64(*tie_break), F.lit(RANK_BUCKETS))
    in_bucket = Window.partitionBy(*group_by, "_bucket").orderBy(*order)
    df = df.withColumn("_bucket", bucket).withColumn(rank_col, F.row_number().over(in_bucket))
    df = df.filter(F.col(rank_col) <= n).drop(rank_col, "_bucket")
    window = Window.partitionBy(*group_by).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(window)).filter(F.col(rank_col) <= n)
    return ranked if keep_rank else ranked.drop(rank_col)


def top_k(df: DataFrame, measures: Sequence[str], tie_break: Sequence[str], k: int) -> DataFrame:
    """Global top-k (``TakeOrderedAndProject``: each task keeps k rows, the merge sees k x tasks)."""
    return df.orderBy(*_ordering(measures, tie_break)).limit(k)


def top_k_of_latest(
    df: DataFrame,
    latest_col: str,
    measures: Sequence[str],
    tie_break: Sequence[str],
    k: int,
    keep: Column | None = None,
) -> DataFrame:
    """Top-k rows of the group with the largest ``latest_col`` (latest month / window), in one pass.

    Ordered by ``latest_col`` first, every row of the latest group precedes all other rows, so that
    group's top-k is contained in the global top-k. The global top-k is a ``TakeOrderedAndProject``
    (k rows per task, k after the merge); the max over those k rows is then taken on k rows only.
    ``keep`` drops rows after the latest group is chosen (rows failing it sort after the kept rows
    of their group, so they never displace one). Equivalent to
    ``top_k(filter_latest(df, latest_col).filter(keep), ...)`` without evaluating ``df`` twice.
    """
    ordering = [F.desc_nulls_last(latest_col)]
    if keep is not None:
        df = df.withColumn("_keep", keep)
        ordering.append(F.desc("_keep"))
    head = df.orderBy(*ordering, *_ordering(measures, tie_break)).limit(k)
    # A window without partitioning is safe here: its input is the k-row head, never the data.
    head = head.withColumn("_latest", F.max(latest_col).over(Window.partitionBy()))
    out = head.filter(F.col(latest_col) == F.col("_latest")).drop("_latest")
    return out.filter(F.col("_keep")).drop("_keep") if keep is not None else out


def filter_latest(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` equals the column's maximum.

    The maximum is a one-row aggregate (partial max per task, one final row), so broadcasting it is
    bounded by construction; the semi join then filters without shuffling ``df``.
    """
    latest = df.agg(F.max(col).alias(col))
    return df.join(F.broadcast(latest), on=col, how="left_semi")
