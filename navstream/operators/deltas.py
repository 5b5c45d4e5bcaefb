"""Incremental upkeep of the click marts by signed deltas.

A month is delivered again as a whole. New rows count +1 and the rows of the delivery before -1; summed by group they are the changes,
and groups that did not change cancel out. Stored sums take the changes up by addition. Every stored group also keeps its number of
rows: a group at zero rows is gone, whatever its sum. Distinct targets follow from link pairs that appear or disappear.

All aggregations are sums, so hot articles are combined before each shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.operators.clickstream import internal_links

CLICKS, ROWS = "clicks", "rows"


def signed(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of the new delivery with sign 1, of the old one with sign -1."""
    return new.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1)))


def sum_deltas(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, clicks, rows): what changed by group; unchanged groups are not in it."""
    out = changes.groupBy(*keys).agg(F.sum(F.col("n") * F.col("sign")).alias(CLICKS), F.sum("sign").alias(ROWS))
    return out.where((F.col(CLICKS) != 0) | (F.col(ROWS) != 0))


def pair_deltas(changes: DataFrame) -> DataFrame:
    """Changes of link pairs by month (internal links only)."""
    return sum_deltas(internal_links(changes), ["month", "prev", "curr"])


def merged(stored: DataFrame, deltas: DataFrame, keys: Sequence[str], measures: Sequence[str] = (CLICKS, ROWS)) -> DataFrame:
    """Stored sums plus deltas; groups without rows are gone."""
    both = stored.select(*keys, *measures).unionByName(deltas.select(*keys, *measures))
    return both.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]).where(F.col(ROWS) > 0)


def stored_deltas(after: DataFrame, before: DataFrame, keys: Sequence[str], measures: Sequence[str] = (CLICKS, ROWS)) -> DataFrame:
    """(keys, measures): what changed by group between two states of finer sums; unchanged groups are not in it."""
    both = after.select(*keys, *measures).unionByName(before.select(*keys, *[(-F.col(m)).alias(m) for m in measures]))
    out = both.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    return out.where(reduce(or_, [F.col(m) != 0 for m in measures]))


def target_deltas(stored_pairs: DataFrame, deltas: DataFrame | None = None, after: DataFrame | None = None) -> DataFrame:
    """(month, prev, clicks, rows, targets): changes of out-degrees, from pairs before and after.

    A pair counts as a target while it has rows; a NULL target never does. Pass ``after`` (the :func:`merged` pairs) to reuse pairs that are
    already written: pairs are unique, so nothing is exchanged by target.
    """
    if after is None:
        after = merged(stored_pairs, deltas, ["month", "prev", "curr"])
    target = (F.col("curr").isNotNull() & (F.col(ROWS) > 0)).cast("long")
    return stored_deltas(after.withColumn("targets", target), stored_pairs.withColumn("targets", target), ["month", "prev"], (CLICKS, ROWS, "targets"))
