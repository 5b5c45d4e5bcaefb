"""Distinct targets of a referrer over any set of months.

Exact distinct counts do not add up over months. Beside each month's exact count a mergeable sketch (HyperLogLog, 2^LG_K
registers) is stored; the union of the sketches of some months estimates the distinct targets over them, without the links. The relative
standard error of the estimate is about 1.04 / sqrt(2^LG_K), 1.6% here; BOUND is five of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.operators.clickstream import internal_links

LG_K = 12
BOUND = 5 * 1.04 / 2 ** (LG_K / 2)


def month_sketches(edges: DataFrame) -> DataFrame:
    """(prev, targets, sketch, month): exact and mergeable distinct targets by month and referrer, internal links only. Sketches are
    built before the shuffle and merged behind it, from distinct pairs."""
    pairs = internal_links(edges).where("curr IS NOT NULL").select("month", "prev", "curr").distinct()
    counted = pairs.groupBy("month", "prev").agg(F.count(F.lit(1)).alias("targets"), F.hll_sketch_agg("curr", LG_K).alias("sketch"))
    return counted.select("prev", "targets", "sketch", "month")


def union_of_months(sketches: DataFrame, months: Sequence[str]) -> DataFrame:
    """(prev, estimate) over the months: reads those months' sketches alone."""
    merged = sketches.where(F.col("month").isin(list(months))).groupBy("prev").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("prev", F.hll_sketch_estimate("sketch").alias("estimate"))


def targets_over(sketches: DataFrame, months: Sequence[str], edges: DataFrame) -> DataFrame:
    """(prev, targets, within): the exact count, and whether the estimate lies within BOUND of it."""
    exact = internal_links(edges).where(F.col("month").isin(list(months)) & F.col("curr").isNotNull())
    exact = exact.select("prev", "curr").distinct().groupBy("prev").agg(F.count(F.lit(1)).alias("targets"))
    found = union_of_months(sketches, months)
    near = F.abs(F.col("estimate") - F.col("targets")) <= F.greatest(F.lit(1.0), F.col("targets") * BOUND)
    return exact.join(found, "prev").select("prev", "targets", near.alias("within"))
