"""Clustering of link pairs for lookups in both directions.

Sorted by (prev, curr), a table skips row groups for ``prev = x`` and reads all of them for ``curr = x``. Sorted along a space-filling curve
(Morton order) it skips for both: the key interleaves the bits of the two columns' ranks, a rank being the
column's place among 2^BITS - 1 boundaries. Boundaries come from a bounded sample and only steer the layout; no result depends on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6
#: Values that the boundaries of a column are drawn from.
SAMPLE = 20_000


def boundaries(df: DataFrame, col: str, bits: int = BITS, sample: int = SAMPLE) -> list[str]:
    """Ascending values that part the column into about 2^bits even ranges. About ``sample`` of its distinct values, chosen by
    hash, are sorted in Spark; the boundaries alone come to the driver."""
    values = df.select(F.col(col).alias("v")).where("v IS NOT NULL").distinct()
    share = min(1.0, sample / max(1, values.agg(F.approx_count_distinct("v")).first()[0]))
    drawn = values.where(F.pmod(F.xxhash64("v", F.lit(3)), F.lit(1_000_003)) < int(1_000_003 * share) + 1)
    held = drawn.agg(F.sort_array(F.collect_list("v")).alias("s"))
    parts = 2**bits
    picked = held.select(
        F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda k: F.get("s", F.floor(k * F.size("s") / parts).cast("int"))).alias("b")
    ).first()["b"]
    return sorted({x for x in picked if x is not None})


def rank(col: str, bounds: Sequence[str]) -> Column:
    """How many boundaries are at most the value, by a binary search written as nested conditions; 0 for NULL."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(col) < bounds[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return F.when(F.col(col).isNull(), F.lit(0)).otherwise(search(0, len(bounds)))


def interleaved(first: Column, second: Column, bits: int = BITS) -> Column:
    """Bits of two ranks in turn, the first one's ahead."""
    key = F.lit(0).cast("long")
    for k in range(bits):
        for shift, value in ((2 * k + 1, first), (2 * k, second)):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(value.cast("long"), k).bitwiseAND(F.lit(1).cast("long")), shift))
    return key


def clustered_both_ways(pairs: DataFrame, files: int, first: str = "prev", second: str = "curr", bits: int = BITS) -> DataFrame:
    """``pairs`` in ``files`` ranges of the curve, sorted along it: write it as it is."""
    one, other = (rank(c, boundaries(pairs, c, bits)) for c in (first, second))
    keyed = pairs.withColumns({"_one": one, "_other": other}).withColumn("_curve", interleaved(F.col("_one"), F.col("_other"), bits))
    return keyed.repartitionByRange(files, "_curve", first, second).sortWithinPartitions("_curve", first, second).drop("_one", "_other", "_curve")
