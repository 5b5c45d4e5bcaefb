"""Pairs of rows that share a bucket, whatever the bucket's size.

Rows of a bucket are compared in tasks of bounded size. A bucket above BLOCK rows is cut into blocks by a
hash of the row, and every pair of blocks becomes a task group of its own, so a bucket with a third of
all rows spreads over the cluster. Pairs are never emitted: the caller's function sees the verified
index pairs of a slice and returns what it keeps (counts, star-shaped links).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.llm.common import cut

#: Rows of one block.
BLOCK = 1024
#: Groups up to this size are compared by shifts over the whole slice, larger ones as a matrix.
SMALL = 48


def block_pairs(keyed: DataFrame, row_id: str, payload: DataFrame | None = None) -> DataFrame:
    """``keyed`` (key, row id, ...) with (lo, hi, own): the pair of blocks a row is compared in, and its own
    block; sorted so that groups are contiguous in a task.

    Only buckets above BLOCK rows need more than one block, so the counts joined back are those of large buckets. They
    are written out first, so that the join knows their size: a broadcast while they are few, else a sort-merge join that
    AQE can split at a hot bucket. With
    a ``payload`` (row id, ...) to carry, rows alone in their bucket are left out before it is joined.
    """
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    if payload is None:
        counted = keyed.join(cut(counts.where(F.col("n") > BLOCK), "large-buckets"), "key", "left")
    else:
        counted = keyed.join(counts.where("n > 1"), "key")
    blocks = F.ceil(F.coalesce("n", F.lit(1)) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(row_id), F.col("blocks")).cast("int")
    spread = (
        counted.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
        .drop("n", "blocks", "other")
    )
    if payload is not None:
        spread = spread.join(payload, row_id)
    return spread.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "own", row_id)


def group_slices(rows: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of sorted rows, at least about ``limit`` rows at a time, with group numbers."""
    held: list[pa.RecordBatch] = []

    def groups(t: pa.Table) -> np.ndarray:
        change = np.zeros(t.num_rows, dtype=bool)
        for name in ("key", "lo", "hi"):
            v = t.column(name).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        return np.cumsum(change)

    for batch in rows:
        held.append(batch)
        if sum(b.num_rows for b in held) < limit:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        g = groups(t)
        whole = int(np.searchsorted(g, g[-1]))
        if whole:
            yield t.slice(0, whole), g[:whole]
        held = t.slice(whole).to_batches()
    if held and sum(b.num_rows for b in held):
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, groups(t)


def verified_pairs(
    g: np.ndarray, own: np.ndarray, lo: np.ndarray, hi: np.ndarray,
    test_pairs: Callable[[np.ndarray, np.ndarray], np.ndarray],
    test_block: Callable[[slice, slice], np.ndarray],
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) row numbers of verified pairs, i < j. Within a block all pairs; across two blocks the pairs
    between them."""
    if not len(g):
        return
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    ends = np.r_[starts[1:], len(g)]
    size = ends - starts
    small = (size <= SMALL) & (lo[starts] == hi[starts])
    in_small = np.repeat(small, size)
    for shift in range(1, int(size[small].max(initial=1))):
        i = np.flatnonzero(in_small[:-shift] & (g[shift:] == g[:-shift]))
        if len(i):
            ok = test_pairs(i, i + shift)
            if ok.any():
                yield i[ok], i[ok] + shift
    for s, e in zip(starts[~small], ends[~small], strict=True):
        if lo[s] == hi[s]:
            for at in range(s, e, BLOCK):
                rows = slice(at, min(at + BLOCK, e))
                i, j = np.nonzero(test_block(rows, slice(at, e)))
                up = j > i
                if up.any():
                    yield i[up] + at, j[up] + at
        else:
            mid = s + int(np.searchsorted(own[s:e], hi[s]))
            if s < mid < e:
                i, j = np.nonzero(test_block(slice(s, mid), slice(mid, e)))
                if len(i):
                    yield i + s, j + mid
