"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.llm.common import cut, cut_whole, discard

MAX_ROUNDS = 40


def _least(links: DataFrame, node: str) -> DataFrame:
    return links.groupBy(node).agg(F.min("b").alias("m"))


def _large_star(links: DataFrame, name: str) -> DataFrame:
    """Every node hands its larger neighbours to its least neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = cut(_least(both, "a").select("a", F.least("a", "m").alias("m")), f"{name}-least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()


def _small_star(links: DataFrame, name: str) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the least of them. Links point downwards here."""
    least = cut(_least(links, "a"), f"{name}-least")
    handed = links.join(least, "a")
    return (
        handed.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .where("a > b")
        .distinct()
    )


def components(links: DataFrame, name: str) -> DataFrame:
    """(id, component) of every linked id but the least of its component, which is the component.

    ``links`` holds (a, b) in any order, repeats allowed. Each round is written to the shared folder; the
    driver sees one count and one checksum per round, and a round's tables are deleted when the next one's are there. Links never outnumber the first round's, and
    minima are combined before each shuffle and written out, so their join back is a broadcast while they are few, else a
    sort-merge join whose tasks AQE splits at a hub.
    """
    now = cut(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-links"
    )
    stamp = None
    for _ in range(MAX_ROUNDS):
        before = now
        now = cut_whole(links.sparkSession, f"{name}-links", lambda at=now: _small_star(cut(_large_star(at, name), f"{name}-links"), name))
        discard(before)
        seen = tuple(now.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())
        if seen == stamp or seen[0] == 0:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
        stamp = seen
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For rows 0..n-1 linked by (i, j): the least row of each row's component."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            break
        root = new
    return root
