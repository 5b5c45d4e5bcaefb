"""Top editors of every sliding window from mergeable summaries, exact by proof.

Counting every (window, user, wiki) shuffles as many rows as there are such groups. A Misra-Gries summary keeps ``width`` counters: when
more keys are counted, the next largest count is subtracted from all of them, which costs every key at most that much. Each task
summarises the panes (one slide long) it sees; summaries of panes add up to summaries of windows, counters by key and losses
to the window's ``error``. So a key has between ``counter`` and ``counter + error`` edits, a key without a counter at most
``error``, and ``error`` is at most the window's edits / (width + 1). Only counters are shuffled.

* Windows without an error are done: their counters are the counts.
* Elsewhere the keys that can still be among the first n (counter + error reaches the n-th counter) are counted exactly. If the n-th of
  them has more edits than the error, no other key can reach it: the window is proven.
* What is left, windows too flat for the width, is counted in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navstream.operators.edits import human_edits
from navstream.operators.ranking import top_n_per_group
from navstream.session import written

#: Counters of a pane's summary in one task.
WIDTH = 256
#: Counters a task holds before it hands its summaries on: parts of a pane's summary add up like those of different tasks.
HELD = 500_000
KEY_TYPE = "user string, wiki string"


def trimmed(counters: pd.Series, width: int) -> tuple[pd.Series, int]:
    """The ``width`` largest counters less the next largest, and that one: what any key may have lost."""
    if len(counters) <= width:
        return counters, 0
    loss = int(np.partition(counters.to_numpy(), -width - 1)[-width - 1])
    left = counters - loss
    return left[left > 0], loss


def summaries(keyed: DataFrame, width: int, held: int = HELD) -> DataFrame:
    """(pane, key, counter, error) of each task's rows of (pane, key); a pane's error has a row without a key."""

    def rows_of(panes: dict) -> pd.DataFrame:
        counts = [c for c, _ in panes.values()]
        lost = [(p, e) for p, (_, e) in panes.items() if e]
        return pd.DataFrame(
            {
                "pane": [p for p, c in zip(panes, counts, strict=True) for _ in range(len(c))] + [p for p, _ in lost],
                "key": [k for c in counts for k in c.index] + [None] * len(lost),
                "counter": [int(n) for c in counts for n in c] + [0] * len(lost),
                "error": [0] * sum(map(len, counts)) + [e for _, e in lost],
            }
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        panes: dict = {}
        for frame in frames:
            for pane, keys in frame.groupby("pane")["key"]:
                fresh, error = keys.value_counts(), 0
                if pane in panes:
                    fresh, error = panes[pane][0].add(fresh, fill_value=0).astype("int64"), panes[pane][1]
                counters, loss = trimmed(fresh, width)
                panes[pane] = counters, error + loss
            if sum(len(c) for c, _ in panes.values()) > held:
                yield rows_of(panes)
                panes = {}
        if panes:
            yield rows_of(panes)

    return keyed.mapInPandas(run, "pane timestamp, key string, counter long, error long")


def _windows(pane: str, window: str, slide: str) -> Column:
    """Starts of the windows that hold a pane."""
    first = F.col(pane) - F.expr(f"INTERVAL {window}") + F.expr(f"INTERVAL {slide}")
    return F.sequence(first, F.col(pane), F.expr(f"INTERVAL {slide}"))


def _counted(keyed: DataFrame, window: str, slide: str) -> DataFrame:
    """Exact edits by (window_start, key): counted by pane, then added up."""
    panes = keyed.groupBy("pane", "key").agg(F.count(F.lit(1)).alias("edits"))
    return panes.select(F.explode(_windows("pane", window, slide)).alias("window_start"), "key", "edits").groupBy("window_start", "key").agg(
        F.sum("edits").alias("edits")
    )


def top_editors_per_window(
    edits: DataFrame, window: str = "5 minutes", slide: str = "1 minute", n: int = 15, width: int = WIDTH
) -> DataFrame:
    """(window_start, user, wiki, edit_count): the ``n`` busiest editors of every window by human edits, ties by name.

    ``window`` is a multiple of ``slide``; ``edits`` is a batch frame (a written mart or a micro-batch).
    """
    key = F.to_json(F.struct("user", "wiki"))
    pane = F.window(F.col("event_time").cast("timestamp"), slide)["start"]
    keyed = human_edits(edits).select(pane.alias("pane"), key.alias("key"))
    found = summaries(keyed, width)
    wide = found.select(F.explode(_windows("pane", window, slide)).alias("window_start"), "key", "counter", "error")
    by_key = wide.groupBy("window_start", "key").agg(F.sum("counter").alias("counter"), F.sum("error").alias("error"))
    by_key = written(by_key, "editor-summaries")  # read several times below, made once
    # one row a key, and one a window for its error; the largest counters come next in the same partitioning
    error = by_key.where("key IS NULL").select("window_start", "error")
    counters = by_key.where("key IS NOT NULL").select("window_start", "key", "counter")
    known = counters.join(error, "window_start", "left").withColumn("error", F.coalesce("error", F.lit(0)))
    sure = known.where("error = 0").select("window_start", "key", F.col("counter").alias("edits"))
    open_ = _proven_or_counted(keyed, known.where("error > 0"), window, slide, n)
    named = sure.unionByName(open_).select("window_start", F.from_json("key", KEY_TYPE).alias("key"), "edits")
    named = named.select("window_start", "key.user", "key.wiki", F.col("edits").alias("edit_count"))
    return top_n_per_group(named, ["window_start"], ["edit_count"], ["user", "wiki"], n)


def _proven_or_counted(keyed: DataFrame, known: DataFrame, window: str, slide: str, n: int) -> DataFrame:
    """(window_start, key, edits) that hold the first ``n`` of every window with an error."""
    first = top_n_per_group(known, ["window_start"], ["counter"], ["key"], n)
    floor = first.groupBy("window_start").agg(F.min("counter").alias("floor"), F.count(F.lit(1)).alias("listed"))
    able = known.join(floor, "window_start").where((F.col("listed") < n) | (F.col("counter") + F.col("error") >= F.col("floor")))
    candidates = able.select("window_start", "key", "error")
    # the panes of candidates, each pane and key once: rows that can matter are counted, the others stop here
    sought = candidates.select(F.explode(_panes("window_start", window, slide)).alias("pane"), "key").distinct()
    exact = _counted(keyed.join(sought, ["pane", "key"], "left_semi"), window, slide).join(candidates, ["window_start", "key"])
    last = top_n_per_group(exact, ["window_start"], ["edits"], ["key"], n).groupBy("window_start").agg(
        F.min("edits").alias("last"), F.count(F.lit(1)).alias("listed"), F.max("error").alias("error")
    )
    proven = last.where((F.col("listed") == n) & (F.col("last") > F.col("error"))).select("window_start")
    flat = known.select("window_start").distinct().join(proven, "window_start", "left_anti")
    flat_panes = flat.select(F.explode(_panes("window_start", window, slide)).alias("pane")).distinct()
    full = _counted(keyed.join(flat_panes, "pane", "left_semi"), window, slide).join(flat, "window_start", "left_semi")
    return exact.join(proven, "window_start", "left_semi").select("window_start", "key", "edits").unionByName(full)


def _panes(start: str, window: str, slide: str) -> Column:
    last = F.col(start) + F.expr(f"INTERVAL {window}") - F.expr(f"INTERVAL {slide}")
    return F.sequence(F.col(start), last, F.expr(f"INTERVAL {slide}"))
