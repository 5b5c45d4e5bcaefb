"""Isotonic calibration of raw scores from a histogram.

Raw scores fall into a fixed grid of bins; bins are counted by Spark (combined before the shuffle), and
pooling adjacent violators runs over at most BINS rows, whatever the number of documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 2048


def fit_isotonic(scored: DataFrame, raw: str, label: str, low: float, high: float) -> tuple[list[float], list[float]]:
    """Knots (raw score, probability) of the non-decreasing fit. ``label`` lies in 0..1."""
    width = (high - low) / BINS
    place = F.least(F.greatest(F.floor((F.col(raw) - low) / width), F.lit(0)), F.lit(BINS - 1))
    rows = (
        scored.groupBy(place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("y"), F.avg(raw).alias("x"))
        .orderBy("bin")
        .collect()
    )
    return pool_violators([r["x"] for r in rows], [r["y"] for r in rows], [r["n"] for r in rows])


def pool_violators(xs, ys, ns) -> tuple[list[float], list[float]]:
    """Pool adjacent violators over ordered bins (mean raw score, label sum, count)."""
    blocks: list[list[float]] = []  # label sum, count, first x, last x
    for x, y, n in zip(xs, ys, ns, strict=True):
        blocks.append([float(y), float(n), float(x), float(x)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            y1, n1, _, x1 = blocks.pop()
            blocks[-1][0] += y1
            blocks[-1][1] += n1
            blocks[-1][3] = x1
    knots_x, knots_y = [], []
    for y, n, first, last in blocks:
        for x in dict.fromkeys((first, last)):
            knots_x.append(x)
            knots_y.append(min(1.0, max(0.0, y / n)))
    return knots_x, knots_y


def calibrate(raw: np.ndarray, knots: tuple[list[float], list[float]], default: float = 0.5) -> np.ndarray:
    """Interpolated probability; ``default`` where nothing was fitted."""
    if not knots[0]:
        return np.full(len(raw), default)
    return np.interp(raw, knots[0], knots[1])


def calibrated_column(raw: Column, knots: tuple[list[float], list[float]], default: float = 0.5) -> Column:
    """The same interpolation as a Spark expression: the knots at either side are looked up in a constant array."""
    xs, ys = knots
    if not xs:
        return F.lit(default)
    x, y = F.array(*[F.lit(v) for v in xs]), F.array(*[F.lit(v) for v in ys])
    k = F.size(F.filter(x, lambda v: v <= raw))
    at = lambda a, i: F.element_at(a, i)
    step = (raw - at(x, k)) / (at(x, k + 1) - at(x, k))
    return F.when(k == 0, F.lit(ys[0])).when(k >= len(xs), F.lit(ys[-1])).otherwise(at(y, k) + step * (at(y, k + 1) - at(y, k)))
