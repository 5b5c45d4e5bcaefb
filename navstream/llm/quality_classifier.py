"""Quality classifier: random Fourier features, ridge regression and isotonic calibration.

A text becomes a short vector of statistics (shares of capitals, symbols, repeats, line shapes and so
on). A fixed random map approximates a Gaussian kernel over the standardised statistics, the normal
equations of the labelled rows are summed partition by partition, and a ridge fit scores every
document. The sums are kept per fold, so each labelled row also gets a score from a model that has not
seen it; isotonic calibration is fitted on those.

The labels are read from rows outside the held-out fold only; no id, source, language or label is
an input of a score.

Defined cases: a NULL text scores as an empty one; empty texts get the score of their statistics
(all zero); rows with equal ids are scored one by one; a row with a NULL id is scored and counts as not
held out; repeated labels average; without any label every score is 0.5; an empty input gives an empty
result. Texts are measured whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.llm.calibration import calibrate, fit_isotonic
from navstream.llm.common import batches, cut, finite, fold, held_out, one_label, prepare, texts_as_bytes
from navstream.llm.quality_rules import CAPITALS, CONTINUATION, LETTERS, SPACES, SYMBOLS, repeated_window_words

#: Size of the random map, kernel width, ridge strength per labelled row, folds, seed of the map.
DIM, WIDTH, RIDGE, FOLDS, SEED = 192, 4.0, 1e-4, 4, 20
#: Groups in which the sums of tasks are added first.
GROUPS = 64
STATS = (
    "log_words", "word_len", "word_len_sd", "capitals", "letters", "digits", "symbols", "bangs", "marks",
    "distinct", "repeat_cover", "same_next", "dup_lines", "line_words", "short_lines", "bytes_per_char",
)


def statistics(text: bytes | None) -> tuple[float, ...]:
    """The statistics of one whole text, in the order of STATS; all zero without words."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATS)
    size = lambda drop: len(text) - len(text.translate(None, drop))
    chars = len(text.translate(None, SPACES + CONTINUATION))
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    letters = size(LETTERS)
    return (
        float(np.log1p(n)),
        chars / n,
        float(lengths.std()),
        size(CAPITALS) / max(letters, 1),
        letters / chars,
        size(b"0123456789") / chars,
        size(SYMBOLS) / n,
        text.count(b"!") / n,
        size(b".,;:?") / n,
        len(set(words)) / n,
        repeated_window_words(words) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        1.0 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        sum(len(x) < 20 for x in lines) / len(lines),
        len(text) / max(1, len(text.translate(None, CONTINUATION))),
    )


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x array<float>) of every row."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = dict(source.dtypes)["doc_id"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows, 256):
            x = pa.array([statistics(t) for t in texts_as_bytes(part.column("text"))], type=pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), x], names=["doc_id", "x"])

    return source.mapInArrow(run, f"doc_id {id_type}, x array<float>")


class FourierMap:
    """z(x) = sqrt(2/D) cos(W x / width + b) of the standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.w = rng.standard_normal((len(mean), DIM)) / WIDTH
        self.b = rng.uniform(0, 2 * np.pi, DIM)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        s = np.clip((finite(x) - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / DIM) * np.cos(s @ self.w + self.b)
        return np.hstack([z, np.ones((len(x), 1))])


def _moments(x: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scale of every statistic, over all rows."""
    k = len(STATS)
    parts = [f for i in range(k) for f in (F.avg(F.col("x")[i]), F.stddev_pop(F.col("x")[i]))]
    row = x.agg(*[p.alias(f"m{i}") for i, p in enumerate(parts)]).first()
    values = np.array([0.0 if v is None else float(v) for v in row]).reshape(k, 2)
    return values[:, 0], np.where(values[:, 1] > 1e-9, values[:, 1], 1.0)


def normal_equations(rows: DataFrame, fmap: FourierMap) -> np.ndarray:
    """Per fold, [Z'Z | Z'y]: each task sums its own rows, and Spark adds the tasks' sums by matrix row in two steps, in
    GROUPS groups of tasks and then across them, so no task adds up more than a share of all tasks.

    What reaches the driver is FOLDS x (DIM + 1) rows of DIM + 2 numbers, for any number of documents.
    """
    width = DIM + 2

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FOLDS, width - 1, width))
        for part in parts:
            z = fmap(np.array(part["x"].tolist()).reshape(len(part), len(STATS)))
            zy = np.hstack([z, part[["y"]].to_numpy()])
            for f in range(FOLDS):
                own = part["fold"].to_numpy() == f
                total[f] += z[own].T @ zy[own]
        if total.any():
            group = TaskContext.get().partitionId() % GROUPS
            yield pd.DataFrame({"cell": range(FOLDS * (width - 1)), "task": group, "v": list(total.reshape(-1, width))})

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"cell": part["cell"][:1], "task": part["task"][:1], "v": [np.sum(part["v"].tolist(), axis=0)]})

    schema = "cell int, task int, v array<double>"
    grouped = rows.mapInPandas(run, schema).groupBy("cell", "task").applyInPandas(add, schema)
    found = grouped.groupBy("cell").applyInPandas(add, schema).collect()
    out = np.zeros((FOLDS * (width - 1), width))
    for r in found:
        out[r["cell"]] = r["v"]
    return out.reshape(FOLDS, width - 1, width)


def _ridge(m: np.ndarray) -> np.ndarray:
    a, y = m[:, :-1], m[:, -1]
    n = max(a[-1, -1], 1.0)
    penalty = np.full(len(a), RIDGE * n)
    penalty[-1] = 1e-9 * n
    return np.linalg.solve(a + np.diag(penalty), y)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
    threshold: float = 0.3,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    x = cut(document_statistics(docs, id_col, text_col), "quality-statistics")
    known = one_label(labels, label_id, label_col)
    own_fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(3)), F.lit(FOLDS)).cast("int")
    train = x.where(fold("doc_id") != 0).join(known, F.col("doc_id") == F.col("id")).select("x", "y", own_fold.alias("fold"))
    fmap = FourierMap(*_moments(x))
    sums = normal_equations(train, fmap)
    if sums[:, -1, -2].sum() == 0:
        return x.select("doc_id", held_out("doc_id").alias("held_out"), F.lit(0.5).alias("score"), F.lit(int(threshold <= 0.5)).alias("predicted"))
    weights = _ridge(sums.sum(axis=0))
    without = np.array([_ridge(sums.sum(axis=0) - own) for own in sums])

    def unseen(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            z = fmap(np.array(part["x"].tolist()).reshape(len(part), len(STATS)))
            yield pd.DataFrame({"raw": (z * without[part["fold"].to_numpy()]).sum(axis=1), "y": part["y"]})

    knots = fit_isotonic(train.mapInPandas(unseen, "raw double, y double"), "raw", "y", -0.5, 1.5)
    id_type = dict(x.dtypes)["doc_id"]

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            stats = np.asarray(part.column("x").flatten(), dtype=np.float64).reshape(part.num_rows, len(STATS))
            p = calibrate(fmap(stats) @ weights, knots)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    scored = x.mapInArrow(score, f"doc_id {id_type}, score double")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
