"""Toxicity: gradient-boosted trees over dense text features, isotonically calibrated.

Features are densities of lexicon words (a fixed list of insults, and a lexicon learned from the
labelled rows), how near a second-person pronoun stands to a lexicon word, and rates of capitals,
punctuation and obfuscated words. The learned lexicon holds words and word beginnings that toxic labelled
texts use far more often, kept by log-odds and a likelihood-ratio test.

Labels come from rows outside the held-out fold only, and training uses at most about MAX_TRAIN of
them, chosen by a hash of the id. A fifth of these is for calibration: neither the lexicon nor the trees see it. Every document is
scored, whole.

Defined cases: a NULL text scores as an empty one; rows with equal ids are scored one by one; a NULL id
is scored and counts as not held out; repeated labels average and count as toxic from 0.5; where the
labels hold one class only or none, every score is that class's share (0 without labels); an empty
input gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.llm.calibration import calibrated_column, fit_isotonic
from navstream.llm.common import batches, cut, fold, held_out, one_label, prepare, texts_as_bytes
from navstream.llm.quality_rules import CAPITALS, LETTERS

#: Labelled rows used for training at most (expected number; rows are chosen by hash).
MAX_TRAIN = 40_000
#: Entries of the learned lexicon at most, smallest document count, log-odds and G2 of an entry.
LEXICON_SIZE, MIN_DOCS, MIN_LOG_ODDS, MIN_G2 = 4_000, 4, 2.5, 18.0
STEM = 4
TREES, DEPTH, MAX_BINS = 20, 3, 32

#: Insults, second-person pronouns, and the plain letters of common look-alikes.
INSULTS = (
    "idiot idiots moron morons loser losers stupid dumb trash garbage scum worthless pathetic disgusting clown clowns "
    "fool fools ugly vermin filth filthy imbecile coward liar jerk freak creep bastard bitch whore slut hate kill"
).split()
SECOND_PERSON = "you your yours you're u ur tu te toi vous votre tú usted ustedes vosotros du dich dir ihr euch dein deine".split()
LOOK_ALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""})

FEATURES = (
    "insults", "learned", "learned_weight", "learned_max", "stems", "stem_max", "near_person", "person",
    "capitals", "capital_words", "bangs", "questions", "marks", "obfuscated", "hidden_insults", "log_words",
)
EDGE = ".,;:!?\"'()[]{}<>|#%&"
MIXED = re.compile(r"[^\W\d_][0-9@$!*.\-]+[^\W\d_]")
NEAR = 4


def words_of(text: str) -> list[str]:
    """Lower-cased words without edge punctuation."""
    return [w for w in (x.strip(EDGE) for x in text.lower().split()) if w]


class Lexicon:
    """Learned entries and their log-odds, by word and by word beginning."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems, self.insults, self.person = words, stems, frozenset(INSULTS), frozenset(SECOND_PERSON)

    def features(self, raw: bytes | None) -> tuple[float, ...]:
        text = (raw or b"").decode("utf-8", "replace")
        words = words_of(text)
        n = len(words)
        if not n:
            return (0.0,) * len(FEATURES)
        known, stems = self.words, self.stems
        hits = [known[w] for w in words if w in known]
        stem_hits = [stems[w[:STEM]] for w in words if w[:STEM] in stems]
        insults = sum(w in self.insults for w in words)
        people = [i for i, w in enumerate(words) if w in self.person]
        near = 0.0
        if people and (insults or hits):
            spots = np.array([i for i, w in enumerate(words) if w in self.insults or w in known])
            gap = np.abs(spots - np.array(people)[np.clip(np.searchsorted(people, spots), 0, len(people) - 1)])
            before = np.abs(spots - np.array(people)[np.clip(np.searchsorted(people, spots) - 1, 0, len(people) - 1)])
            near = float((np.minimum(gap, before) <= NEAR).sum())
        mixed = [m for m in (w for w in text.split() if not w.isalpha()) if MIXED.search(m)]
        hidden = sum(
            (p := m.strip(EDGE).lower().translate(LOOK_ALIKES).replace(".", "").replace("-", "")) in self.insults or p in known
            for m in mixed
        )
        raw = raw or b""
        size = lambda drop: len(raw) - len(raw.translate(None, drop))
        scale = 100.0 / n
        return (
            insults * scale, len(hits) * scale, sum(hits) * scale, max(hits, default=0.0),
            len(stem_hits) * scale, max(stem_hits, default=0.0), near * scale, len(people) * scale,
            size(CAPITALS) / max(1, size(LETTERS)), sum(w.isupper() and len(w) > 2 for w in text.split()) / n,
            text.count("!") / n, text.count("?") / n, size(b".,;:") / n,
            len(mixed) / n, float(hidden), float(np.log1p(n)),
        )


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str) -> DataFrame:
    """(text, y 0/1, part): at most about MAX_TRAIN labelled rows outside the held-out fold; part 0 is for calibration."""
    known = one_label(labels, label_id, label_col).where(fold("id") != 0)
    total = known.count()
    take = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1_000_003)) < F.lit(int(1_000_003 * min(1.0, MAX_TRAIN / max(1, total))))
    return (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .join(F.broadcast(known.where(take)), F.col("doc_id") == F.col("id"))  # about MAX_TRAIN short rows at most
        .select("text", (F.col("y") >= 0.5).cast("int").alias("y"), F.pmod(F.xxhash64("id", F.lit(12)), F.lit(5)).cast("int").alias("part"))
    )


def learn_lexicon(train: DataFrame) -> Lexicon:
    """Words and word beginnings that mark toxic texts. Document counts are combined before the shuffle;
    only the LEXICON_SIZE strongest entries come to the driver."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows, 64):
            kinds, entries, toxic = [], [], []
            for text, y in zip(texts_as_bytes(part.column("text")), part.column("y").to_pylist(), strict=True):
                words = set(words_of((text or b"").decode("utf-8", "replace")))
                stems = {w[:STEM] for w in words if len(w) > STEM}
                entries += [*words, *stems]
                kinds += [0] * len(words) + [1] * len(stems)
                toxic += [y] * (len(words) + len(stems))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), pa.array(entries, pa.string()), pa.array(toxic, pa.int32())], names=["kind", "entry", "y"]
            )

    n = train.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("t")).first()
    n_toxic, n_clean = n["t"], n["n"] - n["t"]
    if not n_toxic or not n_clean:
        return Lexicon({}, {})
    counts = (
        train.select("text", "y").mapInArrow(run, "kind int, entry string, y int")
        .groupBy("kind", "entry")
        .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
        .where(F.col("a") >= MIN_DOCS)
    )
    a, b = F.col("a"), F.col("b")
    odds = F.log((a + 0.5) / n_toxic) - F.log((b + 0.5) / n_clean)
    expected = (a + b) * (n_toxic / (n_toxic + n_clean))
    g2 = 2 * (a * F.log(a / expected) + F.when(b > 0, b * F.log(b / ((a + b) - expected))).otherwise(0.0))
    rows = (
        counts.withColumns({"w": odds, "g2": g2})
        .where((F.col("w") >= MIN_LOG_ODDS) & (F.col("g2") >= MIN_G2))
        .orderBy(F.desc("g2"), "kind", "entry")
        .limit(LEXICON_SIZE)
        .collect()
    )
    return Lexicon({r["entry"]: float(r["w"]) for r in rows if r["kind"] == 0}, {r["entry"]: float(r["w"]) for r in rows if r["kind"] == 1})


def with_features(rows: DataFrame, lexicon: Lexicon, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and x array<double>, the features of the whole text."""
    prepare(rows.sparkSession)
    source = rows.select(*keep) if text_col in keep else rows.select(*keep, text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema) + ", x array<double>"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 128):
            x = pa.array([lexicon.features(t) for t in texts_as_bytes(part.column(text_col))], type=pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], x], names=[*keep, "x"])

    return source.mapInArrow(run, schema)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "toxic",
    keep: list[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns (the id by default), held_out, score and predicted, one row per input row."""
    keep = keep or [id_col]
    train = cut(labelled(docs, labels, id_col, text_col, label_id, label_col), "toxicity-train")
    lexicon = learn_lexicon(train.where("part <> 0"))  # calibration rows stay unseen
    sample = cut(with_features(train, lexicon, "text", ["y", "part"]), "toxicity-features")
    vector = sample.withColumn("features", array_to_vector("x"))
    sizes = {(r["y"], r["fit"]): r["n"] for r in sample.groupBy("y", (F.col("part") != 0).alias("fit")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get((0, True)) or not sizes.get((1, True)):
        total = sum(sizes.values())
        share = sum(n for (y, _), n in sizes.items() if y) / total if total else 0.0
        return docs.select(*keep, held_out(id_col).alias("held_out"), F.lit(share).alias("score"), F.lit(int(share >= 0.5)).alias("predicted"))
    model = GBTClassifier(
        featuresCol="features", labelCol="y", maxIter=TREES, maxDepth=DEPTH, maxBins=MAX_BINS, stepSize=0.3, seed=7, cacheNodeIds=False
    ).fit(vector.where("part != 0").select("features", F.col("y").cast("double").alias("y")))
    margin = vector_to_array("rawPrediction")[1]
    raw = F.when(F.isnan(margin), F.lit(0.0)).otherwise(margin)
    knots = fit_isotonic(model.transform(vector.where("part = 0")).select(raw.alias("raw"), "y"), "raw", "y", -4.0, 4.0)
    scored = model.transform(with_features(docs, lexicon, text_col, keep).withColumn("features", array_to_vector("x")))
    return (
        scored.select(*keep, raw.alias("raw__"))
        .withColumn("score", calibrated_column(F.col("raw__"), knots))
        .select(*keep, held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )
