"""The two models against slow versions: sums of outer products, features by plain loops, lexicon by dictionaries."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import documents
from pyspark.sql import functions as F

from navstream.llm import quality_classifier as quality
from navstream.llm import toxicity
from navstream.llm.calibration import calibrate, calibrated_column, fit_isotonic
from navstream.llm.toxicity import INSULTS, LEXICON_SIZE, LOOK_ALIKES, SECOND_PERSON, Lexicon, learn_lexicon, words_of


def test_normal_equations_are_sums_over_all_rows(spark):
    rng = np.random.default_rng(4)
    k = len(quality.STATS)
    rows = [(rng.normal(size=k).astype(np.float32).tolist(), float(rng.integers(0, 2)), int(rng.integers(0, quality.FOLDS))) for _ in range(700)]
    df = spark.createDataFrame(rows, "x array<float>, y double, fold int").repartition(9)
    mean, scale = quality._moments(df)
    x = np.array([r[0] for r in rows])
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(scale, x.std(axis=0))
    fmap = quality.FourierMap(mean, scale)
    want = np.zeros((quality.FOLDS, quality.DIM + 1, quality.DIM + 2))
    for stats, y, own in rows:
        z = [math.sqrt(2 / quality.DIM) * math.cos(float(((np.array(stats) - mean) / scale).clip(-8, 8) @ fmap.w[:, d] + fmap.b[d])) for d in range(quality.DIM)]
        z.append(1.0)
        want[own] += np.outer(z, [*z, y])
    assert np.allclose(quality.normal_equations(df, fmap), want, atol=1e-6)
    sums = want.sum(axis=0)
    a = sums[:, :-1] + np.diag([quality.RIDGE * len(rows)] * quality.DIM + [1e-9 * len(rows)])
    assert np.allclose(a @ quality._ridge(sums), sums[:, -1], atol=1e-6)


def test_scores_are_the_ridge_fit_behind_the_calibration(spark):
    rng = random.Random(14)
    good, bad = "measured words stand in calm order here. ".split(), "BUY now!!! $$$ click ### win".split()
    rows = [(k, " ".join(rng.choices(bad if k % 3 == 0 else good, k=rng.randint(1, 60)))) for k in range(400)] + [(None, "x"), (400, None)]
    labels = spark.createDataFrame([(k, int(k % 3 != 0)) for k in range(0, 400, 2)], "doc_id long, quality int")
    docs = documents(spark, rows)
    got = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, labels).collect()}
    x = {d: np.array(quality.statistics((t or "").encode()), dtype=np.float32).astype(float) for d, t in rows}
    every = np.array(list(x.values()))
    fmap = quality.FourierMap(every.mean(axis=0), np.where(every.std(axis=0) > 1e-9, every.std(axis=0), 1.0))
    raw = {}
    train = [k for k in range(0, 400, 2) if zlib.crc32(str(k).encode()) % 5]
    z = fmap(np.array([x[k] for k in train]))
    y = np.array([float(k % 3 != 0) for k in train])
    weights = quality._ridge(np.hstack([z.T @ z, (z.T @ y)[:, None]]))
    for d, s in x.items():
        raw[d] = float((fmap(s[None, :]) @ weights)[0])
    ordered = sorted(raw, key=lambda d: raw[d])
    scores = [got[d] for d in ordered]
    assert all(a <= b + 1e-6 for a, b in zip(scores, scores[1:], strict=False))  # calibration keeps the order of the fit
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum((got[k] >= 0.3) == (k % 3 != 0) for k in held) >= 0.95 * len(held)


def slow_features(text, known, stems):
    words = words_of(text)
    n = len(words)
    if not n:
        return [0.0] * len(toxicity.FEATURES)
    people = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    spots = [i for i, w in enumerate(words) if w in INSULTS or w in known]
    near = sum(any(abs(i - p) <= toxicity.NEAR for p in people) for i in spots)
    hits = [known[w] for w in words if w in known]
    stem_hits = [stems[w[: toxicity.STEM]] for w in words if w[: toxicity.STEM] in stems]
    if not (sum(w in INSULTS for w in words) or hits):
        near = 0
    mixed = [w for w in text.split() if not w.isalpha() and toxicity.MIXED.search(w)]
    plain = [w.strip(toxicity.EDGE).lower().translate(LOOK_ALIKES).replace(".", "").replace("-", "") for w in mixed]
    letters = [c for c in text if c.isascii() and c.isalpha()]
    per = lambda v: v * 100.0 / n
    return [
        per(sum(w in INSULTS for w in words)), per(len(hits)), per(sum(hits)), max(hits, default=0.0), per(len(stem_hits)), max(stem_hits, default=0.0),
        per(near), per(len(people)), sum(c.isupper() for c in letters) / max(1, len(letters)),
        sum(w.isupper() and len(w) > 2 for w in text.split()) / n, text.count("!") / n, text.count("?") / n, sum(c in ".,;:" for c in text) / n,
        len(mixed) / n, float(sum(p in INSULTS or p in known for p in plain)), math.log1p(n),
    ]


def test_features_match_a_plain_loop():
    rng = random.Random(5)
    known, stems = {"foo": 3.0, "bar": 2.5}, {"blab": 4.0}
    lexicon = Lexicon(known, stems)
    words = ["you", "tu", "foo", "bar", "id1ot", "IDIOT", "m0ron!", "calm", "Blabber", "f.o.o", "x-y", "é", "日本", "?", "...", "stupid,", "du", "NO", "ok"]
    for _ in range(300):
        text = rng.choice([" ", "\n", "  "]).join(rng.choices(words, k=rng.randint(0, 25)))
        assert np.allclose(lexicon.features(text.encode()), slow_features(text, known, stems))
    assert lexicon.features(None) == lexicon.features(b" ") == (0.0,) * len(toxicity.FEATURES)


def test_lexicon_matches_counts_by_dictionary(spark):
    rng = random.Random(15)
    rows = []
    for _ in range(400):
        toxic = rng.random() < 0.4
        rows.append((" ".join(rng.choices(["awful", "awfully", "grim"] if toxic else ["calm", "nice", "tree"], k=3) + rng.choices(["the", "river"], k=4)), int(toxic), 1))
    got = learn_lexicon(spark.createDataFrame(rows, "text string, y int, part int").repartition(5))
    a, b = Counter(), Counter()
    for text, y, _ in rows:
        words = set(words_of(text))
        (a if y else b).update([(0, w) for w in words] + [(1, s) for s in {w[: toxicity.STEM] for w in words if len(w) > toxicity.STEM}])
    t, c = sum(y for _, y, _ in rows), sum(1 - y for _, y, _ in rows)
    want = {}
    for entry, n in a.items():
        odds = math.log((n + 0.5) / t) - math.log((b[entry] + 0.5) / c)
        expected = (n + b[entry]) * t / (t + c)
        g2 = 2 * (n * math.log(n / expected) + (b[entry] * math.log(b[entry] / (n + b[entry] - expected)) if b[entry] else 0.0))
        if n >= toxicity.MIN_DOCS and odds >= toxicity.MIN_LOG_ODDS and g2 >= toxicity.MIN_G2:
            want[entry] = odds
    assert len(want) <= LEXICON_SIZE and want
    assert {(0, w): v for w, v in got.words.items()} | {(1, s): v for s, v in got.stems.items()} == {k: pytest.approx(v) for k, v in want.items()}


def test_calibration_is_monotone_and_the_same_in_both_forms(spark):
    rng = random.Random(16)
    rows = [(x, float(rng.random() < 0.5 + x / 4)) for x in (rng.uniform(-1.9, 1.9) for _ in range(3000))]
    df = spark.createDataFrame(rows, "raw double, y double")
    knots = fit_isotonic(df, "raw", "y", -2.0, 2.0)
    assert knots[0] == sorted(knots[0]) and knots[1] == sorted(knots[1])
    pairs = df.select("raw", calibrated_column(F.col("raw"), knots).alias("p")).collect()
    assert np.allclose([r["p"] for r in pairs], calibrate(np.array([r["raw"] for r in pairs]), knots))
    assert abs(np.mean([r["p"] for r in pairs]) - np.mean([y for _, y in rows])) < 0.02
