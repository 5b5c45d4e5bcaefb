"""Cases that an operator once left out."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from conftest_llm import documents

import corpus_pipeline
from navstream.llm import simhash_golay, source_mix
from navstream.llm.unit_dedup import dedup_units


def slow_units(rows):
    """(doc -> words removed, kept text) by dictionaries over every unit; texts are told apart by id."""
    word = re.compile(r"[\u3000-\ud7ff]|[^\x20\x09-\x0D\u3000-\ud7ff]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    found, first = [], {}
    for doc, text in sorted(rows):
        at = [(m.start(), m.end(), m.group().translate(lower), text.count("\n", 0, m.start())) for m in word.finditer(text)]
        h = [hashlib.md5(w.encode()).hexdigest()[:16] for _, _, w, _ in at]
        points = sorted({min(range(i, i + 10), key=lambda k: (h[k], -k)) for i in range(len(at) - 9)})
        units = {(x, min(y for y in points if y >= x + 20)) for x in points if points[-1] >= x + 20}
        units |= {(max(y for y in points if y <= x - 20), x) for x in points if points[0] <= x - 20}
        lines = defaultdict(list)
        for k, x in enumerate(at):
            lines[x[3]].append(k)
        units |= {(ks[0], ks[-1] + 1) for ks in lines.values() if len(ks) >= 8}
        found.append((doc, text, at, lines, units))
        for a, b in sorted(units):
            first.setdefault(" ".join(x[2] for x in at[a:b]), (doc, b))
    out = {}
    for doc, text, at, lines, units in found:
        gone = set()
        for a, b in units:
            where, end = first[" ".join(x[2] for x in at[a:b])]
            if where != doc or a >= end:
                gone.update(range(a, b))
        kept = []
        for n, line in enumerate(text.split("\n")):
            ks = lines[n]
            if not ks or not gone & set(ks):
                kept.append(line)
            elif set(ks) - gone:
                start = sum(len(x) + 1 for x in text.split("\n")[:n])
                edges = [at[k][0] for k in ks] + [start + len(line)]
                kept.append(text[start : edges[0]] + "".join(text[edges[i] : edges[i + 1]] for i, k in enumerate(ks) if k not in gone))
        out[doc] = (len(gone), "\n".join(kept))
    return out


def test_units_match_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(40)] + ["A", "b,", "日本語", "かな", "É", "😀"]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(20, 70))) for _ in range(6)]
    passages += ["\n".join(["Read more"] * 30), " \t".join(rng.choices(vocabulary, k=40)), "short line\n" * 3]

    def text():
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choices(vocabulary, k=rng.randint(0, 25))) for _ in range(rng.randint(1, 6))]
        return rng.choice(["", " ", "\n"]) + "".join(p + rng.choice([" ", "\n", "\n\n", " \n\t"]) for p in parts)

    rows = [(d, text()) for d in range(120)]
    rows.append((500, rows[3][1].upper()))
    done = dedup_units(documents(spark, rows)).collect()
    want = slow_units(rows)
    assert {r["id"]: (r["n_removed"], r["text"]) for r in done} == want
    assert sum(n > 0 for n, _ in want.values()) > 50
    texts = dict(rows)
    for r in done:  # what the spans leave, but for the breaks of lines that went, is the kept text
        left, at = [], 0
        for s in r["spans"]:
            left.append(texts[r["id"]][at : s["start"]])
            at = s["end"]
        assert "".join([*left, texts[r["id"]][at:]]).replace("\n", "") == r["text"].replace("\n", "")


def test_a_repeated_passage_of_50_words_goes_wherever_it_lies(spark):
    rng = random.Random(50)
    for seed in range(3):
        passage = [f"p{rng.randint(0, 30)}" for _ in range(50)]
        rows = []
        for d in range(40):
            before, after = ([f"{d}x{rng.randint(0, 99)}" for _ in range(rng.randint(0, 30))] for _ in range(2))
            rows.append((d, "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in before + passage + after)))
        removed = {r["id"]: r["n_removed"] for r in dedup_units(documents(spark, rows)).collect()}
        assert removed.pop(0) == 0 and all(31 <= n <= 50 for n in removed.values()), (seed, removed)


def test_pipeline_cuts_a_repeated_block_of_short_lines(spark):
    block = "\n".join(["Read more"] * 58)
    rows = [(1, f"first text\n{block}"), (2, f"{block}\nsecond text"), (3, "Read more\nthird text")]
    got = {r["doc_id"]: r for r in corpus_pipeline.cut_repeated_passages(spark, documents(spark, rows), "").collect()}
    assert len(got[1]["text"].split()) < 40 and len(got[2]["text"].split()) < 20 and got[3]["text"] == rows[2][1]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_near_copies_under_a_repeated_id(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(400)) for w in "xy")
    rows = [(5, a), (5, b), (2, b), (2, b)]
    kept = corpus_pipeline.keep_one_of_near_copies(spark, documents(spark, rows), "")
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(2, b), (5, a)]


def test_near_copies_without_an_id_leave_one_document_of_each_group(spark):
    long, other, third = (" ".join(f"{w}{i}" for i in range(400)) for w in "xyz")
    rows = [(4, long), (None, long), (None, long), (None, other), (None, other), (None, other.upper()), (None, third), (7, third), (None, "lone text")]
    kept = corpus_pipeline.keep_one_of_near_copies(spark, documents(spark, rows), "")
    got = sorted(((r["doc_id"], r["text"].lower()) for r in kept.collect()), key=repr)
    assert got == sorted([(4, long), (7, third), (None, other), (None, "lone text")], key=repr)


def test_fingerprints_without_an_id_link_the_others(spark, monkeypatch):
    prints = [(5, 0b0, 1), (None, 0b1111, 2), (3, 0b11111111, 3), (None, -1, 4), (None, -2, 5)]
    table = spark.createDataFrame(prints, "id long, fp long, th long")
    monkeypatch.setattr(simhash_golay, "fingerprints", lambda *a: table)
    got = {r["fp"]: r["component"] for r in simhash_golay.simhash_groups(documents(spark, [])).collect()}
    assert got == {0b0: 3, 0b1111: 3, 0b11111111: 3, -1: None, -2: None}


def test_large_cells_are_dealt_in_parts(spark, monkeypatch):
    """Many documents of one size and source, some without an id, some of one id: extras are dealt part by part."""
    monkeypatch.setattr(source_mix, "CELL_ROWS", 7)
    rows = [(k, "one two three", "a") for k in range(500)] + [(None, "one two three", "a")] * 60 + [(77, "one two three", "a")] * 40
    rows += [(1000 + k, "four words stand here", "b") for k in range(90)] + [(2000 + k, "x " * (k % 9), None) for k in range(200)]
    runs = []
    for parts in (3, 11):
        mixed = source_mix.mix_sources(documents(spark, rows).repartition(parts)).collect()
        assert len(mixed) == len(rows) and all(r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3 for r in mixed)
        for source in ("a", "b", None):
            own = [r for r in mixed if r["source"] == source]
            assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
        runs.append(sorted(((r["id"], r["size"], r["copies"]) for r in mixed), key=repr))
    assert runs[0] == runs[1]


def test_rates_that_do_not_settle_raise(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "MAX_STEPS", 1)
    rows = [(k, "w " * (1 + k % 17), "ab"[k % 2]) for k in range(60)]
    with pytest.raises(RuntimeError, match="did not settle"):
        source_mix.mix_sources(documents(spark, rows)).collect()
