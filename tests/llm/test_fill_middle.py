"""Fill-in-middle: every row against slices of Python strings, and back."""

from __future__ import annotations

import hashlib
import random

import pytest
from conftest_llm import EDGE_ROWS, LONG, documents

from navstream.llm import fill_middle
from navstream.llm.fill_middle import MiddlePolicy, fill_in_middle, restored

ODD = ["<P>in", "a<S>", "<M>", "<", "<P", "P>", "<<P<S<M", "$1\\2", "a\nb\r\nc\u2028d", "😀" * 9, "é" * 7, "(.{3}+)", "x" * 4095, "y" * 4096, "z\n" * 4097]


def slow(doc, text, policy=MiddlePolicy()):
    text = text or ""
    n, digest = len(text), hashlib.sha256(f"{policy.seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= policy.transformed:
        return doc, n, "plain", None, None, text
    parts = {"P": text[:a], "M": text[a:b], "S": text[b:]}
    order = "SPM" if h4 % 100 < policy.suffix_first else "PSM"
    return doc, n, order.lower(), a, b - a, "".join(f"<{k}>{parts[k]}" for k in order)


def made(df, **more):
    out = fill_in_middle(df, keep=["text"], **more).withColumn("back", restored())
    rows = out.collect()
    assert all(r["back"] == (r["rest"]["text"] or "") for r in rows)
    return sorted((tuple(r[c] for c in ("id", "n", "form", "prefix_chars", "middle_chars", "output")) for r in rows), key=repr)


@pytest.mark.parametrize("policy", [MiddlePolicy(), MiddlePolicy("seed", 100, 50), MiddlePolicy("1", 0)])
def test_rows_match_slices(spark, policy):
    rng = random.Random(11)
    rows = [(k, t) for k, t in enumerate(ODD * 8)] + [(k, "".join(rng.choices("ab <>PSM\n日😀$\\", k=rng.randint(0, 60)))) for k in range(500, 900)]
    rows += [r[:2] for r in EDGE_ROWS]
    assert made(documents(spark, rows, clashing=True), policy=policy) == sorted((slow(*r, policy) for r in rows), key=repr)


def test_no_rows(spark):
    assert made(documents(spark, [])) == []


def test_units_are_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(fill_middle, "BLOCK", 7)
    rows = [(k, "😀é\n"[: k % 4] * k) for k in range(40)] + [(99, LONG)]
    assert made(documents(spark, rows)) == sorted((slow(*r) for r in rows), key=repr)
