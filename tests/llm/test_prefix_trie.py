"""The prefix trie against a dictionary of prefixes, for shards, stretches and spills of any size."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from navstream.llm import prefix_trie as trie
from navstream.llm.spill_queue import MessageQueue

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def slow(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    whole, members, children = {}, defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    totals, out = {}, []
    for p in sorted(members, key=len, reverse=True):
        own_saved = (len(members[p]) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        totals[p] = (sum(totals[q][0] for q in children[p]) or 1, own_saved + sum(totals[q][1] for q in children[p]))
        ends = ",".join(str(c) for c in sorted(members[p]) if len(whole[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), parent, len(members[p]), len(children[p]), *totals[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    """With columns that the operator names its own ones after."""
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    return df.withColumns({c: F.lit("clash") for c in ("c", "d", "m", "n", "p1", "part", "words")})


def got(spark, rows, **more):
    return sorted((tuple(r) for r in trie.prefix_trie(table(spark, rows), **more).collect()), key=repr)


def conversations(seed):
    rng = random.Random(seed)
    rows = [(None, 1, "user", "belongs nowhere"), (41, 0, "user", "base is absent"), (44, None, None, None)]
    for c in rng.sample(range(-45, 130), 70):
        for t in range(rng.randint(1, 9)):
            turn = rng.choice([t, None, 0]) if rng.random() < 0.1 else t
            rows.append((c, turn, rng.choice(["user", "bot", None]), rng.choice(["a b", "a", "", "x y z", None, "a b", "a b"])))
    return rows + rows[5:8]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_matches_brute_force(spark, seed):
    rows = conversations(seed)
    assert got(spark, rows) == slow(rows)


@pytest.mark.parametrize("limit", [1, 2, 7])
def test_shards_of_any_size_give_the_same_totals(spark, limit):
    rows = conversations(3)
    assert got(spark, rows, limit=limit) == slow(rows)


def test_stretches_of_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "SPAN", 3)
    rows = conversations(4)
    for c in (60, 61, 62, 63):  # copies of one long conversation
        rows += [(c, t, "user", f"turn {t // 2}") for t in range(40)]
    assert got(spark, rows, limit=2) == slow(rows)


def test_one_conversation_of_many_range_partitions(spark):
    rows = [(40, t, "user", "same text") for t in range(300)] + [(40, 7, "user", "same text")] * 50 + [(43, 0, "u", "x")]
    assert got(spark, rows) == slow(rows)


def test_conversations_without_turns_and_no_rows(spark):
    bare = [(c, 0, "user", "x") for c in range(141, 160)]
    assert got(spark, bare) == slow(bare)
    assert any(depth == 0 and n > 1 and ends != trie.EMPTY for _, depth, _, n, *_, ends in slow(bare))
    assert got(spark, []) == []


def test_queue_spills_and_merges():
    rng, queue, want = random.Random(12), MessageQueue(limit=10), defaultdict(lambda: [0, 0, 0])
    for _ in range(500):
        m = (rng.randint(-9, 0), rng.randint(0, 9), rng.randint(0, 5), rng.randint(0, 5), rng.randint(0, 2**40))
        queue.push(m)
        for k in range(3):
            want[m[:2]][k] += m[2 + k]
    assert len(queue.heads) > 10
    for key in sorted((a, b) for a in range(-9, 1) for b in range(10)):
        assert queue.take(key) == tuple(want[key])
    assert len(queue) == 0
