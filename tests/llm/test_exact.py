"""Operators against brute force, the public libraries, or closed forms."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from conftest_llm import PROSE, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as spec
from tokenizers import Tokenizer

import pyarrow as pa
from navstream.llm import buckets, quality_rules
from navstream.llm.calibration import pool_violators
from navstream.llm.components import components, local_roots
from navstream.llm.e8_dedup import embedding_groups, nearest_points
from navstream.llm.prefix_doubling import remove_repeats
from navstream.llm.quality_rules import V1, ablation, measure, rule_ledger
from navstream.llm.sentencepiece_codec import BPE, UNIGRAM, Codec
from navstream.llm.simhash_golay import codewords, fingerprint, fuzzy_keys, golay_tables, simhash_groups
from navstream.llm.source_mix import mix_sources
from navstream.llm.token_counts import Counter as TokenCounter
from navstream.llm.unit_dedup import dedup_units

SMALL = "/root/testdata/sf0.001"
TEXT = st.text(alphabet="ab ▁\n.é日😀²1,\x1c<|endoftext|>", max_size=60)


def roots(n, links):
    """Brute-force component (least member) of 0..n-1."""
    comp = list(range(n))
    for _ in range(n):
        for i, j in links:
            comp[i] = comp[j] = min(comp[i], comp[j])
    return comp


# -- rules ------------------------------------------------------------------------------------


def slow_repeats(words, width=5):
    seen = Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    covered = {i + k for i in range(len(words) - width + 1) if seen[tuple(words[i : i + width])] > 1 for k in range(width)}
    return len(covered)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40))
def test_repeated_words(words):
    assert quality_rules.repeated_window_words(words) == slow_repeats(words)


def test_repeated_words_with_a_large_vocabulary():
    words = [str(i).encode() for i in range(9_000)] + [str(i).encode() for i in range(100, 120)]
    assert quality_rules.repeated_window_words(words) == slow_repeats(words) == 40


def test_measurements():
    got = dict(zip(quality_rules.MEASURES, measure("Ab é#\x85x!\n\nAb é#\x85x!\n \t".encode()), strict=True))
    assert got["n_words"] == 4 and got["word_chars"] == 14 and got["n_symbols"] == 2
    assert got["n_dup_lines"] == 1 and got["n_lines"] == 2 and got["n_bangs"] == 2


def test_ablation_counts_each_rule_once(spark):
    rows = [(1, PROSE), (2, "short"), (3, "SHOUT! NOW!"), (4, PROSE.upper())]
    ledger = rule_ledger(documents(spark, rows)).cache()
    table = {r["rule"]: r for r in ablation(ledger, V1).collect()}
    bits = [r["fail_bits"] for r in ledger.collect()]
    for rule in quality_rules.RULES:
        assert table[rule.name]["rejected"] == sum(bool(b & rule.mask) for b in bits)
        assert table[rule.name]["rejected_alone"] == sum(b == rule.mask for b in bits)
        assert table[rule.name]["kept_without"] == sum(b & ~rule.mask == 0 for b in bits)


# -- tokenisers -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(public_tokenizers.path("byte_bpe_50k.json")), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.one_of(TEXT, st.text(max_size=40)), max_size=6))
def test_token_counts_match_the_library(counter, texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)] + ["aaaaaaa" * 9, "x  \n y's"]
    own, library = counter
    assert own.count(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def codecs(kind):
    model = spec.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = kind
    if kind == UNIGRAM:  # scores that are log-probabilities in kind, without ties
        for k, p in enumerate(model.pieces):
            if p.type == 1:
                p.score = -5 - ((k * 7919) % 1009) / 64 - (2 if len(p.piece) > 1 else 6)
    proto = model.SerializeToString()
    return Codec(proto=proto), sentencepiece.SentencePieceProcessor(model_proto=proto)


@pytest.mark.parametrize("kind", [BPE, UNIGRAM])
def test_piece_ids_match_the_library_and_decode(spark, kind):
    own, library = codecs(kind)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdehinorst梦𝕏 \n.²1,") for _ in range(rng.randint(0, 50))) for _ in range(600)]
    texts += [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(60).collect()]
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        ids, ends = own.encode(pa.array(part, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == library.encode(part, num_threads=1)
        assert [b.decode() for b in own.decode(ids, ends).to_pylist()] == part


# -- mixing -----------------------------------------------------------------------------------


def test_mix_hits_targets_and_solves_the_dual(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.choice([1, 5, 20, 200, 1000]), rng.choice(["a", "b", "c", None, "é"])) for i in range(600)]
    rows += [(600 + i, "w " * 30, "a") for i in range(400)] + [(2000, "w w", "tiny")]
    got = mix_sources(documents(spark, rows)).collect()
    size = Counter()
    for _, text, source in rows:
        size[source] += len(text.split())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    stopped = set()
    while True:
        rest = sum(size.values()) - sum(3 * size[s] for s in stopped)
        level = rest / sum(weight[s] for s in order if s not in stopped)
        new = {s for s in order if s not in stopped and level * weight[s] > 3 * size[s]}
        if not new:
            break
        stopped |= new
    taken, rated = Counter(), Counter()
    for r in got:
        target = 3 * size[r["source"]] if r["source"] in stopped else level * weight[r["source"]]
        assert math.isclose(r["target"], target, rel_tol=1e-9) and r["source_size"] == size[r["source"]]
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        rated[r["source"]] += r["size"] * r["rate"]
        mean = size[r["source"]] / sum(1 for x in rows if x[2] == r["source"])
        if 0 < r["rate"] < 3 - 1e-9:  # exponential in size: one multiplier per source
            r_lam = math.log(r["rate"]) / (r["size"] / mean)
            assert math.isclose(r_lam, _LAM.setdefault(r["source"], r_lam), rel_tol=1e-6, abs_tol=1e-9)
    for source in order:
        target = 3 * size[source] if source in stopped else level * weight[source]
        assert math.isclose(rated[source], target, rel_tol=1e-6)
        assert abs(taken[source] - target) <= 500  # half of the longest document
    again = {r["id"]: r["taken"] for r in mix_sources(documents(spark, rows[::-1])).collect()}
    assert again == {r["id"]: r["taken"] for r in got}


_LAM: dict = {}


# -- lines and byte strings -------------------------------------------------------------------


def test_lines_keep_the_earliest_and_report_offsets(spark):
    unit = "One  Two three four FIVE six seven eight"
    rows = [(2, f"x\n{unit}\ny"), (1, f"{unit.lower()}\nshort line"), (3, f"{unit}"), (4, "short line")]
    got = {r["id"]: r for r in dedup_units(documents(spark, rows)).collect()}
    assert got[1]["n_removed"] == got[4]["n_removed"] == 0
    assert got[2]["text"] == "x\ny" and [tuple(s) for s in got[2]["spans"]] == [(2, 2 + len(unit))]
    assert got[3]["text"] == "" and got[3]["n_removed"] == 8


def slow_repeated_bytes(rows, length):
    least = {}
    for doc, text in rows:
        for p in range(len(text) - length + 1):
            w = text[p : p + length]
            least[w] = min(doc, least.get(w, doc))
    out = {}
    for doc, text in rows:
        gone = {p + k for p in range(len(text) - length + 1) if least[text[p : p + length]] < doc for k in range(length)}
        kept = bytes(b for p, b in enumerate(text) if p not in gone)
        spans = sum(1 for p in gone if p - 1 not in gone)
        out[doc] = (len(text), len(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("length", [50, 150])
def test_repeated_bytes_match_brute_force(spark, length):
    rng = random.Random(length)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [word(n) for n in (49, 60, 180, 400, 400)] + ["ab" * 120, "x" * 300]
    rows = [(d, "".join(rng.choice([word(rng.randint(0, 90)), rng.choice(shared), rng.choice(shared)[7:]]) for _ in range(4))) for d in range(40)]
    got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(documents(spark, rows), length=length).collect()}
    assert got == slow_repeated_bytes([(d, t.encode()) for d, t in rows], length)


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    a, b = "".join(f"alpha{i}" for i in range(20)), "".join(f"beta{i}" for i in range(20))
    got = sorted((r["id"], r["n_removed"], len(r["kept"])) for r in remove_repeats(documents(spark, [(1, a), (2, "zz" + a), (2, b)]), keep_bytes=True).collect())
    assert got == [(1, 0, len(a)), (2, 0, len(b)), (2, len(a), 2)]


# -- near duplicates --------------------------------------------------------------------------


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(80).collect()] + ["", None, "A b", "É x Y z w"]
    for text in texts:
        assert fingerprint(None if text is None else text.encode()) % 2**64 == slow_fingerprint(text)


def test_golay_code_is_perfect():
    leaders, fours, _ = golay_tables()
    assert len(set(leaders.tolist())) == 2048 and max(bin(x).count("1") for x in leaders.tolist()) == 3
    assert {int((row > 0).sum()) for row in fours} == {0, 5}
    words = np.arange(0, 1 << 22, 4099)
    assert (codewords(words)[:, 0] >= 0).all()


def test_keys_meet_up_to_four_bits():
    rng = np.random.default_rng(1)
    base = rng.integers(-(2**63), 2**63, size=4000, dtype=np.int64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, size=k % 5, replace=False).astype(np.uint64)) if k % 5 else 0 for k in range(4000)], dtype=np.uint64)
    near = (base.view(np.uint64) ^ flips).view(np.int64)
    sets = []
    for fp in (base, near):
        of = defaultdict(set)
        for row, key in zip(*(x.tolist() for x in fuzzy_keys(fp)), strict=True):
            of[row].add(key)
        sets.append(of)
    assert all(sets[0][r] & sets[1][r] for r in range(4000))


def test_simhash_groups_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400")
    got = {r["id"]: (r["fp"] % 2**64, r["component"]) for r in simhash_groups(docs).collect()}
    ids = sorted(got)
    links = [(i, j) for i in range(len(ids)) for j in range(i) if bin(got[ids[i]][0] ^ got[ids[j]][0]).count("1") <= 4]
    comp = roots(len(ids), sorted(links)) if len(links) < 3000 else local_roots(len(ids), *np.array(links).T).tolist()
    assert [got[d][1] for d in ids] == [ids[c] for c in comp]


def test_e8_points_are_the_nearest():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 8)) * 1.5
    got = nearest_points(x, 1)[:, 0] / 2
    halves = np.abs(got * 2 % 2)
    assert ((halves == 0).all(axis=1) | (halves == 1).all(axis=1)).all() and (got.sum(axis=1) % 2 == 0).all()
    assert ((got - x) ** 2).sum(axis=1).max() <= 1 + 1e-9  # the covering radius of E8


def test_embedding_groups_find_what_brute_force_finds(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 16))
    rows = [(i, (base[i % 40] + 0.05 * rng.standard_normal(16)).tolist(), i % 2) for i in range(300)]
    rows += [(900, [0.0] * 16, 0), (901, None, 0), (902, [float("nan")] * 16, 1), (903, rows[0][1], None), (904, [None, 1.0], 0), (905, [], 1)]
    rows += [(910, rows[5][1], 1), (911, rows[5][1], 1), (None, rows[5][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit("clash"))
    monkeypatch.setattr(buckets, "BLOCK", 4)
    got = {r["id"]: (r["n_links"], r["component"]) for r in embedding_groups(df).collect() if r["id"] is not None}
    usable = [(i, np.array(v) / np.linalg.norm(v), y) for i, v, y in rows if i is not None and i < 900 or i in (910, 911)]
    links = [(a, b) for a in range(len(usable)) for b in range(len(usable)) if a != b and usable[a][2] == usable[b][2] and usable[a][1] @ usable[b][1] >= 0.98]
    n = Counter(a for a, _ in links)
    found = sum(got[u[0]][0] for u in usable)
    assert 0.9 * len(links) <= found <= len(links) and all(got[u[0]][0] <= n[k] for k, u in enumerate(usable))
    comp = local_roots(len(usable), *np.array(links).T)
    assert sum(got[u[0]][1] == usable[comp[k]][0] for k, u in enumerate(usable)) >= 0.9 * len(usable)
    assert all(got[i] == (0, i) for i in (900, 901, 902, 903, 904, 905))
    none = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert embedding_groups(none).collect() == []


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=40))
def test_components(spark, links):
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    comp = roots(31, links)
    assert all(got.get(v, v) == comp[v] for v in range(31))


def test_large_buckets_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(buckets, "BLOCK", 8)
    monkeypatch.setattr(buckets, "SMALL", 4)
    keyed = spark.range(60).select((F.col("id") % 2 * (F.col("id") < 50).cast("long")).alias("key"), "id")
    seen = Counter()
    t = pa.Table.from_pandas(buckets.block_pairs(keyed, "id").toPandas().sort_values(["key", "lo", "hi", "own", "id"]), preserve_index=False)
    for part, g in buckets.group_slices(iter(t.to_batches(max_chunksize=7)), 16):
        ids, own, lo, hi = (part.column(c).to_numpy() for c in ("id", "own", "lo", "hi"))
        yes = lambda i, j: np.ones(len(i), bool)
        block = lambda a, b: np.ones((a.stop - a.start, b.stop - b.start), bool)
        for i, j in buckets.verified_pairs(g, own, lo, hi, yes, block):
            seen.update(frozenset(p) for p in zip(ids[i].tolist(), ids[j].tolist(), strict=True))
    key = {r["id"]: r["key"] for r in keyed.collect()}
    want = {frozenset((a, b)) for a in key for b in key if a < b and key[a] == key[b]}
    assert set(seen) == want and set(seen.values()) == {1}


# -- models -----------------------------------------------------------------------------------


def test_isotonic_fit():
    xs, ys = pool_violators([0, 1, 2, 3], [0, 2, 1, 4], [2, 2, 2, 4])
    assert ys == sorted(ys) and xs[0] == 0 and ys[0] == 0.0 and ys[-1] == 1.0 and 0.75 in ys


@pytest.mark.parametrize("name,floor", [("quality", 0.9), ("toxic", 0.85)])
def test_held_out_accuracy(spark, name, floor):
    from navstream.llm.quality_classifier import quality_scores
    from navstream.llm.toxicity import toxicity_scores

    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    scored = (quality_scores if name == "quality" else toxicity_scores)(read("documents"), read("labels"))
    joined = scored.where("held_out").join(read("labels"), "doc_id")
    share = joined.agg(F.avg((F.col("predicted") == F.col(name)).cast("double")), F.min("score"), F.max("score")).first()
    assert share[0] >= floor and 0 <= share[1] <= share[2] <= 1
