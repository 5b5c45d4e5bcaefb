"""SimHash near-dedup with Golay-code fuzzy hashing.

A fingerprint holds, per bit, the majority over the 64-bit hashes of a text's word shingles. Two
fingerprints link at ``max_bits`` differing bits or fewer. Candidates come from the perfect binary Golay
code (23, 12): a fingerprint splits into three segments, and every segment decodes to the index of
its nearest codeword and, where that lies 3 bits away, to the five codewords at 4 bits as well.

Why no pair is missed up to 4 bits: two of the three segments differ by 2 bits or fewer together.
Segments that differ by e bits have a common codeword within 4 bits of both for e <= 2 (the one nearest
to a word half-way, which is within 3 bits of that word), and for (1, 1) the nearest codewords of one segment of
each side lie within 4 bits of the other side. So the keys (nearest, any) and (any, nearest) of the three pairs
of segments, 24 bits each, meet for every such pair. Fingerprints that share a key are compared exactly.

Equal fingerprints are one node, so copies cost nothing; buckets are compared in blocks of bounded size.

Defined cases: a NULL or wordless text has fingerprint zero and links like any other; fewer words than a
shingle make one shingle; rows with equal ids are rows of one document id and each gets its row; a NULL id
never names a component, but its fingerprint links like any other: its row gets the least id of its group (NULL if
no row of the group has an id); further columns are ignored; an empty input gives an empty result. Texts are
hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.llm.buckets import block_pairs, group_slices, verified_pairs
from navstream.llm.common import batches, cut, prepare, texts_as_bytes
from navstream.llm.components import components, local_roots

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fixed value: generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """The majority bits of the shingle hashes of one whole text, as a signed 64-bit number."""
    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    blob = b" ".join(words)
    if len(words) <= width:
        h = np.array([xxhash.xxh64_intdigest(blob, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1]
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
        h = np.array([digest(blob[s:e], SEED) for s, e in spans], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65_536):
        part = h[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(id, fp, th) of every row; ``th`` is a hash of the text."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    id_type = dict(source.dtypes)["id"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows, 512):
            fps = pa.array([fingerprint(t, width) for t in texts_as_bytes(part.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), fps, part.column("th")], names=["id", "fp", "th"])

    return source.mapInArrow(run, f"id {id_type}, fp long, th long")


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the nearest codeword's error pattern, and the (up to five) patterns of weight 4; and
    the syndrome of each byte of a 23-bit word. All derived from the generator."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    single = [remainder(1 << b) for b in range(23)]
    leaders, fours = np.zeros(2048, dtype=np.int64), np.zeros((2048, 5), dtype=np.int64)
    filled = np.zeros(2048, dtype=np.int64)
    for weight in (1, 2, 3, 4):
        for bits in combinations(range(23), weight):
            syndrome, pattern = 0, 0
            for b in bits:
                syndrome ^= single[b]
                pattern |= 1 << b
            if weight < 4:
                leaders[syndrome] = pattern
            else:
                fours[syndrome, filled[syndrome]] = pattern
                filled[syndrome] += 1
    by_byte = np.zeros((3, 256), dtype=np.int64)
    for k in range(3):
        for value in range(256):
            for b in range(8):
                if value >> b & 1 and 8 * k + b < 23:
                    by_byte[k, value] ^= single[8 * k + b]
    return leaders, fours, by_byte


def codewords(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices (12 bits) of the nearest codeword and of those at 4 bits; -1 where there are none."""
    leaders, fours, by_byte = golay_tables()
    syndrome = by_byte[0, words & 255] ^ by_byte[1, words >> 8 & 255] ^ by_byte[2, words >> 16 & 255]
    near = (words ^ leaders[syndrome]) >> 11
    at_four = fours[syndrome]
    return np.column_stack([near, np.where(at_four > 0, (words[:, None] ^ at_four) >> 11, -1)])


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every fingerprint: per pair of segments, (nearest, any) and (any, nearest)."""
    words = fp.astype(np.int64).view(np.uint64)
    found = [codewords(((words >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64)) for at, bits in SEGMENTS]
    rows, keys = [], []
    for number, (x, y) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        a, b = found[x], found[y]
        for left, right in [(a[:, 0], b[:, k]) for k in range(6)] + [(a[:, k], b[:, 0]) for k in range(1, 6)]:
            there = np.flatnonzero((left >= 0) & (right >= 0))
            rows.append(there)
            keys.append((number << 24) | (left[there] << 12) | right[there])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(nodes: DataFrame) -> DataFrame:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows, 4096):
            at, keys = fuzzy_keys(part.column("fp").to_numpy())
            index = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(keys), part.column("id").take(index), part.column("fp").take(index)], names=["key", "id", "fp"])

    return nodes.mapInArrow(run, "key long, id long, fp long")


def _links(pairs: DataFrame, max_bits: int) -> DataFrame:
    """Verified links of each slice, reduced to stars: at most one link per row of a bucket."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, g in group_slices(rows, 8192):
            ids, fp = t.column("id").to_numpy(), t.column("fp").to_numpy().astype(np.int64).view(np.uint64)
            own, lo, hi = (t.column(c).to_numpy() for c in ("own", "lo", "hi"))
            near = lambda x: np.bitwise_count(x) <= max_bits
            root = np.arange(len(g))
            for i, j in verified_pairs(
                g, own, lo, hi, lambda i, j: near(fp[i] ^ fp[j]), lambda a, b: near(fp[a][:, None] ^ fp[b][None, :])
            ):
                keep = root[i] != root[j]
                if keep.any():
                    at = np.arange(len(g))
                    root = local_roots(len(g), np.r_[at, i[keep]], np.r_[root, j[keep]])
            linked = np.flatnonzero(root != np.arange(len(g)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[root[linked]])], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(id, fp, th, group, component) of every row: the group is its least fingerprint, the component its least id; ids are
    integers. The key scheme is exact up to 4 bits."""
    if max_bits > 4:
        raise ValueError("the key scheme finds every pair up to 4 differing bits only")
    prints = cut(fingerprints(docs, id_col, text_col, width), "simhash-prints")
    nodes = cut(prints.groupBy("fp").agg(F.min("id").cast("long").alias("least")).select(F.col("fp").alias("id"), "fp", "least"), "simhash-nodes")
    links = _links(block_pairs(_keyed(nodes.select("id", "fp")), "id"), max_bits)
    found = components(links, "simhash").withColumnRenamed("id", "node")
    grouped = cut(
        nodes.join(found, nodes["id"] == found["node"], "left").select(F.col("fp").alias("nfp"), F.coalesce("component", "id").alias("group"), "least"),
        "simhash-grouped",
    )
    named = cut(grouped.groupBy("group").agg(F.min("least").alias("component")), "simhash-named")
    of_print = grouped.join(named, "group").select("nfp", "group", "component")
    return prints.join(of_print, prints["fp"] == of_print["nfp"], "left").select("id", "fp", "th", "group", "component")
