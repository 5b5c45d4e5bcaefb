"""Token counts under a byte-level BPE vocabulary, by rank-synchronous array merging.

Texts split into pre-tokens by the vocabulary's pattern; the distinct pre-tokens a batch has not seen
before are laid out as one flat array of symbols with sequence numbers. In every round each sequence finds
its pair of lowest rank and merges all its occurrences, for all sequences at once; a sequence
without a ranked pair is done, and its surviving symbols are its token count.

Defined cases: a NULL text counts as empty (0 bytes, 0 tokens); rows with equal or NULL ids are counted one by
one; further columns are ignored; an empty input gives an empty result. Texts are counted whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.llm.common import batches, prepare

#: Fixed value: the split pattern of byte-level vocabularies of this format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LIMIT = 1024
#: Distinct pre-tokens a Python worker remembers at most; beyond that it forgets all and goes on.
MEMORY = 400_000
UNRANKED = np.iinfo(np.int32).max


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, by rule: printable Latin-1
    bytes stand for themselves, the others follow from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PairRanks:
    """Rank of a symbol pair, looked up for whole arrays: hash tables, each holding the pairs whose slot
    was taken in the one before."""

    BITS = (20, 16, 12, 12, 12, 12)
    ODD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, left: np.ndarray, right: np.ndarray, symbols: int):
        self.symbols = np.int64(symbols)
        key = left.astype(np.int64) * self.symbols + right
        self.levels, todo = [], np.arange(len(key))
        for level, bits in enumerate(self.BITS):
            if not len(todo):
                break
            odd = self.ODD + np.uint64(2 * level)
            slot = self._slot(key[todo], odd, bits)
            _, first = np.unique(slot, return_index=True)
            keys, ranks = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, UNRANKED, dtype=np.int32)
            keys[slot[first]], ranks[slot[first]] = key[todo[first]], todo[first]
            self.levels.append((odd, bits, keys, ranks))
            todo = np.delete(todo, first)
        order = np.argsort(key[todo])  # what is left after all tables, if anything
        self.rest = key[todo][order], todo[order].astype(np.int32)

    @staticmethod
    def _slot(key: np.ndarray, odd: np.uint64, bits: int) -> np.ndarray:
        return ((key.view(np.uint64) * odd) >> np.uint64(64 - bits)).view(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.symbols + right
        rank = np.full(len(key), UNRANKED, dtype=np.int32)
        for odd, bits, keys, ranks in self.levels:
            slot = self._slot(key, odd, bits)
            rank = np.where(keys[slot] == key, ranks[slot], rank)
        if len(self.rest[0]):
            at = np.minimum(np.searchsorted(self.rest[0], key), len(self.rest[0]) - 1)
            rank = np.where(self.rest[0][at] == key, self.rest[1][at], rank)
        return rank


class Counter:
    """A vocabulary and the counts of the pre-tokens seen last."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        self.symbol = np.zeros(256, dtype=np.int64)
        for char, byte in alphabet.items():
            self.symbol[byte] = vocab[char]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.pairs = PairRanks(np.array([vocab[a] for a, _ in pairs]), np.array([vocab[b] for _, b in pairs]), 1 + max(vocab.values()))
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.split = regex.compile(PATTERN)
        self.loose = re.compile(r"\A\s|\s\Z|\s\s").search  # white space that does not stand alone
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.seen: dict[str, int] = {}

    def survivors(self, tokens: list[str]) -> np.ndarray:
        """Symbols left of each pre-token after all merges."""
        raw = [t.encode("utf-8", "surrogatepass") for t in tokens]
        counts = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        sym = self.symbol[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(raw)), counts)
        rank = np.full(len(sym), UNRANKED, dtype=np.int32)  # of the pair that starts here
        self._rank(sym, seq, rank, np.arange(len(sym)))
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            low = np.repeat(lowest, np.diff(np.r_[starts, len(sym)]))
            hit = (rank == low) & (low != UNRANKED)
            if (hit[1:] & hit[:-1]).any():
                # an occurrence that overlaps the one before it (aaa) waits: every second of a run merges
                at = np.arange(len(sym))
                hit &= (at - np.maximum.accumulate(np.where(hit, -1, at))) % 2 == 1
            sym[hit] = self.merged[rank[hit]]
            gone = np.r_[False, hit[:-1]]
            counts -= np.bincount(seq[gone], minlength=len(counts))
            stay = ~gone & (low != UNRANKED)  # finished sequences leave the arrays
            changed = hit[stay]
            changed[:-1] |= changed[1:].copy()
            sym, seq, rank = sym[stay], seq[stay], rank[stay]
            self._rank(sym, seq, rank, np.flatnonzero(changed))
        return counts

    def _rank(self, sym: np.ndarray, seq: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
        """Looks up the pairs starting at the positions ``at``."""
        if not len(at):
            return
        after = np.minimum(at + 1, len(sym) - 1)
        found = self.pairs(sym[at], sym[after])
        rank[at] = np.where((seq[at] == seq[after]) & (at < len(sym) - 1), found, UNRANKED)

    def _units(self, text: str) -> list[str]:
        """Stretches that split into pre-tokens independently. A single space between two other characters
        always starts a pre-token, so such texts fall apart there; others split by the pattern."""
        if self.special and self.special.search(text):
            return list(chain.from_iterable(self._units(t) for t in self.special.split(text) if t))
        if self.loose(text):
            return self.split.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + r for r in rest]]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; a special string inside a text is one token."""
        extra = [len(self.special.findall(t)) if self.special else 0 for t in texts]
        parts = [self._units(t) for t in texts]
        if len(self.seen) > MEMORY:
            self.seen.clear()
        new = list(set(chain.from_iterable(parts)).difference(self.seen))
        if new:
            tokens = [self.split.findall(u) for u in new]
            ends = np.cumsum([0, *map(len, tokens)])
            sums = np.r_[0, np.cumsum(self.survivors(list(chain.from_iterable(tokens))))]
            self.seen.update(zip(new, (sums[ends[1:]] - sums[ends[:-1]]).tolist(), strict=True))
        of = self.seen.__getitem__
        return [e + sum(map(of, p)) for e, p in zip(extra, parts, strict=True)]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per Python worker and vocabulary."""
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row. ``vocabulary`` is a path on the workers."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = dict(source.dtypes)["doc_id"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows, 512):
            texts = [t or "" for t in part.column("text").to_pylist()]
            sizes = pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64())
            tokens = pa.array(counter(vocabulary).count(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, tokens], names=["doc_id", "n_bytes", "n_tokens"])

    counted = source.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
