"""Quality rules as a bitmask ledger.

Each text is measured once and every rule is evaluated once; the ledger row keeps the measurements
and one failure bit per rule. A policy is a versioned mask over those bits, so policies are applied,
compared and ablated later by bitwise arithmetic, without touching a text again.

Defined cases: a NULL text measures as an empty one (no words) and fails ``few_words``; rows with
equal or NULL ids are measured one by one; further columns of the input are ignored; an empty input
gives an empty ledger. Texts of any length are measured whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.llm.common import batches, prepare, texts_as_bytes

SPACES = b"\t\n\x0b\x0c\r "
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
LETTERS = CAPITALS + CAPITALS.lower()

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_capitals", "n_bangs",
)


@dataclass(frozen=True)
class Rule:
    """One failure condition (SQL over the measurements) and the ledger bit it owns for good."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule(5, "capitals", "2 * n_capitals > n_letters AND n_letters > 0"),
    Rule(6, "exclamation", "5 * n_bangs > n_words AND n_words > 0"),
)


@dataclass(frozen=True)
class Policy:
    """A named version of which rules reject a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        masks = {r.name: r.mask for r in RULES}
        return sum(masks[name] for name in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
V1 = Policy("v1", tuple(r.name for r in RULES))


def repeated_window_words(words: list[bytes], width: int = 5) -> int:
    """Words covered by ``width``-word windows that occur at least twice in the list."""
    n = len(words)
    if n < width:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    windows, base = n - width + 1, len(seen)
    if base**width < 2**62:  # the window is one number in base ``base``
        code = ids[:windows].copy()
        for k in range(1, width):
            code = code * base + ids[k : k + windows]
    else:  # larger vocabularies: rename prefixes densely, word by word
        code = ids[:windows]
        for k in range(1, width):
            code = np.unique(code * base + ids[k : k + windows], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    repeated = np.zeros(windows, dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, np.flatnonzero(repeated), 1)
    np.add.at(cover, np.flatnonzero(repeated) + width, -1)
    return int((np.cumsum(cover[:n]) > 0).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    text = text or b""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text.translate(None, SPACES + CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_window_words(words),
        len(lines),
        len(text) - len(text.translate(None, LETTERS)),
        len(text) - len(text.translate(None, CAPITALS)),
        text.count(b"!"),
    )


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements...) of every row, measured whole."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = dict(source.dtypes)["doc_id"]
    fields = pa.schema([(name, pa.int64()) for name in MEASURES])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows, 256):
            got = [measure(t) for t in texts_as_bytes(part.column("text"))]
            columns = [pa.array(c, type=pa.int64()) for c in zip(*got, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", *fields.names])

    return source.mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{m} long" for m in MEASURES))


def rule_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements plus ``fail_bits``: bit i is set where rule i fails."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(rule.mask)).otherwise(F.lit(0)).cast("long"))
    return measurements(docs, id_col, text_col).withColumn("fail_bits", bits)


def passes(policy: Policy, bits: str = "fail_bits"):
    """True where no rule of the policy failed."""
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policies(ledger: DataFrame, policies: tuple[Policy, ...] = (V1,)) -> DataFrame:
    """The ledger with one boolean ``kept_<version>`` per policy."""
    return ledger.withColumns({f"kept_{p.version}": passes(p) for p in policies})


def ablation(ledger: DataFrame, policy: Policy = V1) -> DataFrame:
    """Per rule of the policy: documents it rejects, documents only it rejects, and what the policy would
    keep without it. Documents are first counted per distinct bit pattern (combined before the
    shuffle, at most 2^rules rows), and every rule is read off that histogram."""
    patterns = ledger.groupBy(
        F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")
    ).agg(F.count(F.lit(1)).alias("docs"))
    rules = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("mask")) for r in RULES if r.name in policy.rules]
    )
    each = patterns.select("bits", "docs", F.explode(rules).alias("r")).select("bits", "docs", "r.rule", "r.mask")
    hit = F.col("bits").bitwiseAND(F.col("mask")) != 0
    alone = F.col("bits") == F.col("mask")
    rest = F.col("bits").bitwiseAND(F.bitwise_not("mask")) == 0
    return (
        each.groupBy("rule")
        .agg(
            F.sum(F.when(hit, F.col("docs")).otherwise(0)).alias("rejected"),
            F.sum(F.when(alone, F.col("docs")).otherwise(0)).alias("rejected_alone"),
            F.sum(F.when(rest, F.col("docs")).otherwise(0)).alias("kept_without"),
            F.bit_or(F.when(hit, F.col("bits")).otherwise(F.lit(0).cast("long"))).alias("failed_together"),
        )
        .withColumn("version", F.lit(policy.version))
    )
