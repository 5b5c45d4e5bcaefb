"""Suffix-array dedup: repeated byte strings by distributed prefix doubling.

A byte goes if a string of ``length`` bytes that covers it also starts in a document of smaller id. Doubling over
every byte position would shuffle many times the corpus, so positions are ranked sparsely first:

1. Sampled positions. Every text splits into blocks of neighbouring windows with the same least seed
   (``anchors``). Ranking a block by its seed is the first rank, over the sampled positions alone; equal windows
   have equal seeds, so blocks whose seed is unique are unique and drop out.
2. Blocks. Among blocks of one seed, equal blocks tie for good: all but those of the smallest id are repeats as a
   whole. Blocks of a seed with more than one distinct content stay open.
3. Positions. The windows of open blocks are the positions that prefix doubling runs over: position rank
   pairs (rank at p, rank at p + offset) are sorted by Spark, pairs that are unique drop out, the others get new
   ranks, and the offset doubles until it reaches ``length``. The first ranks are 64-bit names of the
   first ``length / 2^k`` bytes. Up to 64 bytes (so at ``LENGTH``) the first pair spans the window: no
   round runs, and one grouping by the pair replaces them.

A task combines equal blocks of its batch first (the later ones are repeats already), so a common passage costs a row
per batch, not per copy. Ranks of a round are pinned by writing them out.

Defined cases: a NULL text is empty; texts shorter than ``length`` stay whole; a NULL id is no smaller id and its
row stays whole; rows with equal ids are not smaller than each other, each is judged against smaller
ids; further columns are ignored; an empty input gives an empty result. Texts are processed whole, as UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navstream.llm.anchors import MIX, SEED_BYTES, blocks, name_hashes
from navstream.llm.common import batches, cut, prepare, texts_as_bytes

LENGTH = 50
#: A block's place is one number: first window * 2^PLACE + number of windows.
PLACE = 31
SLICE = 2_000_000


def first_length(length: int) -> tuple[int, int]:
    """Length of the first names and the number of doubling rounds up to ``length``."""
    rounds = 1
    while -(-length // 2**rounds) > 32:
        rounds += 1
    return -(-length // 2**rounds), rounds


def _flat(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return b"".join(texts), np.cumsum(sizes) - sizes, sizes


def text_blocks(docs: DataFrame, length: int) -> DataFrame:
    """(seed, body, id, place, repeat) of every block of (id, text). ``repeat`` marks blocks that a smaller id of
    the same batch has as well; they need no partner and get a seed of their own."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for part in batches(rows, 4096, SLICE):
            ids = part.column("id").to_numpy()
            raw, starts, sizes = _flat([t or b"" for t in texts_as_bytes(part.column("text"))])
            text, first, windows, seed = blocks(np.frombuffer(raw, dtype=np.uint8), starts, sizes, length)
            view, at = memoryview(raw), starts[text] + first
            spans = zip(at.tolist(), (at + windows + length - 1).tolist(), strict=True)
            body = np.array([digest(view[s:e]) for s, e in spans], dtype=np.uint64).view(np.int64)
            own = ids[text]
            order = np.lexsort((own, body, seed))
            s, b, d = seed[order], body[order], own[order]
            new = np.r_[True, (s[1:] != s[:-1]) | (b[1:] != b[:-1])] if len(s) else np.zeros(0, bool)
            least = d[np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))] if len(s) else d
            repeat = np.zeros(len(s), dtype=bool)
            repeat[order] = d > least
            place = first << PLACE | windows
            seed = np.where(repeat, place * np.int64(0x9E3779B97F4A7C1) ^ own, seed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed), pa.array(body), pa.array(own), pa.array(place), pa.array(repeat)], names=["seed", "body", "id", "place", "repeat"]
            )

    return docs.mapInArrow(run, "seed long, body long, id long, place long, repeat boolean")


def ranked_blocks(found: DataFrame) -> DataFrame:
    """Blocks that matter: open ones (first id of their content, seed shared by other contents) and repeats.
    ``check`` is a part of the content's hash, enough to tell texts of one id apart."""
    same_seed = Window.partitionBy("seed").orderBy("body").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same_body = Window.partitionBy("seed", "body")
    return (
        found.withColumn("mixed", F.first("body").over(same_seed) != F.last("body").over(same_seed))
        .withColumn("least", F.min("id").over(same_body))
        .withColumn("later", F.col("repeat") | (F.col("id") > F.col("least")))
        .where("later OR mixed")
        .select("id", "place", F.shiftright(F.shiftleft("body", 32), 32).cast("int").alias("check"), "later")
    )


def _joined(docs: DataFrame, per_id: DataFrame, how: str) -> DataFrame:
    return docs.join(per_id.withColumnRenamed("id", "own"), F.col("id") == F.col("own"), how).drop("own")


def _true_blocks(text: bytes, listed: list[dict], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first window, windows) of the listed blocks that this very text holds (rows may share an id)."""
    first, windows = [], []
    for x in listed:
        start, n = x["place"] >> PLACE, x["place"] & (1 << PLACE) - 1
        end = start + n + length - 1
        if end <= len(text) and xxhash.xxh3_64_intdigest(text[start:end]) & 0xFFFFFFFF == x["check"] & 0xFFFFFFFF:
            first.append(start)
            windows.append(n)
    return np.array(first, dtype=np.int64), np.array(windows, dtype=np.int64)


def open_positions(docs: DataFrame, opened: DataFrame, length: int) -> DataFrame:
    """(id, p, r, s): windows of open blocks (and the positions behind them that later rounds pair them with) with
    the pair of names of their bytes at p and at p + offset, packed into 96 bits."""
    width, _ = first_length(length)
    offset, ahead = min(width, length - width), max(0, length - 2 * width)
    listed = opened.groupBy("id").agg(F.collect_list(F.struct("place", "check")).alias("listed"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows, 256, SLICE):
            ids, out = part.column("id").to_pylist(), []
            for doc, text, some in zip(ids, texts_as_bytes(part.column("text")), part.column("listed").to_pylist(), strict=True):
                first, windows = _true_blocks(text or b"", some, length)
                if len(first):
                    n = windows + ahead
                    p = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                    p = np.unique(p) if ahead else p
                    names = name_hashes(np.frombuffer(text, dtype=np.uint8), width)
                    out.append((np.full(len(p), doc, dtype=np.int64), p, *packed_pair(names[p], names[p + offset])))
            if out:
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "p", "r", "s"])

    return _joined(docs, listed, "inner").mapInArrow(run, "id long, p long, r long, s int")


def packed_pair(r: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A pair of 64-bit names as 64 and 32 bits, all of them mixed from both."""
    a, b = r.view(np.uint64) * np.uint64(MIX[5]), s.view(np.uint64) * np.uint64(MIX[6])
    a ^= a >> np.uint64(31)
    both = (a + b) * np.uint64(MIX[3])
    both ^= both >> np.uint64(33)
    other = (a ^ (b >> np.uint64(17))) * np.uint64(MIX[4])
    return both.view(np.int64), (other >> np.uint64(32)).astype(np.uint32).view(np.int32)


def later_positions(positions: DataFrame, length: int) -> DataFrame:
    """(id, p, check) of the windows that a smaller id has as well. ``positions`` holds rank pairs at the first
    offset; every further round ranks the pairs that are not unique and pairs ranks at the next offset."""
    reach = first_length(length)[0] * 2
    rounds = reach < length
    now = positions.withColumn("check", F.col("s")) if rounds else positions
    while reach < length:
        ranks = (
            now.groupBy("r", "s").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .repartitionByRange("r", "s").sortWithinPartitions("r", "s")
            .select("r", "s", F.monotonically_increasing_id().alias("rank"))
        )
        ranked = cut(now.join(cut(ranks, "doubling-ranks"), ["r", "s"]).select("id", "p", "check", F.col("rank").alias("r")), "doubling-positions")
        offset = min(reach, length - reach)
        ahead = ranked.select(F.col("id").alias("own"), (F.col("p") - offset).alias("at"), F.col("r").alias("s"))
        now = ranked.join(ahead, (F.col("id") == F.col("own")) & (F.col("p") == F.col("at"))).select("id", "p", "check", "r", "s")
        reach += offset
    least = F.min("id").over(Window.partitionBy("r", "s"))
    return now.withColumn("least", least).where("id > least").select("id", "p", F.col("check" if rounds else "s").alias("check"))


def covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the intervals [start, end)."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, s[1:] > e[:-1]]
    return s[new], e[np.r_[new[1:], True]]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_bytes: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row, and with ``keep_bytes`` the remaining
    bytes as ``kept``; spans are (start, end) byte offsets in the original text. Ids are integers."""
    if length < SEED_BYTES:
        raise ValueError(f"length must be at least {SEED_BYTES}")
    prepare(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = source.where("id IS NOT NULL")
    found = cut(ranked_blocks(text_blocks(known, length)), "doubling-blocks")
    opened = found.where("NOT later").select("id", "place", "check")
    windows = cut(later_positions(open_positions(known, opened, length), length), "doubling-windows")
    whole = found.where("later").select("id", F.struct("place", "check").alias("block"), F.lit(None).cast("struct<p: long, check: int>").alias("window"))
    single = windows.select("id", F.lit(None).cast("struct<place: long, check: int>").alias("block"), F.struct("p", "check").alias("window"))
    per_id = whole.unionByName(single).groupBy("id").agg(F.collect_list("block").alias("listed"), F.collect_list("window").alias("single"))
    id_type, width = dict(docs.select(id_col).dtypes)[id_col], first_length(length)[0]
    offset = min(width, length - width)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows, 256, SLICE):
            out: list[tuple] = []
            columns = (texts_as_bytes(part.column("text")), part.column("listed").to_pylist(), part.column("single"))
            for row, (text, listed) in enumerate(zip(*columns[:2], strict=True)):
                text = text or b""
                first, windows = _true_blocks(text, listed or [], length)
                lone = columns[2][row].values
                if lone is not None and len(lone):
                    p, check = lone.field("p").to_numpy(), lone.field("check").to_numpy()
                    fits = p + length <= len(text)
                    p, check = p[fits], check[fits]
                    names = name_hashes(np.frombuffer(text, dtype=np.uint8), width)
                    p = p[packed_pair(names[p], names[p + offset])[1] == check]
                    first, windows = np.r_[first, p], np.r_[windows, np.ones(len(p), np.int64)]
                s, e = covered(first, first + windows + length - 1)
                edges = np.r_[0, np.column_stack([s, e]).ravel(), len(text)].reshape(-1, 2)
                kept = b"".join([text[a:b] for a, b in edges.tolist()])
                spans = [{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist(), strict=True)]
                out.append((len(text), len(text) - len(kept), len(s), hashlib.sha256(kept).hexdigest(), spans, kept if keep_bytes else None))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *[pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), result, strict=True)]],
                names=["id", *result.names],
            )

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    result = pa.schema(
        [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", span), ("kept", pa.binary())]
    )
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>, kept binary"
    done = _joined(source, per_id, "left").mapInArrow(run, schema).withColumn("id", F.col("id").cast(id_type))
    return done if keep_bytes else done.drop("kept")

