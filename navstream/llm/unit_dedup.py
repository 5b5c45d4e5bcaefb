"""Substring dedup by hashing lines and content-defined runs of words.

A text is a sequence of words: runs of anything but ASCII white space, and each code point of the scripts written without
spaces on its own. Words are normalised (ASCII letters lower-cased) and hashed, and units of words are hashed to 96 bits by polynomials over those
hashes, whose running sums give every unit of a batch at once:

* every line of at least ``MIN_WORDS`` words;
* runs of words, across line breaks. Cut points depend on the words alone: of every ``WINDOW`` consecutive words the one of the least
  hash (the last of equal ones) begins a piece. From each cut point the shortest run of pieces that holds ``MIN_RUN`` words is a unit,
  and up to each cut point likewise.

Digests are grouped over the whole corpus, the occurrence of the smallest (id, position) stays, and the words of every other one go.
Removed stretches are reported by their offsets in the original text.

What is left of a repeat: cut points inside a repeated passage are the same wherever it stands, the first at most WINDOW - 1
words behind its beginning, the last at most WINDOW words before its end. A passage of 50 words, however it lies in its lines, thus
loses at least 31 words in all but its first place, a longer one all but 19 at most. Shorter repeats than a unit recur by chance
and stay.

Defined cases: a NULL text has no words and stays NULL; an occurrence that begins inside the first one is no repeat of it (so a text
that repeats itself keeps its first unit); rows with equal id and text are one document (what one keeps, the other keeps); rows with equal id
and different texts are ranked by a hash of the text; a NULL id ranks before all others; a line that loses all its words goes with its
break, one that loses some keeps the others with the white space behind them; lines without words stay; further columns are ignored; an empty input gives an
empty result. Texts are processed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.llm.common import batches, cut, prepare, texts_as_bytes

#: Lines with fewer words are no units of their own (runs hold them).
MIN_WORDS = 8
#: Words among which one cut point lies, and words that a run holds at least.
WINDOW, MIN_RUN = 10, 20
#: Distinct words whose hashes a task remembers.
REMEMBERED = 500_000

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: First bytes of U+3000 to U+DFFF: scripts without spaces, and their punctuation.
LONE = np.zeros(256, dtype=bool)
LONE[0xE3:0xEE] = True
#: A unit's place in its text is one number: first word * 2^PLACE + the word behind its last.
PLACE = 31
#: Odd numbers: bases of the two polynomials over word hashes, and what spreads their sums.
BASES = tuple(int(x) | 1 for x in np.random.default_rng(6).integers(2**62, 2**63, size=4))


class WordHashes(dict):
    """The first 64 bits of a word's MD5."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[:8], "big")
        return value


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) byte offsets of the words of a UTF-8 text."""
    data = np.frombuffer(text, dtype=np.uint8)
    space = SPACE[data]
    begins = ~space & np.r_[True, space[:-1]]
    if (lone := LONE[data]).any():
        at = np.flatnonzero((data & 0xC0) != 0x80)  # code points
        own = lone[at]
        begins[at[own]] = True
        behind = at[1:][own[:-1]]
        begins[behind[~space[behind]]] = True
    starts = np.flatnonzero(begins)
    # a word ends at the next word or at white space, whichever comes first
    stops = np.append(np.flatnonzero(space), len(data))
    ends = np.minimum(np.append(starts[1:], len(data)), stops[np.searchsorted(stops, starts)])
    return starts, ends


class Powers:
    """Powers of a base modulo 2^64 and of its inverse, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            more = len(self.up)
            self.up = np.r_[self.up, self.up * np.uint64(pow(self.base, more, 2**64))]
            self.down = np.r_[self.down, self.down * np.uint64(pow(self.inverse, more, 2**64))]
        return self.up[:n], self.down[:n]


def cut_points(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Positions of the least hash (the last of equal ones) of every WINDOW consecutive words of one row."""
    n = len(hashes)
    if n < WINDOW:
        return np.zeros(0, dtype=np.int64)
    least = np.lib.stride_tricks.sliding_window_view(hashes[::-1], WINDOW).argmin(axis=1)[::-1]
    at = np.arange(n - WINDOW + 1)
    return np.unique((at + WINDOW - 1 - least)[rows[at] == rows[at + WINDOW - 1]])


def run_units(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word behind the last) of the shortest long enough runs from and up to every cut point of a row."""
    if not len(points):
        return points, points
    i = np.arange(len(points))
    onward = np.searchsorted(points, points + MIN_RUN)
    back = np.searchsorted(points, points - MIN_RUN, side="right") - 1
    whole, ended = onward < len(points), back >= 0
    first, last = np.r_[i[whole], back[ended]], np.r_[onward[whole], i[ended]]
    own = rows[points[first]] == rows[points[last]]
    pairs = np.unique(first[own] * len(points) + last[own])
    return points[pairs // len(points)], points[pairs % len(points)]


def line_units(text: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word behind the last) of every line of at least MIN_WORDS words."""
    breaks = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 0x0A)
    edges = np.r_[0, np.searchsorted(starts, breaks), len(starts)]
    long = np.diff(edges) >= MIN_WORDS
    return edges[:-1][long], edges[1:][long]


def units_of(texts: list[bytes], hashes: WordHashes, powers: tuple[Powers, Powers]) -> tuple[np.ndarray, ...]:
    """(text number, first word, word behind the last, 64 bits, 32 bits) of every unit of some texts."""
    blob = b"\n".join(texts).lower()  # bytes: ASCII letters only
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    begin = np.cumsum(sizes) - sizes
    starts, ends = words_of(blob)
    rows, base = np.searchsorted(begin, starts, side="right") - 1, np.searchsorted(starts, begin)
    words = blob.split()  # splits at ASCII white space
    if len(words) != len(starts):
        words = [blob[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    a, b = run_units(cut_points(h, rows), rows)
    c, d = line_units(blob, starts)
    pairs = np.unique(np.r_[a * (len(words) + 1) + b, c * (len(words) + 1) + d].astype(np.int64))
    a, b = pairs // (len(words) + 1), pairs % (len(words) + 1)
    sums = []
    for k, power in enumerate(powers):
        up, down = power.upto(len(words) + 1)
        running = np.r_[np.uint64(0), np.cumsum((h ^ (h >> np.uint64(32 * k + 7))) * up[:-1], dtype=np.uint64)]
        x = (running[b] - running[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(BASES[2])
        x = (x ^ (x >> np.uint64(31))) * np.uint64(BASES[3])
        sums.append(x ^ (x >> np.uint64(29)))
    own = rows[a]
    return own, a - base[own], b - base[own], sums[0].view(np.int64), (sums[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def all_units(docs: DataFrame) -> DataFrame:
    """(d1, d2, id, th, at) of every unit of (id, text, th)."""
    id_type = dict(docs.dtypes)["id"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, powers = WordHashes(), (Powers(BASES[0]), Powers(BASES[1]))
        for part in batches(rows, 256):
            row, a, b, low, high = units_of([t or b"" for t in texts_as_bytes(part.column("text"))], hashes, powers)
            rows_at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(low), pa.array(high), part.column("id").take(rows_at), part.column("th").take(rows_at), pa.array(a << PLACE | b)],
                names=["d1", "d2", "id", "th", "at"],
            )

    return docs.mapInArrow(run, f"d1 long, d2 int, id {id_type}, th long, at long")


def cut_words(text: bytes, places: np.ndarray) -> tuple[bytes, int, np.ndarray]:
    """The text without the words at ``places``, how many words went, and the (start, end) code point offsets they
    had, white space up to the next word or the line's end included; a line without words left goes as a whole."""
    starts, _ = words_of(text.lower())
    n = len(starts)
    change = np.bincount(places >> PLACE, minlength=n + 1) - np.bincount(places & (1 << PLACE) - 1, minlength=n + 1)
    gone = np.cumsum(change[:n]) > 0
    data = np.frombuffer(text, dtype=np.uint8)
    breaks = np.append(np.flatnonzero(data == 0x0A), len(data))
    line = np.searchsorted(breaks, starts)
    # a word's piece reaches to the next word of its line, or to the line's end
    piece_end = np.minimum(np.append(starts[1:], len(data)), breaks[line])
    dropped = (np.bincount(line[~gone], minlength=len(breaks)) == 0) & (np.bincount(line, minlength=len(breaks)) > 0)
    begin = np.r_[0, breaks[:-1] + 1][dropped]
    opened = np.bincount(np.r_[starts[gone], begin], minlength=len(data) + 1)
    closed = np.bincount(np.r_[piece_end[gone], breaks[dropped]], minlength=len(data) + 1)
    out = np.cumsum(opened - closed)[: len(data)] > 0
    edge = np.flatnonzero(np.diff(np.r_[False, out, False].astype(np.int8)))
    spans = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][edge].reshape(-1, 2)
    # the breaks of lines that went, or the one before them where they are the last
    left = np.flatnonzero(~dropped)
    out[breaks[:-1][dropped[:-1]]] = True
    if dropped[-1] and len(left):
        out[breaks[left[-1]]] = True
    return data[~out].tobytes(), int(gone.sum()), spans


def dedup_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, text, n_removed, spans, rest): one row per input row, ``text`` without its repeated words, how many they
    were and where; ``rest`` is a struct of the ``keep`` columns."""
    prepare(docs.sparkSession)
    rest = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(0)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"), rest.alias("rest"))
    units = cut(all_units(source.drop("rest")), "units")
    # Most units are unique: they are counted by digest alone, and places meet those of repeated digests only. The repeated digests are
    # written out, so that the join knows their size: broadcast while small, else a sort-merge join AQE can split at a hot line
    repeated = cut(units.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1", "d2"), "units-repeated")
    places = cut(units.join(repeated, ["d1", "d2"]), "units-places")
    first = cut(places.groupBy("d1", "d2").agg(F.min(F.struct("id", "th", "at")).alias("first")), "units-first")
    # an occurrence that begins inside the first one is no repeat of it
    inside = F.shiftright("at", PLACE) < F.col("first.at").bitwiseAND(F.lit((1 << PLACE) - 1))
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th")) & inside
    removed = cut(
        places.join(first, ["d1", "d2"]).where(~same).groupBy("id", "th").agg(F.collect_set("at").alias("places"))
        .select(F.col("id").alias("rid"), F.col("th").alias("rth"), "places"),
        "units-removed",
    )
    joined = source.join(removed, source["id"].eqNullSafe(removed["rid"]) & (source["th"] == removed["rth"]), "left").select("id", "text", "places", "rest")
    id_type, rest_type = (dict(source.dtypes)[c] for c in ("id", "rest"))
    span_type = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows, 128):
            texts, counts, spans, sizes = texts_as_bytes(part.column("text")), [], [], [0]
            for row, text in enumerate(texts):
                held = part.column("places")[row].values
                if text is None or held is None or not len(held):
                    counts.append(0)
                    sizes.append(sizes[-1])
                    continue
                texts[row], removed_words, found = cut_words(text, held.to_numpy())
                counts.append(removed_words)
                spans.append(found)
                sizes.append(sizes[-1] + len(found))
            flat = np.concatenate(spans) if spans else np.zeros((0, 2), dtype=np.int64)
            pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(span_type))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pairs), part.column("rest"),
                ],
                names=["id", "text", "n_removed", "spans", "rest"],
            )

    return joined.mapInArrow(run, f"id {id_type}, text string, n_removed long, spans array<struct<start: long, end: long>>, rest {rest_type}")
