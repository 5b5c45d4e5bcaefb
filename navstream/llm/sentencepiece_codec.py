"""SentencePiece encoding and decoding with an Aho-Corasick automaton and a single dynamic-programming pass.

The automaton over all pieces reports, at every position, the pieces that end there (its output links give them
longest first). One left-to-right pass relaxes the best path to each position:

* unigram models: the path score is the sum of piece scores, the best one stays (Viterbi);
* BPE models: their scores are merge priorities and their sums mean nothing, so Viterbi over scores gives other
  ids than the model. An edge here is admissible or not: piece t may follow piece p if and only if the
  merges of the model, run on the two strings side by side, end in exactly (p, t). A sequence of pieces is the
  model's encoding if and only if all neighbours are admissible, and every prefix has one encoding, so one
  predecessor per position suffices. Admissibility is worked out from the two pieces' merge traces and
  remembered.

Where no piece has the escaped space inside it, text falls apart into words that encode independently, and
words seen before are remembered.

Defined cases: a NULL or empty text encodes to no ids and decodes to the empty text; characters without a
piece become byte pieces (or the unknown piece without byte fallback); the escape character U+2581 in a text decodes to
a space, so only such texts do not round-trip; rows with equal or NULL ids are encoded one by one; further
columns are ignored; an empty input gives an empty result. Texts are encoded whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as spec

from navstream.llm.common import batches, prepare, ragged_take

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BPE = 1, 2
#: Words remembered by a Python worker at most; beyond that it forgets all and goes on.
MEMORY = 500_000
PAIRS = 400_000
#: Fixed value: what an unknown character costs below the lowest piece score in unigram models.
UNKNOWN_PENALTY = 10.0


#: What stands before the first piece of a path.
START = -1


def lone(char: str) -> int:
    """Token of a character without a piece."""
    return -2 - ord(char)


def runs_of(others: str) -> re.Pattern:
    """Escaped spaces and a run of letters, or of other characters; ``others`` are letters that count as such."""
    x = re.escape(others)
    return re.compile(rf"▁*[^\W\d_{x}]+|▁*(?:(?!▁)[\W\d_{x}])+|▁+")


class Codec:
    """A model file, its automaton and what the worker remembers."""

    def __init__(self, path: str | None = None, proto: bytes | None = None):
        self.traces: dict[int, list | None] = {}
        model = spec.ModelProto()
        if proto is None:
            with open(path, "rb") as f:
                proto = f.read()
        model.ParseFromString(proto)
        self.kind = model.trainer_spec.model_type
        types = [p.type for p in model.pieces]
        if self.kind not in (UNIGRAM, BPE) or not set(types) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only unigram and BPE models of normal, byte, control and unknown pieces are supported")
        self.pieces = [p.piece for p in model.pieces]
        self.scores = [p.score for p in model.pieces]
        self.unknown = types.index(UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.pieces, types, strict=True)) if t == NORMAL}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        n = model.normalizer_spec
        self.plain = not n.precompiled_charsmap and n.add_dummy_prefix and n.escape_whitespaces and not n.remove_extra_whitespaces
        self.library = None if self.plain else sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        mixed = [p for p in self.ids if len(runs_of("").findall(p)) > 1]
        self.runs = runs_of("".join(sorted({c for p in mixed for c in p if c.isalnum()})))
        self.by_run = self.by_word and all(len(self.runs.findall(p)) == 1 for p in self.ids)
        shown = [
            b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE else model.trainer_spec.unk_surface.encode() if t == UNKNOWN
            else p.replace(SPACE, " ").encode()
            for p, t in zip(self.pieces, types, strict=True)
        ]
        self.surface = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.surface_size = np.array([len(x) for x in shown], dtype=np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        self.lowest = min((self.scores[i] for i in self.ids.values()), default=0.0)
        self.dummy = n.add_dummy_prefix
        self.admissible: dict[int, bool] = {}
        self.seen: dict[str, bytes] = {}

    # -- text in and out -------------------------------------------------------------------------

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        return SPACE + text.replace(" ", SPACE) if self.plain else self.library.Normalize(text)

    def words(self, normal: str) -> list[str]:
        """Stretches that encode independently: a run of escaped spaces and what follows it."""
        if not self.by_word or not normal:
            return [normal] if normal else []
        head, *rest = normal.split(SPACE)
        out, spaces = ([head] if head else []), ""
        for part in rest:
            spaces += SPACE
            if part:
                out.append(spaces + part)
                spaces = ""
        return out + [spaces] if spaces else out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (escaped, as the model sees it) as int32 bytes; misses go through the automaton."""
        if len(self.seen) > MEMORY:
            self.seen.clear()
        if len(self.admissible) > PAIRS:
            self.admissible.clear()
        seen, path = self.seen, self.viterbi if self.kind == UNIGRAM else self.merge_path
        out = []
        for word in words:
            got = seen.get(word)
            if got is None:
                got = b""
                for part in self.split(word):
                    ids = seen.get(part)
                    if ids is None:
                        ids = seen[part] = array("i", self.with_bytes(path(part))).tobytes()
                    got += ids
            out.append(got)
        return out

    def split(self, word: str) -> list[str]:
        """Runs of letters and of other characters, where no piece holds both."""
        return self.runs.findall(word) if self.by_run else [word]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin (and the end)."""
        plain = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ") if self.plain and self.by_word else None
        if plain is None or pc.any(pc.match_substring_regex(plain, r"(^ )|( $)|  ")).as_py():
            parts = [self.words(self.normalise(t or "")) for t in texts.to_pylist()]
            flat, sizes = pa.array(list(chain.from_iterable(parts)), pa.string()), [len(p) for p in parts]
            prefix = ""
        else:  # words stand between single spaces, and each gets the escaped space before it
            split = pc.split_pattern(plain, " ")
            flat, sizes = split.flatten(), np.where(pc.equal(plain, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(split))
            flat = flat.filter(pa.array(np.repeat(sizes > 0, pc.list_value_length(split).to_numpy())))
            prefix = SPACE
        coded = flat.dictionary_encode()
        ids = self.encode_words([prefix + w for w in coded.dictionary.to_pylist()])
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        starts = np.r_[0, np.cumsum(lengths)[:-1]] if len(ids) else np.zeros(0, np.int64)
        out, ends = ragged_take(np.frombuffer(b"".join(ids), dtype=np.int32), starts, lengths, coded.indices.to_numpy())
        return out, ends[np.r_[0, np.cumsum(sizes)].astype(np.int64)]

    def with_bytes(self, tokens: list[int]) -> list[int]:
        """Ids of a path; characters without a piece (see ``lone``) fall back to their bytes."""
        out: list[int] = []
        for t in tokens:
            if t >= 0:
                out.append(t)
            elif self.bytes:
                out += [self.bytes[b] for b in chr(-2 - t).encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """UTF-8 bytes of every stretch of ids; the space put before a text on encoding is taken off."""
        flat, at = ragged_take(self.surface, self.surface_start, self.surface_size, ids)
        bounds = at[ends]
        keep = np.ones(len(flat), dtype=bool)
        if self.dummy:
            first = bounds[:-1][bounds[1:] > bounds[:-1]]
            keep[first[flat[first] == ord(" ")]] = False
        offsets = np.r_[0, np.cumsum(keep)][bounds]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat[keep])])

    # -- unigram: best sum of scores ----------------------------------------------------------------

    def viterbi(self, word: str) -> list[int]:
        n = len(word)
        best, back = [0.0] + [float("-inf")] * n, [None] * (n + 1)
        scores, ids, cost = self.scores, self.ids, self.lowest - UNKNOWN_PENALTY
        done = 0  # positions up to here have been offered the unknown character, too

        def settle(upto: int) -> None:
            for q in range(done + 1, upto + 1):
                if word[q - 1] not in ids and best[q - 1] + cost > best[q]:
                    best[q], back[q] = best[q - 1] + cost, (q - 1, lone(word[q - 1]))

        for end, (piece, size) in self.automaton.iter(word):
            if end > done:
                settle(end)
                done = end
            start = end + 1 - size
            score = best[start] + scores[piece]
            if score > best[end + 1]:
                best[end + 1], back[end + 1] = score, (start, piece)
        settle(n)
        out, at = [], n
        while at:
            at, token = back[at]
            out.append(token)
        return out[::-1]

    # -- BPE: the one admissible path ---------------------------------------------------------------

    def merge_path(self, word: str) -> list[int]:
        n = len(word)
        last: list = [None] * (n + 1)
        back = [0] * (n + 1)
        last[0] = START
        known = self.admissible.get
        for end, (piece, size) in self.automaton.iter(word):
            if last[end + 1] is not None:
                continue
            start = end + 1 - size
            before = last[start]
            if before is None:
                before = self._single(word, last, back, start)
            pair = before << 24 | piece
            fits = known(pair)
            if fits is None:
                fits = self.admissible[pair] = self.follows(before, piece)
            if fits:
                last[end + 1] = piece
                back[end + 1] = start
        if last[n] is None:
            self._single(word, last, back, n)
        out, at = [], n
        while at:
            out.append(last[at])
            at = back[at]
        return out[::-1]

    @staticmethod
    def _single(word: str, last: list, back: list, at: int) -> int:
        """Positions no piece reached end in a character without a piece."""
        first = at
        while last[first - 1] is None:
            first -= 1
        for q in range(first, at + 1):
            last[q], back[q] = lone(word[q - 1]), q - 1
        return last[at]

    def trace(self, token: int) -> list[tuple[float, str, str]] | None:
        """The merges of one token's string in order: (score, first symbol, last symbol) after each, the
        untouched characters first. None if the string does not end as one symbol."""
        if token not in self.traces:
            symbols = list(self.pieces[token] if token >= 0 else chr(-2 - token))
            steps = [(0.0, symbols[0], symbols[-1])]
            while len(symbols) > 1:
                best = max(
                    ((self.scores[self.ids[a + b]], -k) for k, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in self.ids),
                    default=None,
                )
                if best is None:
                    break
                k = -best[1]
                symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
                steps.append((best[0], symbols[0], symbols[-1]))
            self.traces[token] = steps if len(symbols) == 1 else None
        return self.traces[token]

    def follows(self, before: int, piece: int) -> bool:
        """True if merging the strings of both side by side never joins them: at no moment does a merge across the
        border beat the next merge inside either (leftmost wins a tie)."""
        right = self.trace(piece)
        if before == START:
            return right is not None
        left = self.trace(before)
        if left is None or right is None:
            return False
        never, i, j = float("-inf"), 0, 0
        while True:
            joined = self.ids.get(left[i][2] + right[j][1])
            across = never if joined is None else self.scores[joined]
            a = left[i + 1][0] if i + 1 < len(left) else never
            b = right[j + 1][0] if j + 1 < len(right) else never
            if joined is not None and across > a and across >= b:
                return False
            if a == never and b == never:
                return True
            if a >= b:
                i += 1
            else:
                j += 1


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per Python worker and model."""
    return Codec(path)


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pieces, ids, round_trip) of every row; ``model`` is a path on the workers."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = dict(source.dtypes)["doc_id"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for part in batches(rows, 2048):
            texts = pc.fill_null(part.column("text"), "")
            ids, ends = own.encode(texts)
            same = pc.equal(own.decode(ids, ends), texts.cast(pa.binary()).cast(pa.large_binary()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())), same],
                names=["doc_id", "n_pieces", "ids", "round_trip"],
            )

    return source.mapInArrow(run, f"doc_id {id_type}, n_pieces long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of every row of ids; NULL ids give the empty text, malformed byte runs U+FFFD."""
    source = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    id_type = dict(source.dtypes)["doc_id"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for part in rows:
            lists = part.column("ids")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            raw = own.decode(lists.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)])
            texts = [b.decode("utf-8", "replace") for b in raw.to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return source.mapInArrow(run, f"doc_id {id_type}, text string")
