"""Content-defined blocks of texts: the sieve in front of repeated-string search.

A block is a maximal run of windows of ``length`` bytes whose least seed hash is the same. Which block a window
falls in, and the block's seed, depend on the window's bytes alone, so equal windows of different texts lie in
blocks of equal seed.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a seed. Longer seeds recur less by chance, shorter ones make fewer blocks.
SEED_BYTES = 24
MIX = tuple(int(x) | 1 for x in np.random.default_rng(10).integers(2**62, 2**63, size=8))


def name_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit name of the ``width`` bytes at every position, by doubling. The last ``width - 1`` positions have
    no such bytes, and their names mean nothing."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX[0])
    done, names = 1, {1: h}
    while done * 2 <= width:
        h = _join(h, h, done, MIX[done.bit_length()])
        done *= 2
        names[done] = h
    rest = width - done
    if rest:  # the last stretch is the power of two that covers what is left
        part = 1 << (rest - 1).bit_length()
        h = _join(h, names[part], width - part, MIX[7])
    return h.view(np.int64)


def _join(a: np.ndarray, b: np.ndarray, offset: int, odd: int) -> np.ndarray:
    out = a ^ (a >> np.uint64(29))
    out *= np.uint64(odd)
    out[: max(0, len(out) - offset)] += b[offset:]
    out ^= out >> np.uint64(32)
    return out


def window_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` values from every position on (fewer at the end)."""
    width = min(width, len(h))
    m, done = h.copy(), 1
    while done * 2 <= width:
        m[:-done] = np.minimum(m[:-done], m[done:])
        done *= 2
    rest = width - done
    if rest:
        m[:-rest] = np.minimum(m[:-rest], m[rest:])
    return m


def blocks(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text number, first window, windows, seed) of all blocks of the texts lying in ``data``."""
    usable = np.flatnonzero(sizes >= length)
    if not len(usable):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    least = window_minimum(name_hashes(data, SEED_BYTES), length - SEED_BYTES + 1)
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(edge, starts[usable], 1)
    np.add.at(edge, starts[usable] + sizes[usable] - length + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    change = np.r_[True, least[1:] != least[:-1]]
    change[starts[usable]] = True
    first = np.flatnonzero(valid & change)
    # a block ends before the next block or the first position without a window
    stop = np.flatnonzero(~valid & np.r_[True, valid[:-1]])
    stop = np.append(stop, len(data))
    end = np.minimum(np.append(first[1:], len(data)), stop[np.searchsorted(stop, first, side="right")])
    text = usable[np.searchsorted(starts[usable], first, side="right") - 1]
    return text, first - starts[text], end - first, least[first]
