"""Embedding near-dedup by E8 lattice hashing.

Every table rotates the unit vectors at random, takes two blocks of eight coordinates and decodes each block to
its nearest points of the E8 lattice. A cell is a pair of lattice points; a vector enters the cells of its nearest
point and of the next-nearest one in either block, so a pair that a cell wall parts still meets. Vectors that
share a cell are compared exactly, by cosine in double precision, and a pair found in several cells counts in the
first of them only.

Equal vectors of a label are one class with a multiplicity, so copies cost nothing; cells are compared in blocks
of bounded size; links leave a task as counts per vector and star-shaped links.

Defined cases: a vector that is NULL, empty, zero or holds NULL or non-finite components, or whose label or id is
NULL, links with nothing; only vectors of equal length are compared; equal rows are vectors of their own (each
counts the other as a link); rows with equal ids and different vectors share links and component; further
columns are ignored; an empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navstream.llm.buckets import block_pairs, group_slices, verified_pairs
from navstream.llm.common import batches, cut
from navstream.llm.components import components, local_roots

TABLES, BLOCKS, PROBES, SEED = 10, 2, 2, 8
#: More than matrix products can be off.
SLACK = 1e-9
#: Length, in units of the lattice, of a projected difference at the threshold (root mean square).
REACH = 0.42
KEYS = PROBES**BLOCKS


def nearest_points(x: np.ndarray, probes: int = PROBES) -> np.ndarray:
    """(n, probes, 8): doubled coordinates of the nearest E8 points of each row, nearest first.

    E8 is the union of D8 (integers of even sum) and D8 shifted by one half. In either coset the two
    best points come from rounding and correcting the parity at the cheapest coordinates.
    """
    found, cost = [], []
    for shift in (0.0, 0.5):
        y = x - shift
        low = np.rint(y)
        gap = y - low
        other = low + np.where(gap >= 0, 1.0, -1.0)
        price = 1 - 2 * np.abs(gap)  # extra squared distance of the second-nearest integer
        order = np.argsort(price, axis=1)
        base = (gap**2).sum(axis=1)
        odd = low.sum(axis=1) % 2 != 0
        rows = np.arange(len(x))
        c0, c1 = order[:, 0], order[:, 1]
        first, second = low.copy(), low.copy()
        first[rows[odd], c0[odd]] = other[rows[odd], c0[odd]]
        second[rows[odd], c1[odd]] = other[rows[odd], c1[odd]]
        even = ~odd
        second[rows[even], c0[even]] = other[rows[even], c0[even]]
        second[rows[even], c1[even]] = other[rows[even], c1[even]]
        p0, p1 = price[rows, c0], price[rows, c1]
        found += [2 * (first + shift), 2 * (second + shift)]
        cost += [base + np.where(odd, p0, 0), base + np.where(odd, p1, p0 + p1)]
    points = np.stack(found, axis=1)
    best = np.argsort(np.stack(cost, axis=1), axis=1, kind="stable")[:, :probes]
    return np.take_along_axis(points, best[:, :, None], axis=1).astype(np.int64)


@lru_cache(maxsize=4)
def rotations(dim: int) -> np.ndarray:
    """(TABLES, dim, 8 * BLOCKS): orthonormal projections (padded with further directions for short vectors)."""
    rng = np.random.default_rng(SEED)
    width = 8 * BLOCKS
    out = np.zeros((TABLES, dim, width))
    for t in range(TABLES):
        q = np.linalg.qr(rng.standard_normal((max(dim, width), max(dim, width))))[0]
        out[t] = q[:dim, :width]
    return out


def cell_keys(unit: np.ndarray, salt: np.ndarray, threshold: float) -> np.ndarray:
    """(n, TABLES * KEYS) cells of unit vectors; ``salt`` (their label) enters the key."""
    n, dim = unit.shape
    scale = REACH / (np.sqrt(2 - 2 * threshold) * np.sqrt(8 / max(dim, 8 * BLOCKS)))
    mix = np.random.default_rng(SEED + 1).integers(1, 2**63, size=(BLOCKS, 8), dtype=np.uint64) | np.uint64(1)
    keys = np.empty((n, TABLES, KEYS), dtype=np.uint64)
    for t, rotation in enumerate(rotations(dim)):
        y = unit @ rotation * scale
        parts = []
        for b in range(BLOCKS):
            points = nearest_points(y[:, 8 * b : 8 * b + 8])
            h = (points.view(np.uint64) * mix[b]).sum(axis=2)
            parts.append((h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93))
        both = parts[0][:, :, None] + (parts[1] * np.uint64(0xA0761D6478BD642F))[:, None, :]
        both = both + (salt.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))[:, None, None] + np.uint64(t * 0x8EBC6AF09C88C6E3 % 2**64)
        both ^= both >> np.uint64(32)
        keys[:, t] = (both * np.uint64(0x589965CC75374CC3)).reshape(n, KEYS)
    return keys.reshape(n, -1).view(np.int64)


def _usable(values: list | None) -> bytes | None:
    """The vector as doubles, or None where it links with nothing."""
    if not values or any(v is None for v in values):
        return None
    x = np.asarray(values, dtype=np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()
    return (x / np.sqrt((x * x).sum())).tobytes()


def _unit_rows(vectors: DataFrame) -> DataFrame:
    """(id, h1, h2, label, unit) of every row; unit is NULL for vectors that link with nothing."""
    id_type = dict(vectors.dtypes)["id"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            ids, labels = part.column("id").to_pylist(), part.column("label").to_pylist()
            units = [
                None if i is None or y is None else _usable(v)
                for i, y, v in zip(ids, labels, part.column("vec").to_pylist(), strict=True)
            ]
            hashes = [None if u is None else xxhash.xxh3_128_digest(u + str(y).encode()) for u, y in zip(units, labels, strict=True)]
            halves = [[None if h is None else int.from_bytes(h[s], "big", signed=True) for h in hashes] for s in (slice(0, 8), slice(8, 16))]
            salts = [0 if y is None else xxhash.xxh64_intdigest(str(y)) >> 1 for y in labels]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *[pa.array(h, pa.int64()) for h in halves], pa.array(salts, pa.int64()), pa.array(units, pa.binary())],
                names=["id", "h1", "h2", "salt", "unit"],
            )

    return vectors.mapInArrow(run, f"id {id_type}, h1 long, h2 long, salt long, unit binary")


def _matrix(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Units as rows of one matrix, padded with zeros, and their lengths."""
    raw = column.to_pylist()
    dims = np.array([len(r) // 8 for r in raw], dtype=np.int64)
    out = np.zeros((len(raw), int(dims.max(initial=1))))
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        out[rows, :d] = np.frombuffer(b"".join(raw[r] for r in rows), dtype=np.float64).reshape(-1, d)
    return out, dims


def _keys_of(units: np.ndarray, dims: np.ndarray, salt: np.ndarray, threshold: float) -> np.ndarray:
    keys = np.empty((len(units), TABLES * KEYS), dtype=np.int64)
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        keys[rows] = cell_keys(units[rows, :d], salt[rows] + d, threshold)
    return keys


def _keyed(classes: DataFrame, threshold: float) -> DataFrame:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(rows, 2048):
            units, dims = _matrix(part.column("unit"))
            keys = _keys_of(units, dims, part.column("salt").to_numpy(), threshold)
            ids = np.repeat(part.column("id").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "id"])

    return classes.mapInArrow(run, "key long, id long")


def _links(pairs: DataFrame, threshold: float) -> DataFrame:
    """(id, links, root): linked rows of a slice with their weighted link count and the row that stands
    for their part of the component."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, g in group_slices(rows, 4096):
            ids, copies, salt, key = (t.column(c).to_numpy() for c in ("id", "copies", "salt", "key"))
            own, lo, hi = (t.column(c).to_numpy() for c in ("own", "lo", "hi"))
            units, dims = _matrix(t.column("unit"))
            cells = _keys_of(units, dims, salt, threshold).reshape(len(g), TABLES, KEYS)
            alike = lambda i, j: (salt[i] == salt[j]) & (dims[i] == dims[j])
            cosine = lambda i, j: np.einsum("ij,ij->i", units[i], units[j]) >= threshold

            def first_cell(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                """True where this cell is the first one the pair shares."""
                same = cells[i][:, :, :, None] == cells[j][:, :, None, :]
                shared = same.any(axis=(2, 3))
                table = shared.argmax(axis=1)
                rows = np.arange(len(i))
                least = np.where(same[rows, table].any(axis=2), cells[i][rows, table], np.iinfo(np.int64).max).min(axis=1)
                return least == key[i]

            links, root, at = np.zeros(len(g), dtype=np.int64), np.arange(len(g)), np.arange(len(g))
            for i, j in verified_pairs(
                g, own, lo, hi,
                lambda i, j: cosine(i, j) & alike(i, j),
                # matrix products differ from sums over rows in their last bits: the latter decide
                lambda a, b: (units[a] @ units[b].T >= threshold - SLACK) & (salt[a][:, None] == salt[b]) & (dims[a][:, None] == dims[b]),
            ):
                sure = np.concatenate([cosine(i[s : s + 20_000], j[s : s + 20_000]) for s in range(0, len(i), 20_000)])
                i, j = i[sure], j[sure]
                for s in range(0, len(i), 20_000):
                    pi, pj = i[s : s + 20_000], j[s : s + 20_000]
                    keep = first_cell(pi, pj)
                    pi, pj = pi[keep], pj[keep]
                    np.add.at(links, pi, copies[pj])
                    np.add.at(links, pj, copies[pi])
                    new = root[pi] != root[pj]
                    if new.any():
                        root = local_roots(len(g), np.r_[at, pi[new]], np.r_[root, pj[new]])
            found = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[found]), pa.array(links[found]), pa.array(ids[root[found]])], names=["id", "links", "root"]
            )

    return pairs.mapInArrow(run, "id long, links long, root long")


def embedding_groups(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98
) -> DataFrame:
    """(id, n_links, component) of every row; ids are integers."""
    source = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec"), F.col(label_col).alias("label"))
    rows = cut(_unit_rows(source), "e8-rows")
    classes = cut(
        rows.where("unit IS NOT NULL").groupBy("h1", "h2")
        .agg(F.min("id").cast("long").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("salt").alias("salt"), F.first("unit").alias("unit")),
        "e8-classes",
    )
    pairs = block_pairs(_keyed(classes, threshold).distinct(), "id", classes.select("id", "copies", "salt", "unit"))
    linked = cut(_links(pairs, threshold), "e8-links")
    found = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")), "e8").withColumnRenamed("id", "cid")
    counts = linked.groupBy(F.col("id").alias("lid")).agg(F.sum("links").alias("links"))
    of_class = (
        classes.join(counts, classes["id"] == counts["lid"], "left")
        .join(found, classes["id"] == found["cid"], "left")
        .select(
            F.col("h1").alias("c1"), F.col("h2").alias("c2"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    return rows.join(of_class, (rows["h1"] == of_class["c1"]) & (rows["h2"] == of_class["c2"]), "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", F.col("id").cast("long")).alias("component")
    )
