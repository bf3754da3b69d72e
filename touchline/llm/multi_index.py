"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Fit (bounded): on at most ``sample`` vectors in hash order (a documented
parameter), centre, rotate by principal axes and by ``turns`` orthogonal
matrices that iterative quantisation moves towards the signs; each rotation
gives one bit per axis, a substring of the code each.  The Hamming radius is the ``recall`` quantile of the
distances between the sample's codes and those of their true k nearest in the
sample; over more rows the nearest are nearer, so recall only grows.

Index: a cell (a bounded block of rows) keeps, for each substring's place, the
rows by value.  Long substrings (64 bits of 256) probe few rows: the share of a
radius that falls on each is far below half of its bits.  A query
probes in every place the values within that place's share of the radius; the
shares sum to the radius plus one minus the number of places, so by the
pigeonhole principle every code within the radius is met.  Those codes are
checked by their full Hamming distance and reranked by exact double-precision
Euclidean distances.  A query that finds fewer than k rows in a cell widens its
radius there until it has k or has seen the cell, so nobody gets fewer than
exist.  Every row is indexed; the model has a few hundred kilobytes.

Rows with a null id, or a vector that is null, empty, zero or holds null or
non-finite parts, take no part.  Rows that share the query's id are its own;
repeated query rows are one query (the smallest vector, if they differ), repeated candidates are each listed.  Only
vectors of one length compare: the commonest length of the sample is hashed,
vectors of other lengths are searched exactly.  Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import thinned
from touchline.llm.vector_grid import best_ranked, by_length, distinct_queries, in_cells, usable_vectors

FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def fit_codes(x: np.ndarray, turns: int = 4, steps: int = 20, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(centre, projections): ``turns`` learned rotations side by side."""
    rng = np.random.default_rng(seed)
    centre = x.mean(axis=0)
    z = x - centre
    _, axes = np.linalg.eigh(z.T @ z)
    z = z @ axes
    out = []
    for _ in range(turns):
        r, _ = np.linalg.qr(rng.standard_normal((z.shape[1], z.shape[1])))
        for _ in range(steps):  # signs for the rotation, then the rotation for the signs
            signs = np.where(z @ r >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ z)
            r = (u @ v).T
        out.append(axes @ r)
    return centre, np.concatenate(out, axis=1)


def codes(x: np.ndarray, centre: np.ndarray, projections: np.ndarray) -> np.ndarray:
    """The code of each row as substrings of up to 64 bits (one rotation each, if it has no more axes)."""
    bits = min(64, x.shape[1])
    on = (x - centre) @ projections >= 0
    on = np.pad(on, ((0, 0), (0, -on.shape[1] % bits))).reshape(len(x), -1, bits)
    on = np.pad(on, ((0, 0), (0, 0), (0, 64 - bits)))
    return np.packbits(on, axis=2, bitorder="little").view("<u8")[:, :, 0].astype(np.uint64)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def fit_radius(x: np.ndarray, code: np.ndarray, k: int, recall: float, probes: int = 512) -> int:
    """The Hamming radius that covers the ``recall`` share of the sample's true neighbours."""
    at = np.linspace(0, len(x) - 1, min(probes, len(x))).astype(int)
    found = []
    for i in at:
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[: min(k, len(x) - 1)]
        found.append(hamming(code[near], code[i]))
    found = np.concatenate(found) if found else np.zeros(0)
    return int(np.quantile(found, recall, method="higher")) if len(found) else 0


class MultiIndex:
    """Substring tables of a block's codes."""

    def __init__(self, code: np.ndarray) -> None:
        self.code = code
        self.tables = []
        for j in range(code.shape[1]):
            order = np.argsort(code[:, j], kind="stable")
            values, first = np.unique(code[order, j], return_index=True)
            self.tables.append((values, np.append(first, len(order)), order))

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius`` of the query's: pigeonhole probes, then the full distance."""
        m = len(self.tables)
        seen = np.zeros(len(self.code), bool)
        share, more = divmod(radius + 1, m)
        for j, (values, first, order) in enumerate(self.tables):
            t = share - 1 + (j < more)
            if t < 0:
                continue
            hit = np.flatnonzero(np.bitwise_count(values ^ query[j]) <= t)
            n = first[hit + 1] - first[hit]
            at = np.repeat(first[hit] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            seen[order[at]] = True
        rows = np.flatnonzero(seen)
        return rows[hamming(self.code[rows], query) <= radius]


class Cell:
    """A block's vectors with the index of their codes."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, model) -> None:
        self.ids, self.x, self.model = ids, x, model if model is not None and len(model[0]) == x.shape[1] else None
        self.index = MultiIndex(codes(x, *self.model[:2])) if self.model else None

    def nearest(self, q: int, v: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        rows = np.arange(len(self.ids))
        if self.model:
            centre, projections, r = self.model
            code = codes(v[None], centre, projections)[0]
            most = projections.shape[1]
            while True:
                rows = self.index.within(code, r)
                rows = rows[self.ids[rows] != q]
                if len(rows) >= k or r >= most:
                    break
                r = min(most, r + 8)
        rows = rows[self.ids[rows] != q]
        dist = np.sqrt(((self.x[rows] - v) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[rows], dist))[:k]
        return [(q, int(self.ids[rows[b]]), float(dist[b])) for b in best]


def nearest(rows: DataFrame, every: int = 100, k: int = 10, sample: int = 4096, turns: int = 4, recall: float = 0.97, block_rows: int = 16384, query_rows: int = 65536) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score of the k nearest found."""
    vectors = usable_vectors(rows, zero=False)
    key = F.xxhash64("vec_id", "vector")
    taken = vectors.filter(thinned(key, vectors.count(), sample)).orderBy(key, "vec_id", "vector").limit(sample).toArrow()
    model = None
    if taken.num_rows:
        ids, x = max(by_length(taken).values(), key=lambda g: len(g[0]))
        if len(ids) > k:
            centre, projections = fit_codes(x, turns)
            model = (centre, projections, fit_radius(x, codes(x, centre, projections), k, recall))
    found = in_cells(vectors, distinct_queries(vectors, every), lambda ids, x: Cell(ids, x, model), lambda cell, q, v: cell.nearest(q, v, k), FOUND_ARROW, block_rows, query_rows)
    return best_ranked(found, k, "score", "vec_id").select("query_id", "rank", "vec_id", "score")
