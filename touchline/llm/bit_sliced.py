"""Exact top-k by integer inner product over a bit-sliced index.

Vectors are quantised to floor(scale * x).  A cell keeps each attribute as bit
slices: bitmaps over its rows, one per binary digit (offset by the attribute's
minimum, so digits are unsigned).  A query multiplies and adds by bitmap
arithmetic only: digit j of |q| adds the attribute's slices at weight j; for a
negative factor the complemented slices are added (|q| * (M - v) = |q| * M -
|q| * v).  All bitmaps of a weight are summed by carry-save adders, carries move to
the next weight, and the sum of a row is again a set of slices.  The top rows
are read from the most significant slice downward (rows surely in, rows still
tied); rows tied to the last slice are the boundary and are resolved exactly:
equal scores go by smaller vec_id.

Rows with a null id, or a vector that is null, empty or holds null or
non-finite parts, take no part.  Rows that share the query's id are the
query's own and no candidates; repeated query rows are one query, repeated
candidate rows are each listed.  Only vectors of the query's length compare.
Scores beyond the range of a long saturate, components beyond 2**61 too.
Empty tables give empty results.  Only the id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.vector_grid import best_ranked, distinct_queries, in_cells, usable_vectors

FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
ONES = ~np.uint64(0)
LONG = (1 << 63) - 1


def quantise(x: np.ndarray, scale: float = 256.0) -> np.ndarray:
    return np.clip(np.floor(scale * x), -(2.0**61), 2.0**61).astype(np.int64)


class BitSlices:
    """Bit slices of a cell's quantised vectors (rows in id order)."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows, dims = values.shape
        self.low = values.min(axis=0)
        shifted = (values - self.low).astype(np.uint64)
        digits = [int(m).bit_length() for m in shifted.max(axis=0)]
        words = -(-self.rows // 64)
        padded = np.zeros((words * 64, dims), np.uint64)
        padded[: self.rows] = shifted
        slices, dim, bit = [], [], []
        for b in range(max(digits, default=0)):
            has = [d for d in range(dims) if digits[d] > b]
            bits = ((padded[:, has] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
            slices.append(np.ascontiguousarray(np.packbits(bits, axis=0, bitorder="little").T).view("<u8"))
            dim += has
            bit += [b] * len(has)
        plain = np.concatenate(slices) if slices else np.zeros((0, words), np.uint64)
        self.slices = np.concatenate([plain, ~plain])  # the complement serves negative factors
        self.dim, self.bit = np.array(dim, np.int64), np.array(bit, np.int64)
        self.full = [(1 << d) - 1 for d in digits]
        self.valid = np.zeros(words * 64, np.uint8)
        self.valid[: self.rows] = 1
        self.valid = np.packbits(self.valid, bitorder="little").view("<u8")

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The slices of every row's sum, least significant first, and the constant to add."""
        size = np.abs(query)
        negative = query < 0
        constant = sum(int(q) * int(lo) for q, lo in zip(query, self.low, strict=True))
        constant -= sum(int(s) * f for s, f, neg in zip(size, self.full, negative, strict=True) if neg)
        which, weight = [], []
        for j in range(int(size.max()).bit_length() if len(size) else 0):
            at = np.flatnonzero(((size >> j) & 1).astype(bool)[self.dim])
            which.append(at + negative[self.dim[at]] * len(self.dim))
            weight.append(self.bit[at] + j)
        which = np.concatenate(which) if which else np.zeros(0, np.int64)
        weight = np.concatenate(weight) if weight else np.zeros(0, np.int64)
        order = np.argsort(weight, kind="stable")
        which, weight = which[order], weight[order]
        out, carried, w = [], np.zeros((0, len(self.valid)), np.uint64), 0
        top = int(weight[-1]) if len(weight) else -1
        cut = np.searchsorted(weight, np.arange(top + 2))
        while w <= top or len(carried):
            mine = self.slices[which[cut[w] : cut[w + 1]]] if w <= top else carried[:0]
            x, carries = np.concatenate([mine, carried]) if len(carried) else mine, []
            while len(x) > 1:
                t = len(x) // 3
                if t:
                    a, b, c = x[:t], x[t : 2 * t], x[2 * t : 3 * t]
                    half = a ^ b
                    carries.append((a & b) | (c & half))
                    x = np.concatenate([half ^ c, x[3 * t :]])
                else:
                    carries.append(x[:1] & x[1:])
                    x = x[:1] ^ x[1:]
            out.append(x[0] if len(x) else np.zeros(len(self.valid), np.uint64))
            carried = np.concatenate(carries) if carries else carried[:0]
            w += 1
        return out, constant

    def top(self, query: np.ndarray, k: int, allowed: np.ndarray) -> list[tuple[int, int]]:
        """(row, score) of the k best allowed rows, boundary ties to the first rows."""
        slices, constant = self.scores(query)
        sure, tied = np.zeros_like(allowed), allowed.copy()
        for s in reversed(slices):
            both = sure | (tied & s)
            n = int(np.bitwise_count(both).sum())
            if n > k:
                tied &= s
            elif n < k:
                sure, tied = both, tied & ~s
            else:
                sure, tied = both, np.zeros_like(tied)
                break
        rows = _set_rows(sure)
        rows = np.concatenate([rows, _set_rows(tied)[: k - len(rows)]])
        out = []
        for r in rows.tolist():
            w, b = r // 64, np.uint64(r % 64)
            out.append((r, constant + sum(int((s[w] >> b) & np.uint64(1)) << i for i, s in enumerate(slices))))
        return out


def _set_rows(bitmap: np.ndarray) -> np.ndarray:
    words = np.flatnonzero(bitmap)
    bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return words[at] * 64 + bit


class Cell:
    """A block's bit slices, with the rows' ids in order."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, scale: float) -> None:
        self.ids, self.scale, self.index = ids, scale, BitSlices(quantise(x, scale))

    def best(self, q: int, v: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        allowed = self.index.valid
        lo, hi = np.searchsorted(self.ids, q), np.searchsorted(self.ids, q, side="right")
        if lo < hi:
            allowed = allowed.copy()
            for r in range(lo, hi):
                allowed[r // 64] &= ~(np.uint64(1) << np.uint64(r % 64))
        return [(q, int(self.ids[r]), max(-LONG - 1, min(LONG, s))) for r, s in self.index.top(quantise(v, self.scale), k, allowed)]


def top_inner_products(rows: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0, block_rows: int = 16384, query_rows: int = 65536) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score of its k best."""
    vectors = usable_vectors(rows)
    found = in_cells(vectors, distinct_queries(vectors, every), lambda ids, x: Cell(ids, x, scale), lambda cell, q, v: cell.best(q, v, k), FOUND_ARROW, block_rows, query_rows)
    return best_ranked(found, k, F.desc("score"), "vec_id").select("query_id", "rank", "vec_id", "score")
