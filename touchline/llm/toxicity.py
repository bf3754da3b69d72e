"""Toxicity scores by the nearest labelled examples under exact TF-IDF cosine.

Fit (bounded): at most ``examples`` labelled rows in hash order (documented
parameter; rows of the held-out fold never take part), of which copies (equal
lower-cased words, equal label) are one example with the smallest id, so that a
much-copied text votes once; near copies are examples of their own.  Terms are the
lower-cased words without punctuation and the first four letters of longer
words; the vocabulary is every term of an example.  Document frequencies are
counted over *all* documents.  A term weighs its idf times 0.1 and the square of
its log odds of the label, drawn to 0 by ``shrink`` average examples: no term is
left out, and one that says nothing of the label counts little.  Terms are told by
64-bit hashes, so no task holds their strings; op8 counts every document's terms
once and writes the counts for both passes.  The examples' vectors go into an
inverted index; the most frequent terms (of an eightieth of the examples and more)
lie dense, in blocks of examples with their largest weight.

Score: the ``k`` examples of largest cosine, found exactly: the rare terms'
postings are added up, then an example is met only if its sum and an upper bound of
what the frequent terms can add (their block maxima, and the norms of both dense
parts) reach the k-th best; the last candidates are computed anew in double
precision, and ties go to the smaller example number.  Evidence: the neighbours, and
the document's terms that weigh most.
Neighbours vote with weight 1 / (1.05 - cosine); the vote is calibrated by an
isotonic map fitted to leave-one-out votes of at most ``calibrate`` examples.  A document without
any term of an example has no neighbours: its score is the share of toxic
rows among such examples, copies counted.

Model size is bounded by the parameters, so it is broadcast.  Null and empty
texts are documents without terms.  Null labels or ids of label rows are left
out; a doc_id labelled twice gives two examples.  With no usable labels every
score is 0.0.  Long texts are read whole.  Repeated rows score alike.  Only the
text column is read, so other columns cannot clash.
"""


import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import U64, Poly, give_back, mix, saved, slices, text_buffer, thinned, words_of, worker_store

#: Stripped from both ends of a word (fixed value).
PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&-_/\\…«»„“”¿¡"
ASCII_MARK = np.isin(np.arange(256), [ord(c) for c in PUNCTUATION if c.isascii()])
WIDE_MARKS = [c.encode() for c in PUNCTUATION if not c.isascii()]
#: Sets a stem's hash apart from a word's (fixed value).
STEM = 0x5354454D5354454D
BLOCK = 64
#: Most frequent terms kept dense, and the share of examples a dense term is in at least (fixed values).
DENSE, OFTEN = 1024, 80
#: Groups of dense terms whose norms bound what they can add.
NORMS = 4
#: Examples whose dense part is added first where many may reach the k-th best.
FIRST = 64
#: Above the rounding of a cosine added up in single precision.
SLACK = 1e-5
#: Terms given as evidence: those that weigh most in the document.
SHOWN = 24


def same_words(texts: pd.Series) -> pd.Series:
    """A digest of a text's lower-cased words in order: equal for copies."""
    return pd.Series([hashlib.sha256(" ".join((text or "").lower().split()).encode("utf-8", "surrogatepass")).hexdigest() for text in texts], dtype=object)


def _marks(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to punctuation."""
    out = ASCII_MARK[data]
    for mark in WIDE_MARKS:
        at = np.flatnonzero(data[: len(data) - len(mark) + 1] == mark[0])
        for k, byte in enumerate(mark[1:], 1):
            at = at[data[at + k] == byte]
        for k in range(len(mark)):
            out[at + k] = True
    return out


class Terms:
    """Every term of a block of texts: its row, 64-bit hash and bytes.

    Terms are the lower-cased blank-separated chunks without punctuation at their ends, and the first four letters
    of longer ones (marked in the hash).  A term is told by its hash, so no task holds the vocabulary's strings.
    """

    def __init__(self, texts: pa.Array, poly: Poly, piece: int = 1 << 20) -> None:
        self.data, offs = text_buffer(pc.utf8_lower(texts.cast(pa.large_string())))
        start, end, at = words_of(self.data, offs)
        row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(at))
        mark = _marks(self.data) if len(start) else np.zeros(0, bool)
        odd = mark[start] | mark[end - 1]
        plain = np.flatnonzero(~mark)
        first, last = np.searchsorted(plain, start[odd]), np.searchsorted(plain, end[odd])
        some = first < last  # something is left between the marks
        bare = np.ones(len(start), bool)
        bare[odd] = some
        kept = np.flatnonzero(odd)[some]
        start[kept], end[kept] = plain[first[some]], plain[last[some] - 1] + 1
        start, end, row = start[bare], end[bare], row[bare]
        letter = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        place = np.flatnonzero((self.data & 0xC0) != 0x80)
        long = np.flatnonzero(letter[end] - letter[start] > 5)
        stem_end = place[letter[start[long]] + 4]
        word, stem = np.empty(len(start), U64), np.empty(len(long), U64)
        i = j = 0
        while i < len(start):  # prefix hashes of about ``piece`` bytes at a time
            k = max(i + 1, int(np.searchsorted(end, start[i] + piece, side="right")))
            base, m = start[i], int(np.searchsorted(long, k))
            prefix = poly.prefix(self.data[base : end[k - 1]].astype(U64) + U64(1))
            word[i:k] = poly.span(prefix, start[i:k] - base, end[i:k] - base)
            stem[j:m] = mix(poly.span(prefix, start[long[j:m]] - base, stem_end[j:m] - base) ^ U64(STEM))
            i, j = k, m
        self.hash = np.concatenate([word, stem])
        self.row = np.concatenate([row, row[long]])
        self.start, self.end, self.stems = np.concatenate([start, start[long]]), np.concatenate([end, stem_end]), len(stem)

    def name(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace") + "*" * (i >= len(self.hash) - self.stems)


class Vocabulary:
    """Sorted hashes with the place of each leading 20 bits: a lookup meets the few hashes that share them."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes
        self.first = np.searchsorted(hashes, np.arange((1 << 20) + 1, dtype=object).astype(U64)[:-1] << U64(44)).astype(np.int32)
        self.first = np.append(self.first, np.int32(len(hashes)))

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for those outside."""
        out, lead = np.full(len(h), -1, np.int32), (h >> U64(44)).astype(np.int64)
        at, stop = self.first[lead], self.first[lead + 1]
        left = np.flatnonzero(at < stop)
        at = at[left]
        while len(left):
            hit = self.hashes[at] == h[left]
            out[left[hit]] = at[hit]
            at = at + 1
            more = ~hit & (at < stop[left])
            left, at = left[more], at[more]
        return out

    def vectors(self, texts: pa.Array, poly: Poly) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first entry of each text, term numbers rising, counts)."""
        terms = Terms(texts, poly)
        number = self.numbers(terms.hash)
        known = number >= 0
        key, count = np.unique(terms.row[known] << 32 | number[known], return_counts=True)
        first = np.searchsorted(key >> 32, np.arange(len(texts) + 1))
        return first, (key & 0xFFFFFFFF).astype(np.int32), count.astype(np.int32)


def kept_vocabulary(key: str, hashes: np.ndarray) -> Vocabulary:
    """One vocabulary per Python worker."""
    kept = worker_store("toxicity").setdefault("toxic-terms", {})
    if kept.get("key") != key:
        kept.clear()
        kept |= {"key": key, "vocabulary": Vocabulary(hashes)}
    return kept["vocabulary"]


def with_vectors(rows: DataFrame, key: str, known, vectors: bool = True, block_bytes: int = 1 << 20) -> DataFrame:
    """``rows`` (their last column: the text) with the text's vector in its place: t (:func:`packed_terms`) and c
    (counts, one or four bytes each).  Besides, a row for each term a task met, with n, in how many texts.
    Without ``vectors``, a row a text that says no more than that it was there."""
    names = rows.columns[:-1]
    more = [("t", T.BinaryType()), ("c", T.BinaryType()), ("term", T.IntegerType()), ("n", T.LongType())]
    schema = T.StructType([*(T.StructField(c, rows.schema[c].dataType) for c in names), *(T.StructField(c, k) for c, k in more)])
    columns = [*names, *(c for c, _ in more)]

    def run(batches):
        vocabulary, poly = kept_vocabulary(key, known.value), Poly()
        texts, kinds, wide = np.zeros(len(vocabulary.hashes), np.int64), [], 3 if len(vocabulary.hashes) < 1 << 24 else 4
        for batch in batches:
            text = batch.column(len(names))
            kinds = [batch.column(i).type for i in range(len(names))]
            _, offs = text_buffer(text)
            for lo, hi in slices(offs, block_bytes):
                first, t, c = vocabulary.vectors(text.slice(lo, hi - lo), poly)
                texts += np.bincount(t, minlength=len(texts))
                if not vectors:
                    t, c, first = t[:0], c[:0], np.zeros(hi - lo + 1, np.int64)
                packed, c = packed_terms(t, first, wide), c.astype("<u1" if c.max(initial=0) < 1 << 8 else "<u4")
                ends = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
                cells = [pa.array([packed[x:y].T.tobytes() for x, y in ends], pa.binary()), pa.array([c[x:y].tobytes() for x, y in ends], pa.binary())]
                none = [pa.nulls(hi - lo, k) for k in (pa.int32(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(len(names))), *cells, *none], names=columns)
        met = np.flatnonzero(texts)
        for lo in range(0, len(met), 1 << 17):
            some = met[lo : lo + (1 << 17)]
            none = [pa.nulls(len(some), k) for k in (*kinds, pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(some, pa.int32()), pa.array(texts[some])], names=columns)

    return rows.mapInArrow(run, schema)


def packed_terms(t: np.ndarray, first: np.ndarray, wide: int) -> np.ndarray:
    """The ``wide`` low bytes of the gaps between a vector's rising term numbers, a row a term (transposed they compress)."""
    gap = np.diff(t, prepend=0)
    lead = first[:-1][first[:-1] < first[1:]]
    gap[lead] = t[lead]
    return gap.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :wide]


def unpacked(t: bytes, c: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and counts of a vector: gaps in three or four planes of bytes, counts of one or four bytes."""
    n = len(c) if len(t) >= 3 * len(c) else len(c) // 4
    gap = np.zeros((n, 4), np.uint8)
    wide = len(t) // n if n else 0
    gap[:, :wide] = np.frombuffer(t, np.uint8).reshape(wide, n).T
    return np.cumsum(gap.view("<u4")[:, 0], dtype=np.int64), np.frombuffer(c, "<u1" if len(c) == n else "<u4")


def weighted(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unit vector of counted terms."""
    w = (1 + np.log(counts)) * idf[terms]
    n = np.sqrt((w * w).sum())
    return terms, w / n if n else w


def weigh(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unit vector: term numbers in order, weights."""
    terms = np.array(sorted(counts), np.int64)
    return weighted(terms, np.array([counts[t] for t in terms.tolist()], np.float64), idf)


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (n of them), for each start."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def end_to_end(vectors: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each vector, terms, weights)."""
    first = np.concatenate([[0], np.cumsum([len(t) for t, _ in vectors])]).astype(np.int64)
    return first, np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)]).astype(np.int32), np.concatenate([np.zeros(0), *(w for _, w in vectors)])


class Examples:
    """Example vectors end to end; weights are made from counts when asked for, so the store stays small."""

    def __init__(self, first: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray) -> None:
        self.first, self.term, self.count, self.idf = first, term, count, idf
        self.norm = np.ones(len(first) - 1)
        for lo in range(0, len(first) - 1, 1024):
            hi = min(lo + 1024, len(first) - 1)
            e = np.arange(first[lo], first[hi])
            w = self.weight(e, np.zeros(len(e), np.int64))
            norm = np.sqrt(np.bincount(np.repeat(np.arange(hi - lo), np.diff(first[lo : hi + 1])), weights=w * w, minlength=hi - lo))
            self.norm[lo:hi] = np.where(norm > 0, norm, 1)

    def weight(self, e: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The weights of entries e, which are of vectors ``row``."""
        return (1 + np.log(self.count.take(e))) * self.idf.take(self.term.take(e)) / self.norm.take(row)


class Given(Examples):
    """Example vectors with their weights."""

    def __init__(self, vectors: list) -> None:
        self.first, self.term, self.given = end_to_end(vectors)

    def weight(self, e: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.given[e]


class BlockMaxIndex:
    """Inverted index over example vectors: postings of rare terms, dense rows of frequent ones with their block maxima.

    What the frequent terms can add to an example is bounded twice: by the block maxima (for all of a block) and by
    the norms of both dense parts (in groups of terms); only examples that may reach the k-th best have their dense
    part added, from one byte a weight, and only those within its error are computed exactly.
    """

    def __init__(self, vectors: list | Examples) -> None:
        self.all = vectors if isinstance(vectors, Examples) else Given(vectors)
        first, term = self.all.first, self.all.term
        self.n = len(first) - 1
        self.blocks = -(-self.n // BLOCK)
        self.width = width = int(term.max(initial=-1)) + 1
        count = np.bincount(term, minlength=width)
        dense = np.argsort(-count, kind="stable")[:DENSE]
        dense = dense[count[dense] > max(BLOCK, self.n // OFTEN)]
        self.place = np.full(width, -1, np.int32)
        self.place[dense] = np.arange(len(dense))
        count[dense] = 0
        self.start = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        self.row = np.zeros(self.start[-1], np.uint16 if self.n <= 1 << 16 else np.int32)
        self.post = np.zeros(self.start[-1], np.float32)
        top = np.zeros(len(dense))
        for lo in range(0, self.n, 16 * BLOCK):
            hi = min(lo + 16 * BLOCK, self.n)
            at = self.place[term[first[lo] : first[hi]]]
            e = np.flatnonzero(at >= 0)
            row = np.searchsorted(first[lo + 1 : hi + 1] - first[lo], e, side="right") + lo
            np.maximum.at(top, at[e], self.all.weight(e + first[lo], row))
        self.step = np.maximum(top, 1e-30) / 255
        self.by_row = np.zeros((self.blocks * BLOCK, len(dense)), np.uint8)
        self.most = np.zeros((self.blocks, len(dense)), np.float32)
        self.group = np.unique(np.linspace(0, len(dense), NORMS + 1).astype(np.int64)[:-1]) if len(dense) else np.zeros(0, np.int64)
        self.norm = np.zeros((self.blocks, BLOCK, len(self.group)))
        used = self.start[:-1].copy()
        for lo in range(0, self.n, BLOCK):  # a block of examples at a time
            hi = min(lo + BLOCK, self.n)
            e = np.arange(first[lo], first[hi])
            row = np.repeat(np.arange(lo, hi), np.diff(first[lo : hi + 1]))
            t, w = term[e], self.all.weight(e, row)
            at = self.place[t]
            some = at >= 0
            part = np.zeros((BLOCK, len(dense)), np.float32)
            part[row[some] - lo, at[some]] = w[some]
            self.by_row[lo : lo + BLOCK] = np.rint(part / self.step)
            self.most[lo // BLOCK] = part.max(0, initial=0)
            if len(dense):
                self.norm[lo // BLOCK] = np.sqrt(np.add.reduceat(part.astype(np.float64) ** 2, self.group, axis=1))
            t, row, w = t[~some], row[~some], w[~some]
            order = np.argsort(t, kind="stable")
            t, row, w = t[order], row[order], w[order]
            new = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
            many = np.diff(np.append(new, len(t)))
            spot = ranges(used[t[new]], many)
            self.row[spot], self.post[spot] = row, w
            used[t[new]] += many
        self.head = self.by_row.T
        self.at = np.zeros(width, np.int16)

    def vector(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        e = np.arange(self.all.first[i], self.all.first[i + 1])
        return self.all.term[e], self.all.weight(e, np.full(len(e), i))

    def nearest_of(self, queries: list, k: int, without: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """``nearest`` of each query."""
        without = without or [-1] * len(queries)
        return [self.nearest(t, w, k, x) for (t, w), x in zip(queries, without, strict=True)]

    def nearest(self, terms, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k best (cosine, example), largest first, ties to the smaller number; exact."""
        terms = np.asarray(terms, np.int64)
        if len(terms) and terms[-1] >= self.width:
            known = terms < self.width
            terms, weights = terms[known], weights[known]
        if not self.n or not len(terms):
            return []
        place = self.place[terms]
        some = place >= 0
        q = np.zeros(self.by_row.shape[1])
        q[place[some]] = weights[some]
        rare = terms[~some]
        start = self.start[rare]
        count = self.start[rare + 1] - start
        e = ranges(start, count)
        w = np.repeat(weights[~some], count)
        w *= self.post.take(e)
        sums = np.bincount(self.row.take(e), weights=w, minlength=self.blocks * BLOCK).astype(float, copy=False)
        if without >= 0:
            sums[without] = -np.inf
        peak = sums.reshape(self.blocks, BLOCK)
        first = peak.argmax(1) + np.arange(0, len(sums), BLOCK)
        tops = sums[first]
        # the dense parts lie in steps of 1 / 255 of a term's largest weight: this far off at most
        cols = np.flatnonzero(q)
        q8 = (q[cols] * self.step[cols]).astype(np.float32)
        off = float(q8.sum()) / 2 + SLACK
        # the k-th best of the examples that stand out in their blocks is a floor
        if len(first) > 4 * k:
            first = first[np.argpartition(tops, len(first) - 4 * k)[-4 * k :]]
        near = sums[first] + self._dense(first, cols, q8)
        floor = max(float(np.partition(near, len(near) - k)[len(near) - k]) - off, 1e-12) if len(near) >= k else 1e-12
        # blocks by their maxima, then examples by the norms of groups of terms
        more = self.most @ q.astype(np.float32) + np.float32(SLACK)
        live = np.flatnonzero(tops + more >= floor)
        bound = (self.norm.take(live, 0).reshape(-1, len(self.group)) @ np.sqrt(np.add.reduceat(q * q, self.group))).reshape(-1, BLOCK) if len(q) else np.zeros((len(live), BLOCK))
        np.minimum(bound, more[live][:, None], out=bound)
        bound += peak[live]
        bound = bound.ravel()
        at = np.flatnonzero(bound >= floor)
        if len(at) > FIRST:  # the examples of the largest bounds give a better floor
            bound = bound[at]
            best = np.argpartition(bound, len(at) - FIRST)[-FIRST:]
            ids = live[at[best] // BLOCK] * BLOCK + at[best] % BLOCK
            near = sums[ids] + self._dense(ids, cols, q8)
            at = at[bound >= max(floor, float(np.partition(near, FIRST - k)[FIRST - k]) - off)] if k <= FIRST else at
        ids = live[at // BLOCK] * BLOCK + at % BLOCK
        near = sums[ids] + self._dense(ids, cols, q8)
        least = np.partition(near, len(near) - k)[len(near) - k] if len(near) >= k else -1.0
        ids = ids[near >= least - 2 * off]
        if len(terms) > 32_000 and self.at.dtype == np.int16:  # a very long text
            self.at = self.at.astype(np.int32)
        self.at[terms] = np.arange(1, len(terms) + 1)
        cosine = self._exact(ids, weights)
        self.at[terms] = 0
        ids, cosine = ids[cosine > 0], np.round(cosine[cosine > 0], 9)
        rank = np.lexsort((ids, -cosine))[:k]
        return list(zip(cosine[rank].tolist(), ids[rank].tolist(), strict=True))

    def _dense(self, ids: np.ndarray, cols: np.ndarray, q8: np.ndarray) -> np.ndarray:
        """The dense part of the examples' cosines, from one byte a weight."""
        return self.by_row.take(ids, 0).take(cols, 1).astype(np.float32) @ q8

    def _exact(self, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The examples' cosines in double precision, added up in the order of their terms (``at``: the query's)."""
        first = self.all.first
        lo, hi = first[ids], first[ids + 1]
        at = np.concatenate([np.zeros(0, np.int16), *(self.at.take(self.all.term[a:b]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True))])
        hit = np.flatnonzero(at != 0)
        ends = np.cumsum(hi - lo)
        of = np.searchsorted(ends, hit, side="right")
        e = hit - (ends - (hi - lo))[of] + lo[of]
        return np.bincount(of, weights=weights[at[hit] - 1] * self.all.weight(e, ids[of]), minlength=len(ids))


def vote(best: list[tuple[float, int]], label: np.ndarray) -> float:
    w = np.array([1 / (1.05 - min(s, 1.0)) for s, _ in best])
    return float((w * label[[i for _, i in best]]).sum() / w.sum())


def isotonic(x: list[float], y: list[int]) -> tuple[list[float], list[float]]:
    """Monotone map from votes to label rates: pool adjacent violators, one pseudo-count each way per pool of 20."""
    pools: list[list[float]] = []
    for v, t in sorted(zip(x, y, strict=True)):
        pools.append([v, float(t), 1.0])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            v2, t2, n2 = pools.pop()
            pools[-1] = [(pools[-1][0] * pools[-1][2] + v2 * n2) / (pools[-1][2] + n2), pools[-1][1] + t2, pools[-1][2] + n2]
    return [p[0] for p in pools], [(p[1] + 0.05) / (p[2] + 0.1) for p in pools]


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of rows that labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, examples: int = 16384, shrink: float = 20.0, k: int = 9, calibrate: int = 2048, keep: tuple | None = ()) -> dict:
    """The model (bounded by the parameters), what the tasks share of it, and ``counted``: the documents' vectors beside
    ``keep`` (None: the vectors are not written)."""
    spark = docs.sparkSession
    usable = labels.filter("toxic is not null and doc_id is not null").filter(~held_out())
    usable = usable.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = usable.filter(thinned(F.col("id"), usable.count(), examples)).orderBy(F.xxhash64("id"), "id", "toxic").limit(examples)
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    sample = sample.select("id", "toxic", "text", F.pandas_udf(same_words, "string")("text").alias("words"))
    sample = sample.groupBy("words", "toxic").agg(F.min("id").alias("id"), F.min("text").alias("text"), F.count("*").alias("copies"))
    sample = saved(sample.repartition(16, "words"), "toxic-sample")
    total, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    none = np.zeros(0, np.int64)
    model = {"key": uuid.uuid4().hex, "hashes": np.zeros(0, np.uint64), "names": pa.array([], pa.string()), "idf": np.zeros(0), "first": np.zeros(1, np.int64), "term": none, "count": none, "label": np.zeros(0), "ids": [], "k": k}
    key = model["key"]

    def present(batches):
        poly = Poly()
        for b in batches:
            _, offs = text_buffer(b.column(0))
            toxic = b.column(1).to_numpy().astype(np.int64)
            for lo, hi in slices(offs, 1 << 20):
                terms = Terms(b.column(0).slice(lo, hi - lo), poly)
                order = np.lexsort((terms.row, terms.hash))
                h, row = terms.hash[order], terms.row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])  # each term of a text once
                h, row, order = h[new], row[new], order[new]
                lead = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
                n, hit = (np.add.reduceat(v, lead) if len(lead) else lead for v in (np.ones(len(h), np.int64), toxic[lo:hi][row]))
                yield pa.RecordBatch.from_arrays([pa.array(h[lead].view(np.int64)), pa.array(n), pa.array(hit), pa.array([terms.name(i) for i in order[lead].tolist()], pa.string())], names=["term", "n", "hit", "name"])

    seen = sample.select("text", "toxic").mapInArrow(present, "term long, n long, hit long, name string")
    seen = seen.groupBy("term").agg(F.sum("n").alias("n"), F.sum("hit").alias("hit"), F.min("name").alias("name")).toArrow()
    hashes = seen["term"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, n, hit = hashes[order], seen["n"].to_numpy()[order].astype(float), seen["hit"].to_numpy()[order].astype(float)
    names = seen["name"].combine_chunks().take(pa.array(order)) if len(order) else model["names"]
    p = float(toxic) / total if total else 0.0
    odds = np.log((hit + shrink * p) / (n - hit + shrink * (1 - p)) * (1 - p) / p) if 0 < p < 1 else np.zeros(len(hashes))
    known = spark.sparkContext.broadcast(hashes)

    # the documents' vectors are counted once, written, and read for the frequencies and for the scores
    text = F.col("text").cast("string").alias("tox_text")
    every = saved(with_vectors(docs.select(*(keep or ()), text), key, known, keep is not None), "toxic-vectors")
    model["counted"] = counted = every.filter("term is null").drop("term", "n")
    model["known"] = known
    if not total:
        return model | {"shared": spark.sparkContext.broadcast({k: v for k, v in model.items() if k not in ("counted", "known")}), "prior": 0.0, "map": ([0.0], [0.0])}
    held = np.zeros(len(hashes))
    df = every.filter("term is not null").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    held[df["term"].to_numpy()] = df["n"].to_numpy()
    idf = np.log(1 + counted.count() / (1 + held)) * (0.1 + odds * odds)
    del seen, df

    rows = with_vectors(sample.select("id", "toxic", "copies", "text"), key, known).filter("term is null").drop("term", "n").toArrow()
    some = pc.greater(pc.binary_length(rows["t"]), 0)
    copies, bad = (rows.filter(pc.invert(some))[c].to_numpy() for c in ("copies", "toxic"))
    first, term, count, ids, label = _ordered(rows.filter(some), idf)
    del rows
    model |= {"hashes": hashes, "names": names, "idf": idf, "first": first, "term": term, "count": count, "label": label, "ids": ids}
    model["shared"] = shared = spark.sparkContext.broadcast({k: v for k, v in model.items() if k not in ("counted", "known", "hashes")})
    some_rows = np.unique(np.linspace(0, max(len(ids) - 1, 0), min(calibrate, len(ids))).astype(int)).tolist()

    def votes(batches):
        m, index = shared.value, kept_index(shared.value)
        for b in batches:
            mine = [some_rows[i] for i in b["id"]]
            near = index.nearest_of([index.vector(i) for i in mine], m["k"], mine)
            yield pd.DataFrame([(vote(x, m["label"]), int(m["label"][i])) for i, x in zip(mine, near, strict=True) if x], columns=["vote", "toxic"])

    told = spark.range(0, len(some_rows), 1, 8).mapInPandas(votes, "vote double, toxic int").collect()
    curve = isotonic([r["vote"] for r in told], [r["toxic"] for r in told]) if told else ([0.0], [0.0])
    return model | {"prior": (float((copies * bad).sum()) + p) / (float(copies.sum()) + 1), "map": curve}


def _ordered(rows: pa.Table, idf: np.ndarray) -> tuple:
    """(first entries, terms, counts, ids, labels) of the examples, those alike in label and strongest term beside each other."""
    ids, toxic, vectors, rank = rows["id"].to_pylist(), rows["toxic"].to_pylist(), [], []
    for i, (t, c) in enumerate(zip(rows["t"], rows["c"], strict=True)):
        terms, counts = unpacked(t.as_py(), c.as_py())
        vectors.append((terms.astype(np.int32), counts.astype(np.uint16 if counts.max() < 1 << 16 else np.int32)))
        w = (1 + np.log(counts)) * idf[terms]
        rank.append((toxic[i], int(terms[np.argmax(w)]), ids[i], hashlib.sha256(t.as_py() + counts.astype("<u4").tobytes()).digest(), i))
    order = [x[-1] for x in sorted(rank)]
    first = np.concatenate([[0], np.cumsum([len(vectors[i][0]) for i in order])]).astype(np.int64)
    term = np.concatenate([np.zeros(0, np.int32), *(vectors[i][0] for i in order)])
    count = np.concatenate([np.zeros(0, np.uint16), *(vectors[i][1] for i in order)])
    return first, term, count, [ids[i] for i in order], np.array([float(toxic[i]) for i in order])


def made_index(model: dict) -> BlockMaxIndex:
    return BlockMaxIndex(Examples(model["first"], model["term"], model["count"], model["idf"]))


def taken_index(model: dict) -> BlockMaxIndex:
    """The model's index, out of the worker's store if it is there."""
    kept = worker_store("toxicity").pop("toxic-index", {})
    return kept["index"] if kept.get("key") == model["key"] else made_index(model)


def kept_index(model: dict) -> BlockMaxIndex:
    """The model's index, built once per Python worker."""
    kept = worker_store("toxicity").setdefault("toxic-index", {})
    if kept.get("key") != model["key"]:
        kept.clear()
        kept |= {"key": model["key"], "index": made_index(model)}
    return kept["index"]


class Scorer:
    """Scores of a worker's documents."""

    def __init__(self, model: dict, prior: float, curve: tuple, index: BlockMaxIndex) -> None:
        self.m, self.prior, self.curve, self.index = model, prior, curve, index

    def __call__(self, t: np.ndarray, c: np.ndarray) -> tuple[float, list, np.ndarray]:
        """(score, nearest examples, the terms that weigh most)."""
        terms, weights = weighted(t, c, self.m["idf"])
        best = self.index.nearest(terms, weights, self.m["k"])
        s = float(np.interp(vote(best, self.m["label"]), *self.curve)) if best else self.prior
        return min(max(s, 0.0), 1.0), best, terms[np.argsort(-weights, kind="stable")[:SHOWN]]


def scored(counted: DataFrame, model: dict) -> DataFrame:
    """``counted`` (its last columns: t and c) with score, neighbours (example ids), similarity and terms (the evidence) in their place."""
    shared, prior, curve = model["shared"], model["prior"], model["map"]
    names = counted.columns[:-2]
    fields = [counted.schema[c] for c in names]
    schema = T.StructType(fields + [T.StructField("score", T.DoubleType()), T.StructField("neighbours", T.ArrayType(T.LongType())),
                                    T.StructField("similarity", T.ArrayType(T.DoubleType())), T.StructField("terms", T.ArrayType(T.StringType()))])

    def run(batches):
        m = shared.value
        scorer, ids = Scorer(m, prior, curve, kept_index(m)), np.array(m["ids"], np.int64)
        for batch in batches:
            score, near, shown, known = [], [], [], {}
            for same in zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True):
                if same not in known:  # copies score alike
                    known[same] = scorer(*unpacked(*same))
                s, best, strongest = known[same]
                score.append(s)
                near.append(best)
                shown.append(strongest)
            kept = [batch.column(i) for i in range(len(names))]
            ends = [pa.array(np.concatenate([[0], np.cumsum([len(x) for x in some])]).astype(np.int32)) for some in (near, shown)]
            flat = [x for best in near for x in best]
            evidence = m["names"].take(pa.array(np.concatenate([np.zeros(0, np.int64), *shown])))
            lists = [
                pa.ListArray.from_arrays(ends[0], pa.array(ids[[i for _, i in flat]] if flat else ids[:0])),
                pa.ListArray.from_arrays(ends[0], pa.array([s for s, _ in flat], pa.float64())),
                pa.ListArray.from_arrays(ends[1], evidence),
            ]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score, pa.float64()), *lists], names=[f.name for f in schema])

    return counted.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """Every document: doc_id, held_out, score, predicted, and the evidence."""
    model = fit(docs, labels, keep=("doc_id",), **params)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored(model["counted"], model).select("doc_id", held_out().alias("held_out"), "score", predicted, "neighbours", "similarity", "terms")


def keep_clean(docs: DataFrame, labels: DataFrame, below: float = 0.5, **params) -> DataFrame:
    """The documents whose score is below ``below``, with all their columns.

    Terms are counted again where a document is judged, so nothing of the documents is written; a task makes its own
    index and leaves nothing behind in its worker.
    """
    model = fit(docs, labels, keep=None, **params)
    known, shared, prior, curve = model["known"], model["shared"], model["prior"], model["map"]
    del model  # the driver keeps nothing of it: the tasks read the broadcasts
    give_back()

    @F.arrow_udf("boolean")
    def clean(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary, poly = Vocabulary(known.value), Poly()
        scorer = Scorer(shared.value, prior, curve, taken_index(shared.value))
        for text in parts:
            out = []
            _, offs = text_buffer(text)
            for lo, hi in slices(offs, 1 << 20):
                first, t, c = vocabulary.vectors(text.slice(lo, hi - lo), poly)
                out += [scorer(t[x:y], c[x:y])[0] < below for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            yield pa.array(out, pa.bool_())

    return docs.filter(clean(F.col("text").cast("string")))
