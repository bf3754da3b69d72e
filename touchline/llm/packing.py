"""Best-fit packing into fixed-size sequences by linear grouping.

1. Tokenise whole texts in Arrow batches (each distinct blank-separated chunk
   once per worker), append the end id, cut documents longer than the capacity.
2. Pieces of one length are interchangeable, so the plan is made on the
   histogram of lengths: at most ``capacity`` numbers, whatever the corpus.
3. Linear grouping: the large lengths (over capacity / ``small``) in sorted
   order are cut into ``groups`` groups of equal cardinality, each rounded up
   to its largest.  The configuration program over those few sizes is solved by
   column generation (knapsack pricing); the fractional solution is rounded
   down, what is left is packed best-fit decreasing.
4. Actual documents replace the rounded ones, which only frees room.  Small
   lengths then go, longest first, into the fullest sequences they fit.
5. Every piece gets its number among those of its length by per-bucket counts
   (no length is gathered in one task) and looks its sequence up in the plan.

The plan has a few entries per distinct length and is broadcast; its size is
bounded by the capacity, not by the corpus.  Null texts are empty: such a
document is the end id alone, one piece of length 1.  Repeated rows are packed
each; which of equal rows sits where is not told apart.  Empty tables give an
empty result.  Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.common import saved, shuffle_parts, worker_store

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, slot int"
PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("slot", pa.int32())])
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
PLACED_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


class ChunkEncoder:
    """Token ids of texts; every distinct blank-separated chunk is encoded once per worker.

    The tokenizer's pre-tokenizer drops white space and no token spans it, so a
    text's ids are those of its chunks in order.  Its normalizer lower-cases,
    and letters and a closing mark are separate pre-tokens: a chunk of Latin
    letters (with such a mark) is its lower-cased word's pieces (and the
    mark's).  All other chunks go through the whole tokenizer.  The store is
    emptied beyond ``most`` chunks (a memory bound, not a limit on texts).
    """

    def __init__(self, tokenizer, most: int = 1_000_000) -> None:
        self.tokenizer, self.model, self.most = tokenizer, tokenizer.model, most
        # letters as the byte-level pre-tokenizer writes them: bytes outside the printable ranges move up by 256
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [x for x in range(256) if x not in set(printable)]
        self.bytes = {x: x for x in printable} | {x: 256 + k for k, x in enumerate(moved)}
        self.marks = {m: tokenizer.encode(m, add_special_tokens=False).ids for m in ".,;:!?"}
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.start, self.length, self.ids = array("q", [0]), array("q", [0]), array("I")

    def _put(self, chunk: str, start: int, length: int) -> int:
        at = self.number[chunk] = len(self.start)
        self.start.append(start)
        self.length.append(length)
        return at

    def _learn(self, chunk: str) -> int:
        """The number of an unknown chunk."""
        mark = self.marks.get(chunk[-1])
        bare = chunk[:-1] if mark else chunk
        if not (bare.isalpha() and max(bare) < "\u0250" and "\u0130" not in bare):
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            self.ids.extend(ids)
            return self._put(chunk, len(self.ids) - len(ids), len(ids))
        word = bare.lower()
        at = self.number.get(word)
        if at is None:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.bytes)
            ids = [t.id for t in self.model.tokenize(shown)]
            at = self._put(word, len(self.ids), len(ids))
            self.ids.extend(ids)
            self.ids.extend(self.marks["."])  # so that the word with a full stop lies there too
        if chunk == word:
            return at
        start, length = self.start[at], self.length[at]
        if mark and chunk[-1] != ".":
            ids = self.ids[start : start + length]
            start = len(self.ids)
            self.ids.extend(ids)
            self.ids.extend(mark)
        return self._put(chunk, start, length + (len(mark) if mark else 0))

    def encode(self, text: str) -> np.ndarray:
        if len(self.start) > self.most:
            self.clear()
        chunks = text.replace("\n", " ").split(" ")
        number = self.number
        try:
            at = np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))
        except KeyError:
            for c in chunks:
                if c not in number:
                    self._learn(c)
            at = np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))
        start, n = np.frombuffer(self.start, np.int64)[at], np.frombuffer(self.length, np.int64)[at]
        spot = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.frombuffer(self.ids, np.uint32)[spot] if len(spot) else np.zeros(0, np.uint32)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, slots: int = 64) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, crc of its ids (and a slot that spreads equal lengths)."""

    def run(batches):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept = worker_store("packing")
        if tokenizer_path not in kept:
            kept[tokenizer_path] = ChunkEncoder(Tokenizer.from_file(tokenizer_path))
        encoder = kept[tokenizer_path]
        for batch in batches:
            out = [[], [], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encoder.encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for piece, lo in enumerate(range(0, len(ids), capacity)):
                    part = ids[lo : lo + capacity]
                    crc = zlib.crc32(part.tobytes())
                    for col, v in zip(out, (doc, piece, lo, len(part), crc, (crc ^ (doc or 0)) % slots), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, PIECES_ARROW, strict=True)], schema=PIECES_ARROW)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


# --- the plan, on the histogram of lengths --------------------------------


def best_filled(size: np.ndarray, price: np.ndarray, capacity: int) -> tuple[list[int], float]:
    """The content of one sequence of the largest total price, by number of items (large items: few)."""
    value, choices = np.zeros(capacity + 1), []
    for _ in range(capacity // int(size.min())):
        more, choice = value.copy(), np.full(capacity + 1, -1)
        for i, s in enumerate(size):
            gain = np.full(capacity + 1, -1.0)
            gain[s:] = value[: capacity + 1 - s] + price[i]
            better = gain > more + 1e-12
            more[better], choice[better] = gain[better], i
        value = more
        choices.append(choice)
    new, c = [0] * len(size), capacity
    for choice in reversed(choices):
        if choice[c] >= 0:
            new[choice[c]] += 1
            c -= int(size[choice[c]])
    return new, float(value[capacity])


def solve_configurations(sizes: list[int], counts: list[int], capacity: int, turns: int = 400) -> list[tuple[tuple[int, ...], float]]:
    """Fractional minimum number of sequences for ``counts`` items of few ``sizes``: column generation.

    Returns [(items of each size in one sequence, number of such sequences)].
    """
    m = len(sizes)
    need = np.array(counts, float)
    size = np.array(sizes)
    basis = [tuple(capacity // sizes[i] if j == i else 0 for j in range(m)) for i in range(m)]
    x = np.array([need[i] / basis[i][i] for i in range(m)])
    for _ in range(turns):
        b = np.array(basis, float).T
        price = np.linalg.solve(b.T, np.ones(m))
        new, value = best_filled(size, price, capacity)
        if value <= 1 + 1e-9:
            break
        step = np.linalg.solve(b, np.array(new, float))
        ratio = np.where(step > 1e-12, x / np.where(step > 1e-12, step, 1), np.inf)
        leave = int(np.argmin(ratio))
        x = x - ratio[leave] * step
        x[leave] = ratio[leave]
        basis[leave] = tuple(new)
    return [(p, float(n)) for p, n in zip(basis, x, strict=True) if n > 1e-9]


class Sequences:
    """Kinds of partly filled sequences: (room, {content: count}), kept by room."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.by_room: dict[int, dict[tuple, int]] = {}

    def add(self, content: tuple, count: int) -> None:
        if count:
            kind = self.by_room.setdefault(self.capacity - sum(content), {})
            kind[content] = kind.get(content, 0) + count

    def best_fit(self, length: int, count: int) -> None:
        """Put ``count`` items of ``length`` each into the fullest sequence with room, new ones last."""
        while count:
            room = min((r for r in self.by_room if r >= length), default=None)
            if room is None:
                per = self.capacity // length
                self.add((length,) * per, count // per)
                self.add((length,) * (count % per), 1 if count % per else 0)
                return
            kinds = self.by_room[room]
            content, there = next(iter(kinds.items()))
            per = room // length
            full = min(there, count // per)
            if full:
                kinds[content] -= full
                self.add(content + (length,) * per, full)
                count -= full * per
            if count and count < per and kinds.get(content):
                kinds[content] -= 1
                self.add(content + (length,) * count, 1)
                count = 0
            if not kinds.get(content):
                kinds.pop(content, None)
            if not kinds:
                self.by_room.pop(room, None)


def plan_sequences(histogram: dict[int, int], capacity: int, groups: int = 24, small: int = 8) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths in one sequence, number of such sequences)] for all items of the histogram."""
    seqs = Sequences(capacity)
    lengths = sorted(histogram, reverse=True)
    large = [n for n in lengths if capacity // small < n < capacity]
    if capacity in histogram:
        seqs.add((capacity,), histogram[capacity])
    total = sum(histogram[n] for n in large)
    if total:
        # Groups of equal cardinality over the sorted large items, as runs (length, count).
        groups = min(groups, total)
        ends = [total * (g + 1) // groups for g in range(groups)]
        runs, g, seen = [[] for _ in range(groups)], 0, 0
        for n in large:
            left = histogram[n]
            while left:
                take = min(left, ends[g] - seen)
                runs[g].append([n, take])
                seen, left = seen + take, left - take
                if seen == ends[g] and g < groups - 1:
                    g += 1
        sizes: list[int] = []
        pools: list[list] = []
        for r in runs:  # equal rounded sizes are one size
            if sizes and sizes[-1] == r[0][0]:
                pools[-1] += r
            else:
                sizes.append(r[0][0])
                pools.append(r)
        counts = [sum(k for _, k in p) for p in pools]
        for pattern, number in sorted(solve_configurations(sizes, counts, capacity), reverse=True):
            todo = int(number + 1e-6)
            slots = [g for g, k in enumerate(pattern) for _ in range(k)]
            while todo:  # actual documents, as long as each slot's run lasts
                take, content, used = todo, [], []
                for g in slots:
                    if not pools[g]:
                        take = 0
                        break
                    content.append(pools[g][0][0])
                    used.append(g)
                for g in set(used):
                    take = min(take, pools[g][0][1] // used.count(g)) if pools[g] else 0
                if take == 0:
                    take, content = _one(pools, slots)
                    if not content:
                        break
                else:
                    for g in used:
                        pools[g][0][1] -= take
                for p in pools:
                    while p and p[0][1] == 0:
                        p.pop(0)
                seqs.add(tuple(content), take)
                todo -= take
        rest: dict[int, int] = {}
        for n, k in (run for p in pools for run in p):
            rest[n] = rest.get(n, 0) + k
        for n in sorted(rest, reverse=True):
            seqs.best_fit(n, rest[n])
    for n in lengths:
        if n <= capacity // small and n != capacity:
            seqs.best_fit(n, histogram[n])
    return [(content, k) for kinds in seqs.by_room.values() for content, k in kinds.items() if k and content]


def _one(pools: list[list], slots: list[int]) -> tuple[int, list[int]]:
    """One sequence whose slots take documents of a group's next lengths in turn."""
    content = []
    for g in slots:
        while pools[g] and pools[g][0][1] == 0:
            pools[g].pop(0)
        if pools[g]:
            pools[g][0][1] -= 1
            content.append(pools[g][0][0])
    return 1, content


def plan_tables(plan: list[tuple[tuple[int, ...], int]], capacity: int):
    """For each length its runs in rank order: first rank, first sequence, items per sequence, first offset."""
    length, count, first_seq, per, offset = [], [], [], [], []
    seq = 0
    for content, k in plan:
        at, i = 0, 0
        while i < len(content):
            j = i
            while j < len(content) and content[j] == content[i]:
                j += 1
            length.append(content[i])
            count.append(k * (j - i))
            first_seq.append(seq)
            per.append(j - i)
            offset.append(at)
            at += content[i] * (j - i)
            i = j
        seq += k
    cols = [np.array(c, np.int64) for c in (length, count, first_seq, per, offset)]
    order = np.argsort(cols[0], kind="stable")
    length, count, first_seq, per, offset = (c[order] for c in cols)
    before = np.cumsum(count) - count
    first_of = np.searchsorted(length, np.arange(capacity + 2))
    rank = before - (before[first_of[length]] if len(length) else before)
    return first_of, rank, first_seq, per, offset


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, groups: int = 24, small: int = 8) -> DataFrame:
    """One row per piece with its sequence and its offset there (offsets are gapless from 0)."""
    spark = docs.sparkSession
    slots = 2 * shuffle_parts(spark)
    cut = saved(pieces(docs, tokenizer_path, capacity, end_id, slots), "pack-pieces")
    per_slot = cut.groupBy("length", "slot").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    tables = spark.sparkContext.broadcast(plan_tables(plan_sequences(histogram, capacity, groups, small), capacity))
    # slots x distinct lengths rows at most; every group of a window is one length's slots.
    w = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    base = per_slot.select("length", "slot", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "slot").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("row", F.row_number().over(inside)).join(base, ["length", "slot"])

    def place(batches):
        first_of, rank, first_seq, per, offset = tables.value
        for b in batches:
            length, at = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (3, 5))
            # a run of this length: the last whose first rank is not above the piece's rank
            lo, hi = first_of[length], first_of[length + 1]
            while True:
                mid = (lo + hi) // 2
                go = hi - lo > 1
                if not go.any():
                    break
                up = go & (rank[np.minimum(mid, len(rank) - 1)] <= at)
                lo, hi = np.where(up, mid, lo), np.where(go & ~up, mid, hi)
            k = at - rank[lo]
            seq, off = first_seq[lo] + k // per[lo], offset[lo] + (k % per[lo]) * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)], schema=PLACED_ARROW)

    numbered = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("row") - 1 + F.col("base")).alias("rank"))
    return numbered.mapInArrow(place, PLACED)
