"""Shared helpers: tables, scratch tables, text buffers, hashing, the block exchange."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import written

U64 = np.uint64
#: Odd multipliers of the polynomial and mixing hashes (fixed values).
POLY = 0x9E3779B97F4A7C15
MIX_A = 0xFF51AFD7ED558CCD
MIX_B = 0xC4CEB9FE1A85EC53
#: Word separators of the contracts: blank and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: short lineage, one copy for all (removed when the program ends)."""
    return written(df, f"llm-{name}")


def worker_store(owner: str) -> dict:
    """A dict that lives as long as the Python worker (functions are unpickled anew for each task).

    One operator's at a time: a worker that goes on with another's tasks lets the last one's go and hands its memory back.
    """
    holder = sys.modules.setdefault("_touchline_worker_store", types.ModuleType("_touchline_worker_store"))
    if (last := holder.__dict__.get("owner")) != owner:
        holder.__dict__.update(owner=owner, kept={})
        if last is not None:
            give_back()
    return holder.__dict__["kept"]


def give_back() -> None:
    """Hand memory that is free by now back to the system (after a model was fitted on the driver, or a worker let one go)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def text_id() -> Column:
    """A content id of the text; with doc_id it names a row (identical rows share it)."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def thinned(key: Column, rows: int | Column, size: int) -> Column:
    """True for about ``4 * size`` of ``rows`` rows by their key's hash (all, if there are fewer).

    An ordered limit after it takes its rows from a set of bounded size, however many tasks read the table.
    """
    share = F.lit(float(4 * size << 20)) / (rows if isinstance(rows, Column) else F.lit(float(max(rows, 1))))
    return F.pmod(F.xxhash64(F.lit(11), key), F.lit(1 << 20)) < share


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (wrap-around arithmetic)."""
    h = h ^ (h >> U64(33))
    h = h * U64(MIX_A)
    h = h ^ (h >> U64(29))
    h = h * U64(MIX_B)
    return h ^ (h >> U64(32))


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow text column end to end, and the offsets of its rows (null: empty)."""
    a = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    a = a.cast(pa.large_binary())
    if a.null_count:
        a = a.fill_null(b"")
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = a.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(bufs[2], np.uint8)[offs[0] : offs[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def slices(offs: np.ndarray, most: int):
    """Row ranges of about ``most`` bytes (one row may be longer)."""
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi
        lo = hi


class Poly:
    """Polynomial prefix hashes modulo 2**64: the hash of any span in O(1), whatever its place."""

    def __init__(self) -> None:
        self.n = 0
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        base, inv = U64(POLY), U64(pow(POLY, -1, 1 << 64))
        self.up = np.cumprod(np.concatenate([[U64(1)], np.full(n, base)]), dtype=U64)
        self.down = np.cumprod(np.concatenate([[U64(1)], np.full(n, inv)]), dtype=U64)
        self.n = n

    def prefix(self, values: np.ndarray) -> np.ndarray:
        if len(values) > self.n:
            self._grow(max(len(values), 2 * self.n))
        out = np.empty(len(values) + 1, U64)
        out[0] = 0
        np.cumsum(values.astype(U64) * self.up[: len(values)], out=out[1:])
        return out

    def span(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.down[start])


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, poly: Poly, piece: int = 1 << 20) -> np.ndarray:
    """Hash of every span [start, end) of the bytes (spans in order, none overlapping), about ``piece`` bytes at a time."""
    out = np.empty(len(start), U64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + piece, side="right")))
        base = start[i]
        prefix = poly.prefix(data[base : end[j - 1]].astype(U64) + U64(1))
        out[i:j] = poly.span(prefix, start[i:j] - base, end[i:j] - base)
        i = j
    return out


def words_of(data: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of the rows, and the number of words before each row.

    Words are runs of bytes other than 0x20 and 0x09-0x0D and never cross rows.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    is_word = ~blank
    first = is_word.copy()
    first[1:] &= blank[:-1]
    cuts = offs[:-1][(offs[:-1] < len(data))]
    first[cuts] = is_word[cuts]
    last = is_word.copy()
    last[:-1] &= blank[1:]
    ends = offs[1:][offs[1:] > 0] - 1
    last[ends] = is_word[ends]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offs)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased (ASCII only)."""
    out = data.copy()
    upper = (out >= 65) & (out <= 90)
    out[upper] += 32
    return out


def sliding_argmin(values: np.ndarray, w: int) -> np.ndarray:
    """Position of the smallest value in each window of ``w`` (leftmost of equals).

    Only the top 40 bits of a value count; the low 24 carry the place, so the
    caller keeps arrays below 2**24 entries.
    """
    n = len(values)
    if n < w:
        return np.zeros(0, np.int64)
    v = (values & ~U64(0xFFFFFF)) | np.arange(n, dtype=U64)
    pad = -n % w
    full = np.concatenate([v, np.full(pad, ~U64(0))]).reshape(-1, w)
    left = np.minimum.accumulate(full, axis=1).ravel()
    right = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    out = np.minimum(right[: n - w + 1], left[w - 1 : n])
    return (out & U64(0xFFFFFF)).astype(np.int64)


# --- block exchange ------------------------------------------------------
# Map tasks cut their rows into blocks and send each block's 64-bit keys, in
# sorted byte planes, to hash buckets; a bucket sees every occurrence of its
# keys and answers the blocks.  It is a counting shuffle of about six bytes a
# key instead of one row a key.

EXCHANGE = "bucket long, block long, kind int, payload binary"
ANSWER = "block long, kind int, payload binary"
EXCHANGE_ARROW = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
ANSWER_ARROW = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
KEYS, BLOCK = 0, 1


def planes(*arrays: np.ndarray) -> bytes:
    """Unsigned 64-bit arrays of one length as byte planes (empty planes left out)."""
    n = len(arrays[0])
    parts = [np.array([n], "<u8").tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a, "<u8")
        k = (int(a.max()).bit_length() + 7) // 8 if n else 0
        parts += [bytes([k]), np.ascontiguousarray(a.view(np.uint8).reshape(n, 8)[:, :k].T).tobytes()]
    return b"".join(parts)


def unplanes(blob: bytes) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(blob, "<u8", 1)[0]), 8, []
    while at < len(blob):
        k = blob[at]
        a = np.zeros((n, 8), np.uint8)
        a[:, :k] = np.frombuffer(blob, np.uint8, k * n, at + 1).reshape(k, n).T
        out.append(a.reshape(-1).view("<u8"))
        at += 1 + k * n
    return out


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the (uniform) keys: the leading bytes of a bucket's sorted keys are nearly constant."""
    return (((keys >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)


def send(keys: np.ndarray, refs: np.ndarray, buckets: int, block: int, more: np.ndarray | None = None):
    """One row for each bucket that gets some of a block's keys, sorted by key; ``more`` goes along."""
    with_more = [] if more is None else [more]
    to = bucket_of(keys, buckets)
    order = np.lexsort((keys, to))
    keys, refs, to, with_more = keys[order], refs[order], to[order], [m[order] for m in with_more]
    cuts = np.flatnonzero(np.diff(to)) + 1
    for lo, hi in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(to)]]), strict=True):
        if hi > lo:
            yield int(to[lo]), block, KEYS, planes(keys[lo:hi], refs[lo:hi], *(m[lo:hi] for m in with_more))


def opened_rows(src: DataFrame, told: DataFrame, column: str) -> DataFrame:
    """``src`` rows (doc_id, text_id, text) that ``told`` names, each once, with ``column``.

    Repeated rows have equal entries, so the entries are one a (doc_id, text_id) before the join: m copies stay m rows.
    """
    one = told.groupBy(F.col("doc_id").alias("c_doc"), F.col("text_id").alias("c_text")).agg(F.max(column).alias(column))
    both = src.join(one, src["doc_id"].eqNullSafe(one["c_doc"]) & (src["text_id"] == one["c_text"]))
    return both.select("doc_id", "text_id", "text", column)


def rows_batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def repeated_entries(hot: int):
    """A bucket's answer to each block: the refs of keys that occur at least twice, and whether ``hot`` times or more."""

    def run(rows: pa.Table) -> pa.Table:
        cells = list(zip(rows["block"].to_pylist(), rows["kind"].to_pylist(), rows["payload"].to_pylist(), strict=True))
        out = [c for c in cells if c[1] != KEYS]  # block rows pass on
        mine = [(b, unplanes(x)) for b, k, x in cells if k == KEYS]
        if mine:
            keys = np.concatenate([x[0] for _, x in mine])
            order = np.argsort(keys, kind="stable")
            ranked = keys[order]
            first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            size = np.diff(np.append(first, len(keys)))
            count = np.empty(len(keys), np.int64)
            count[order] = np.repeat(size, size)
            at = 0
            for b, x in mine:
                n = count[at : at + len(x[0])]
                at += len(x[0])
                hit = n > 1
                if hit.any():
                    out.append((b, KEYS, planes(x[1][hit], (n[hit] >= hot).astype(U64))))
        return pa.Table.from_batches([rows_batch(out, ANSWER_ARROW)])

    return run


def block_row(block: int, buckets: int, doc_ids, ids: np.ndarray, starts: np.ndarray):
    """A block's own table (doc_id or null, text id, where the rows start): it passes a bucket unread."""
    null = np.asarray(doc_ids.is_null())
    plain = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
    blob = planes(plain.view("<u8"), null.astype("<u8"), ids.astype("<i8").view("<u8"), starts.astype("<u8"))
    return block % buckets, block, BLOCK, blob


def read_block(blob: bytes):
    doc, null, ids, starts = unplanes(blob)
    return doc.view("<i8"), null.astype(bool), ids.view("<i8"), starts.astype(np.int64)


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """Connected components of the edges: (node, comp), comp the smallest node reachable.

    Labels travel along the edges and are shortened by pointer jumping; each
    round is written to the shared folder.  Hot nodes: every join has plain
    shuffles on both sides (adaptive execution splits them) and every group is
    a minimum with partial aggregation.
    """
    both = saved(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(F.col(b), F.col(a))), f"{name}-edges")
    labels = saved(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("comp")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        told = both.join(labels, both.u == labels.node).select(F.col("v").alias("node"), "comp")
        low = saved(labels.union(told).groupBy("node").agg(F.min("comp").alias("comp")), f"{name}-{turn}a")
        roots = low.select(F.col("node").alias("r"), F.col("comp").alias("up"))
        jumped = saved(low.join(roots, low.comp == roots.r).select("node", F.least("comp", "up").alias("comp")), f"{name}-{turn}b")
        changed = jumped.join(labels.select("node", F.col("comp").alias("was")), "node").filter("comp <> was").limit(1).count()
        labels = jumped
        if not changed:
            return labels
