"""Repeated token windows by Rabin-Karp hashes, counted in Spark; first occurrences stay.

1. Every text's words are hashed where it lies.  Each window of ``window``
   words picks the leftmost smallest hash of its 8-word sequences; equal windows
   pick equal ones.  A block exchange counts the picked sequences: a window
   whose sequence occurs once is unique and needs no row of its own (a hash
   only ever keeps too much).
2. The other windows get their rolling (Rabin-Karp) hash.  Each task keeps the
   first occurrence of each hash; what comes later in the task is decided
   there.  A second exchange brings each hash's first occurrences together: all
   but the smallest (doc_id, start) are repeats.
3. Repeated windows merge into maximal word intervals per document, which are
   removed where the text lies.

A window goes when its word sequence also starts earlier: in a smaller doc_id,
or earlier in the document.  Null texts have no words.  Null doc_ids come after
all others and count as one document; so do rows of equal doc_id (repeated rows
get equal results).  Texts are read whole.  Only doc_id and text are read.
Empty tables give empty results.  Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import (
    ANSWER, ANSWER_ARROW, BLOCK, EXCHANGE, EXCHANGE_ARROW, KEYS, POLY, U64, Poly, block_row, bucket_of, mix, opened_rows, planes, read_block,
    repeated_entries, rows_batch, saved, send, shuffle_parts, sliding_argmin, slices, span_hashes, text_buffer, text_id, unplanes, words_of, worker_store,
)
from touchline.llm.suffix_dedup import SPANS, SPANS_ARROW, _union, _with_spans, merged_spans

INNER = 8
WINDOWS = 2
CELLS = "doc_id long, text_id long, runs binary"
CELLS_ARROW = pa.schema([("doc_id", pa.int64()), ("text_id", pa.int64()), ("runs", pa.binary())])
LAST = ~U64(0)


def word_hashes(data: np.ndarray, offs: np.ndarray, poly: Poly) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of the rows, and the number of words before each row."""
    start, end, at = words_of(data, offs)
    if not len(start):
        return np.zeros(0, U64), at
    return span_hashes(data, start, end, poly), at


def rolling(w: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive words (by prefix sums; wrap-around arithmetic)."""
    if len(w) < size:
        return np.zeros(0, U64)
    h = np.zeros(len(w) - size + 1, U64)
    for k in range(size):
        h = h * U64(POLY) + w[k : len(w) - size + 1 + k]
    return mix(h)


def _scan(buckets: int, window: int, most: int):
    def run(batches):
        from pyspark import TaskContext

        worker_store("substring")  # what another operator kept in this worker goes

        poly, block = Poly(), TaskContext.get().partitionId() << 24
        for batch in batches:
            data, offs = text_buffer(batch.column(2))
            for lo, hi in slices(offs, most):
                part = offs[lo : hi + 1]
                w, at = word_hashes(data[part[0] : part[-1]], part - part[0], poly)
                if len(w) < window:
                    continue
                inner = rolling(w, INNER)
                firsts, counts, keys = [], [], []
                ends = at[1:]
                for base in range(0, len(w) - window + 1, 4 << 20):  # places fit 24 bits
                    piece = inner[base : base + (4 << 20) + window - INNER]
                    p = sliding_argmin(piece, window - INNER + 1) + base
                    s = np.arange(len(p)) + base
                    ok = s + window <= ends[np.searchsorted(at, s, side="right") - 1]
                    s, p = s[ok], p[ok]
                    if len(s):
                        new = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] != s[:-1] + 1)]))
                        firsts.append(s[new])
                        counts.append(np.diff(np.append(new, len(s))))
                        keys.append(inner[p[new]])
                if not firsts:
                    continue
                block += 1
                a, n, k = (np.concatenate(x) for x in (firsts, counts, keys))
                texts = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                out = [block_row(block, buckets, batch.column(0).slice(lo, hi - lo), texts, at[:-1])]
                out += send(k, (a.astype(U64) << U64(5)) | n.astype(U64), buckets, block)
                for i in range(0, len(out), 64):
                    yield rows_batch(out[i : i + 64], EXCHANGE_ARROW)

    return run


def _open_runs(rows: pa.Table) -> pa.Table:
    """A block: the runs of windows that may be repeated, per document."""
    kinds, blobs = rows["kind"].to_pylist(), rows["payload"].to_pylist()
    told = [unplanes(x)[0] for k, x in zip(kinds, blobs, strict=True) if k == KEYS]
    out = []
    if told:
        doc, null, texts, starts = read_block(next(x for k, x in zip(kinds, blobs, strict=True) if k == BLOCK))
        refs = np.sort(np.concatenate(told))
        a, n = (refs >> U64(5)).astype(np.int64), refs & U64(31)
        row = np.searchsorted(starts, a, side="right") - 1
        cut = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]]))
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            r = int(row[lo])
            out.append((None if null[r] else int(doc[r]), int(texts[r]), planes((a[lo:hi] - starts[r]).astype(U64), n[lo:hi])))
    return pa.Table.from_batches([rows_batch(out, CELLS_ARROW)])


def _windows(buckets: int, window: int, most: int):
    def run(batches):
        from pyspark import TaskContext

        poly, number = Poly(), TaskContext.get().partitionId() << 24
        for batch in batches:
            data, offs = text_buffer(batch.column(2))
            for lo, hi in slices(offs, most):
                number += 1
                part = offs[lo : hi + 1]
                w, at = word_hashes(data[part[0] : part[-1]], part - part[0], poly)
                full = rolling(w, window)
                row, start = [], []
                for r, blob in enumerate(batch.column(3).slice(lo, hi - lo)):
                    a, n = (x.astype(np.int64) for x in unplanes(blob.as_py()))
                    s = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    row.append(np.full(len(s), r))
                    start.append(s)
                row, start = np.concatenate(row), np.concatenate(start)
                keys = full[at[row] + start]
                docs = batch.column(0).slice(lo, hi - lo)
                null = np.asarray(docs.is_null())
                ids = docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
                rank = np.where(null, LAST, (ids.view("<u8") ^ U64(1 << 63)))[row]
                order = np.lexsort((start, rank, keys))
                keys, rank, row, start = keys[order], rank[order], row[order], start[order]
                new = np.concatenate([[True], keys[1:] != keys[:-1]])
                lead = np.flatnonzero(new)
                of = lead[np.cumsum(new) - 1]
                later = (rank != rank[of]) | (start != start[of])
                texts = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype("<i8").view("<u8")
                refs = (row.astype(U64) << U64(32)) | start.astype(U64)
                parts = [planes(ids.view("<u8"), null.astype("<u8"), texts), planes(np.sort(refs[later]))]
                body = b"".join(len(x).to_bytes(8, "little") + x for x in parts)
                keys, refs, rank = keys[lead], refs[lead], rank[lead]
                out = [(number % buckets, number, WINDOWS, body)]
                to = bucket_of(keys, buckets)
                place = np.argsort(to, kind="stable")
                cut = np.flatnonzero(np.concatenate([[True], to[place][1:] != to[place][:-1], [True]]))
                for x, y in zip(cut[:-1], cut[1:], strict=True):
                    e = place[x:y]
                    out.append((int(to[e[0]]), number, KEYS, planes(keys[e], refs[e], rank[e])))
                for i in range(0, len(out), 64):
                    yield rows_batch(out[i : i + 64], EXCHANGE_ARROW)

    return run


def _later(rows: pa.Table) -> pa.Table:
    """A bucket: every entry whose hash has an entry with a smaller (document, start)."""
    cells = list(zip(rows["block"].to_pylist(), rows["kind"].to_pylist(), rows["payload"].to_pylist(), strict=True))
    out = [c for c in cells if c[1] != KEYS]
    mine = [(b, unplanes(x)) for b, k, x in cells if k == KEYS]
    if mine:
        keys, start, rank = (np.concatenate([x[i] for _, x in mine]) for i in range(3))
        start = start & U64(0xFFFFFFFF)
        order = np.lexsort((start, rank, keys))
        new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
        of = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        later = np.empty(len(keys), bool)
        later[order] = (rank[order] != rank[of]) | (start[order] != start[of])
        at = 0
        for b, x in mine:
            hit = later[at : at + len(x[0])]
            at += len(x[0])
            if hit.any():
                out.append((b, KEYS, planes(x[1][hit])))
    return pa.Table.from_batches([rows_batch(out, ANSWER_ARROW)])


def _intervals(window: int):
    def run(rows: pa.Table) -> pa.Table:
        kinds, blobs = rows["kind"].to_pylist(), rows["payload"].to_pylist()
        body, parts = next(x for k, x in zip(kinds, blobs, strict=True) if k == WINDOWS), []
        while body:
            n = int.from_bytes(body[:8], "little")
            parts.append(unplanes(body[8 : 8 + n]))
            body = body[8 + n :]
        (ids, null, texts), (later,) = parts
        refs = np.sort(np.concatenate([later, *(unplanes(x)[0] for k, x in zip(kinds, blobs, strict=True) if k == KEYS)]))
        row, start = (refs >> U64(32)).astype(np.int64), (refs & U64(0xFFFFFFFF)).astype(np.int64)
        out = []
        cut = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]])) if len(row) else [0]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            r = int(row[a])
            s, e = merged_spans(start[a:b], start[a:b] + window)
            doc = None if null[r] else int(ids[r : r + 1].view("<i8")[0])
            out.append((doc, int(texts[r : r + 1].view("<i8")[0]), planes(s.astype(U64), e.astype(U64))))
        return pa.Table.from_batches([rows_batch(out, SPANS_ARROW)])

    return run


def repeated_intervals(docs: DataFrame, window: int = 20, block_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, text_id, spans): the word intervals to remove, one row per document that has any."""
    buckets = 4 * shuffle_parts(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id().alias("text_id"), F.col("text").cast("string").alias("text"))
    asked = src.mapInArrow(_scan(buckets, window, block_bytes), EXCHANGE)
    told = asked.groupBy("bucket").applyInArrow(repeated_entries(1 << 62), ANSWER)
    runs = saved(told.groupBy("block").applyInArrow(_open_runs, CELLS), "window-runs")
    found = opened_rows(src, runs, "runs").mapInArrow(_windows(buckets, window, block_bytes), EXCHANGE)
    decided = found.groupBy("bucket").applyInArrow(_later, ANSWER).groupBy("block").applyInArrow(_intervals(window), SPANS)
    return decided.groupBy("doc_id", "text_id").agg(F.collect_set("spans").alias("spans"))


REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
REPORT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def window_report(docs: DataFrame, **params) -> DataFrame:
    """Every row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one blank)."""

    def report(batches):
        for b in batches:
            out = []
            for doc, text, blobs in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                words = (text.as_py() or "").encode().split()  # bytes split at 0x20 and 0x09-0x0D
                s, e = _union(blobs.as_py())
                kept, at = [], 0
                for x, y in zip(s.tolist(), e.tolist(), strict=True):
                    kept += words[at:x]
                    at = y
                kept += words[at:]
                out.append((doc, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield rows_batch(out, REPORT_ARROW)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id().alias("text_id"), F.col("text").cast("string").alias("text"))
    return _with_spans(src, repeated_intervals(docs, **params)).select("doc_id", "text", "spans").mapInArrow(report, REPORT)
