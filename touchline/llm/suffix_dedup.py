"""Exact repeated-substring removal by a distributed, common-prefix-aware merge sort of suffixes.

A byte goes when a ``span``-byte string that covers it also starts anywhere else.

1. Sparse suffixes.  Every ``span``-byte window picks one place of its own, the
   leftmost smallest hash of its k-grams (a minimizer), so equal windows pick
   equal places.  Only suffixes at picked places are sorted: about one in 200
   positions, and none is missed.  The windows of a place p that start d bytes
   before it are handled in cells (d below half the span, and above); all
   windows of a cell hold the same core of at least half the span.
2. A block exchange counts the cores' hashes; cells with a unique core are done
   (a hash only ever keeps too much).  A core with very many occurrences is cut
   into narrow cells, whose strings collapse where they are made.
3. Each task sorts its cells' suffixes (from the core's start), collapses equal
   ones, and sends the sorted run front-coded: per suffix the length of the
   prefix it shares with the one before, and the rest.  Runs go to buckets by
   their first ``span`` / 2 bytes, so no group is torn.
4. A bucket merges its runs with a loser tree whose players carry their common
   prefix with the last winner: comparisons start there, known prefixes are
   never compared again.  The merged order with its common prefixes, together
   with the order of the reversed left contexts, decides every window of every
   cell exactly: the window reaching e bytes to the left is repeated when
   another suffix shares span - e bytes to the right and e to the left.
5. Decisions go back to the occurrences, become byte spans per document and
   are applied where the text lies.

Matches never cross documents.  Null texts are empty.  Rows that repeat are
each other's copies.  Null doc_ids take part.  Texts of any length are read
whole (long ones in overlapping pieces).  Only doc_id and text are read (the
stage carries the other columns as they are).  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import (
    ANSWER, ANSWER_ARROW, BLOCK, EXCHANGE, EXCHANGE_ARROW, KEYS, U64, Poly, block_row, opened_rows, planes, read_block,
    repeated_entries, rows_batch, saved, send, shuffle_parts, sliding_argmin, slices, text_buffer, text_id, unplanes, worker_store,
)

KGRAM = 16
NARROW = 8
OCCURRENCES = 3
#: Bytes hashed at a time.
PIECE = 1 << 20
CELLS = "doc_id long, text_id long, cells binary"
CELLS_ARROW = pa.schema([("doc_id", pa.int64()), ("text_id", pa.int64()), ("cells", pa.binary())])
SPANS = "doc_id long, text_id long, spans binary"
SPANS_ARROW = pa.schema([("doc_id", pa.int64()), ("text_id", pa.int64()), ("spans", pa.binary())])


# --- 1, 2: cells whose core occurs again ----------------------------------


def window_runs(data: np.ndarray, offs: np.ndarray, span: int, poly: Poly, piece: int = 1 << 20):
    """Runs of windows with the same picked place and side: (first start, number, place)."""
    first, count, place = [], [], []
    n = len(data)
    for base in range(0, max(n - span + 1, 0), piece):
        part = data[base : base + piece + span - 1]
        here = np.arange(base, base + len(part) - span + 1)
        ok = np.flatnonzero(here + span <= offs[np.searchsorted(offs, here, side="right")])
        if not len(ok):
            continue
        prefix = poly.prefix(part.astype(U64) + U64(1))
        at = np.arange(len(part) - KGRAM + 1)
        p = sliding_argmin(poly.span(prefix, at, at + KGRAM), span - KGRAM + 1)[ok]
        side = p - ok >= span // 2
        new = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (ok[1:] != ok[:-1] + 1) | (side[1:] != side[:-1])]))
        first.append(ok[new] + base)
        count.append(np.diff(np.append(new, len(ok))))
        place.append(p[new] + base)
    if not first:
        return (np.zeros(0, np.int64),) * 3
    a, c, p = np.concatenate(first), np.concatenate(count), np.concatenate(place)
    if len(a) > 1:  # a run cut by the end of a piece goes on
        high = p - a >= span // 2
        on = np.concatenate([[False], (p[1:] == p[:-1]) & (a[1:] == a[:-1] + c[:-1]) & (high[1:] == high[:-1])])
        if on.any():
            keep = np.flatnonzero(~on)
            c = np.add.reduceat(c, keep)
            a, p = a[keep], p[keep]
    return a, c, p


def _scan(buckets: int, span: int, most: int):
    half = span // 2

    def run(batches):
        from pyspark import TaskContext

        worker_store("suffix")  # what another operator kept in this worker goes

        poly, block = Poly(), TaskContext.get().partitionId() << 24
        for batch in batches:
            data, offs = text_buffer(batch.column(2))
            for lo, hi in slices(offs, most):
                part = offs[lo : hi + 1]
                mine = data[part[0] : part[-1]]
                starts = part - part[0]
                a, c, p = window_runs(mine, starts, span, poly)
                if not len(a):
                    continue
                block += 1
                texts = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                out = [block_row(block, buckets, batch.column(0).slice(lo, hi - lo), texts, starts[:-1])]
                keys = np.empty(len(a), U64)
                high = p - a >= half
                for base in range(0, len(mine), PIECE):  # hash the cores piece by piece
                    prefix = None
                    for side in (False, True):
                        pick = np.flatnonzero((high == side) & (p >= base) & (p < base + PIECE))
                        if not len(pick):
                            continue
                        left = max(base - half, 0)
                        if prefix is None:
                            prefix = poly.prefix(mine[left : base + PIECE + span].astype(U64) + U64(1))
                        at = p[pick] - left
                        s, e = (at - half, at + KGRAM) if side else (at, at + half + 1)
                        keys[pick] = poly.span(prefix, s, e) + U64(side)
                refs = (a.astype(U64) << U64(24)) | (c.astype(U64) - U64(1) << U64(12)) | (p - a).astype(U64)
                out += send(keys, refs, buckets, block)
                for k in range(0, len(out), 64):
                    yield rows_batch(out[k : k + 64], EXCHANGE_ARROW)

    return run


def _cells(rows: pa.Table) -> pa.Table:
    """A block: its documents' cells that are still open, at places in the document."""
    kinds, blobs = rows["kind"].to_pylist(), rows["payload"].to_pylist()
    told = [unplanes(x) for k, x in zip(kinds, blobs, strict=True) if k == KEYS]
    out = []
    if told:
        doc, null, texts, starts = read_block(next(x for k, x in zip(kinds, blobs, strict=True) if k == BLOCK))
        refs = np.concatenate([t[0] for t in told])
        hot = np.concatenate([t[1] for t in told])
        order = np.argsort(refs)
        refs, hot = refs[order], hot[order]
        first = (refs >> U64(24)).astype(np.int64)
        row = np.searchsorted(starts, first, side="right") - 1
        # empty rows share their start with the next: the last of equals holds the bytes
        local = (first - starts[row]).astype(U64)
        cut = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]]))
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            r = int(row[lo])
            tail = refs[lo:hi] & U64(0xFFFFFF)
            out.append((None if null[r] else int(doc[r]), int(texts[r]), planes((local[lo:hi] << U64(24)) | tail, hot[lo:hi])))
    return pa.Table.from_batches([rows_batch(out, CELLS_ARROW)])


# --- 3: sorted, front-coded runs ------------------------------------------


def shared_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, known to be at least ``at``."""
    n = min(len(a), len(b))
    step = 16
    while at < n:
        if a[at : at + step] == b[at : at + step]:
            at = min(at + step, n)
            step *= 2
        elif step == 1:
            return at
        else:
            n, step = min(n, at + step), max(1, step // 4)
    return at


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(shared prefix with the one before, length of the rest) of each, and the rests."""
    shared, rest, before = [], [], b""
    for s in strings:
        h = shared_prefix(before, s)
        shared.append(h)
        rest.append(s[h:])
        before = s
    return np.array(shared, np.uint64), np.array([len(r) for r in rest], np.uint64), b"".join(rest)


def encode_run(entries: list[tuple[bytes, bytes]], classes: list[int], many: list[bool]) -> bytes:
    """A sorted run of (suffix, reversed left context), both front-coded."""
    xs, xn, xb = front_code([x for x, _ in entries])
    ys, yn, yb = front_code([y for _, y in entries])
    head = planes(xs, xn, ys, yn, np.array(classes, np.uint64), np.array(many, np.uint64))
    return b"".join([len(head).to_bytes(8, "little"), len(xb).to_bytes(8, "little"), head, xb, yb])


def read_run(blob: bytes):
    """The run's entries in order: (shared prefix with the one before, suffix, left context, class, many)."""
    nh, nx = int.from_bytes(blob[:8], "little"), int.from_bytes(blob[8:16], "little")
    xs, xn, ys, yn, classes, many = (v.tolist() for v in unplanes(blob[16 : 16 + nh]))
    xb, yb = blob[16 + nh : 16 + nh + nx], blob[16 + nh + nx :]
    x = y = b""
    i = j = 0
    for k in range(len(xs)):
        x = x[: xs[k]] + xb[i : i + xn[k]]
        y = y[: ys[k]] + yb[j : j + yn[k]]
        i, j = i + xn[k], j + yn[k]
        yield xs[k], x, y, classes[k], many[k]


def cells_of(text: bytes, blob: bytes, span: int):
    """The open cells of a text: (name, suffix, reversed left context, core start, smallest and largest e)."""
    half = span // 2
    refs, hots = unplanes(blob)
    for ref, hot in zip(refs.tolist(), hots.tolist(), strict=True):
        a, n, d = ref >> 24, ((ref >> 12) & 0xFFF) + 1, ref & 0xFFF
        p, side = a + d, int(d >= half)
        low, high, least = (half, span - KGRAM, d - n + 1) if side else (0, half - 1, d - n + 1)
        if not hot:
            c = p - low
            yield bytes((side, 0)), text[c : c + span], text[max(p - high, 0) : c][::-1], c, least - low, d - low
            continue
        for lo in range(low, high + 1, NARROW):
            hi = min(lo + NARROW - 1, high)
            if least <= hi and d >= lo:
                c = p - lo
                yield bytes((2 + side, (lo - low) // NARROW)), text[c : c + span], text[max(p - hi, 0) : c][::-1], c, max(least, lo) - lo, min(d, hi) - lo


def _sorted_runs(buckets: int, span: int, most: int):
    half = span // 2

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            cells = batch.column(3)
            _, offs = text_buffer(batch.column(2))
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(offs, most):
                number += 1
                found: dict[tuple[bytes, bytes], list] = {}
                for r in range(lo, hi):
                    text = (batch.column(2)[r].as_py() or "").encode()
                    for name, x, y, c, e0, e1 in cells_of(text, cells[r].as_py(), span):
                        found.setdefault((name + x, y), []).append((r - lo, c, e0, e1))
                entries = sorted(found)
                to: dict[int, list[int]] = {}
                for k, (x, _) in enumerate(entries):
                    to.setdefault(zlib.crc32(x[: half + 2]) % buckets, []).append(k)
                occ = np.array([(k, *o) for k, e in enumerate(entries) for o in found[e]], np.uint64).reshape(-1, 5)
                ids = np.array([d or 0 for d in docs[lo:hi]], "<i8").view("<u8")
                null = np.array([d is None for d in docs[lo:hi]], "<u8")
                table = planes(ids, null, np.array(texts[lo:hi], "<i8").view("<u8"))
                body = len(table).to_bytes(8, "little") + table + planes(*occ.T)
                out = [(number % buckets, number, OCCURRENCES, body)]
                for b, ks in to.items():
                    out.append((b, number, KEYS, encode_run([entries[k] for k in ks], ks, [len(found[entries[k]]) > 1 for k in ks])))
                for k in range(0, len(out), 64):
                    yield rows_batch(out[k : k + 64], EXCHANGE_ARROW)

    return run


# --- 4: merge ---------------------------------------------------------------


def merge_runs(blobs: list[bytes]):
    """All runs in one order by a loser tree: (shared prefix with the one before, suffix, left, run, class, many).

    Every player carries the prefix it shares with the last winner; between two
    players the one that shares more comes first, and only equals are compared,
    from that place on.
    """
    k = len(blobs)
    runs = [read_run(b) for b in blobs]
    shared, text, rest = [0] * k, [None] * k, [None] * k

    def advance(i: int) -> None:
        entry = next(runs[i], None)
        if entry is None:
            text[i] = None
        else:
            shared[i], text[i], rest[i] = entry[0], entry[1], entry[2:]

    def play(i: int, j: int) -> tuple[int, int]:
        """(winner, loser); the loser learns the prefix it shares with the winner."""
        if text[i] is None:
            return j, i
        if text[j] is None:
            return i, j
        if shared[i] != shared[j]:
            return (i, j) if shared[i] > shared[j] else (j, i)
        x, y = text[i], text[j]
        h = shared_prefix(x, y, shared[i])
        if h == len(x) or (h < len(y) and x[h] < y[h]):
            shared[j] = h
            return i, j
        shared[i] = h
        return j, i

    size = 1
    while size < k:
        size *= 2
    losers = [-1] * (2 * size)
    for i in range(k):
        advance(i)
    level = [i if i < k else -1 for i in range(size)]
    node = size
    while len(level) > 1:
        node //= 2
        up = []
        for q in range(0, len(level), 2):
            i, j = level[q], level[q + 1]
            if j < 0 or i < 0:
                win, lose = max(i, j), -1
            else:
                win, lose = play(i, j)
            losers[node + q // 2] = lose
            up.append(win)
        level = up
    win = level[0] if k else -1
    while win >= 0 and text[win] is not None:
        yield shared[win], text[win], rest[win][0], win, rest[win][1], rest[win][2]
        advance(win)
        at, mover = (size + win) // 2, win
        while at >= 1:
            if losers[at] >= 0:
                mover, losers[at] = play(mover, losers[at])
            at //= 2
        win = mover


def decide(shared: np.ndarray, left: list[bytes], many: np.ndarray, span: int):
    """(entry, first e, last e) of the windows that other entries share, from the two orders."""
    m, half = len(left), span // 2
    right = shared - 2  # without the cell's name
    near = np.zeros(m, bool)
    near[1:] |= right[1:] >= half
    near[:-1] |= right[1:] >= half
    live = np.flatnonzero(near | many)
    if not len(live):
        return (np.zeros(0, np.int64),) * 3
    # prefixes shared by neighbours among the live entries
    r = np.array([right[a + 1 : b + 1].min() for a, b in zip(live[:-1], live[1:], strict=True)], np.int64) if len(live) > 1 else np.zeros(0, np.int64)
    lefts = [left[i] for i in live]
    by_left = sorted(range(len(live)), key=lambda i: lefts[i])
    lcp = np.array([shared_prefix(lefts[a], lefts[b]) for a, b in zip(by_left[:-1], by_left[1:], strict=True)], np.int64)
    place = np.array(by_left)
    n = len(live)
    dec = np.zeros((half + 1, n), bool)
    for e in range(half):
        rc = np.concatenate([[0], np.cumsum(r < span - e)])
        lc = np.empty(n, np.int64)
        lc[place] = np.concatenate([[0], np.cumsum(lcp < e)])
        key = rc * n + lc
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        dec[e, order[1:]] |= same
        dec[e, order[:-1]] |= same
    dec[:half] |= many[live]
    edge = np.diff(np.concatenate([np.zeros((1, n), np.int8), dec.astype(np.int8)]), axis=0).T
    who, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    return live[who], first, last - 1


def _merge(span: int):
    def run(rows: pa.Table) -> pa.Table:
        cells = list(zip(rows["block"].to_pylist(), rows["kind"].to_pylist(), rows["payload"].to_pylist(), strict=True))
        out = [c for c in cells if c[1] != KEYS]
        mine = [(b, x) for b, k, x in cells if k == KEYS]
        shared, left, who, classes, many = [], [], [], [], []
        for h, _, y, i, c, m in merge_runs([x for _, x in mine]):
            shared.append(h)
            left.append(y)
            who.append(i)
            classes.append(c)
            many.append(m > 0)
        if shared:
            entry, e0, e1 = decide(np.array(shared, np.int64), left, np.array(many, bool), span)
            run_of, cls = np.array(who)[entry], np.array(classes)[entry]
            for i in np.unique(run_of):
                at = run_of == i
                out.append((mine[i][0], KEYS, planes(cls[at].astype(U64), e0[at].astype(U64), e1[at].astype(U64))))
        return pa.Table.from_batches([rows_batch(out, ANSWER_ARROW)])

    return run


# --- 5: spans -----------------------------------------------------------------


def merged_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans as disjoint, maximal ones (touching spans are one)."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])]


def _spans(span: int):
    def run(rows: pa.Table) -> pa.Table:
        kinds, blobs = rows["kind"].to_pylist(), rows["payload"].to_pylist()
        told = [unplanes(x) for k, x in zip(kinds, blobs, strict=True) if k == KEYS]
        out = []
        if told:
            body = next(x for k, x in zip(kinds, blobs, strict=True) if k == OCCURRENCES)
            nt = int.from_bytes(body[:8], "little")
            ids, null, texts = unplanes(body[8 : 8 + nt])
            cls, row, c, e0, e1 = (v.astype(np.int64) for v in unplanes(body[8 + nt :]))
            t, f, g = (np.concatenate([x[i] for x in told]).astype(np.int64) for i in range(3))
            order = np.argsort(t, kind="stable")
            t, f, g = t[order], f[order], g[order]
            lo, hi = np.searchsorted(t, cls), np.searchsorted(t, cls, side="right")
            k = np.repeat(np.arange(len(cls)), hi - lo)
            at = np.arange(len(k)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[k]
            first, last = np.maximum(f[at], e0[k]), np.minimum(g[at], e1[k])
            ok = first <= last
            row, start, end = row[k][ok], (c[k] - last)[ok], (c[k] - first + span)[ok]
            order = np.argsort(row, kind="stable")
            row, start, end = row[order], start[order], end[order]
            cut = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]])) if len(row) else [0]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                r = int(row[a])
                s, e = merged_spans(start[a:b], end[a:b])
                doc = None if null[r] else int(ids[r : r + 1].view("<i8")[0])
                out.append((doc, int(texts[r : r + 1].view("<i8")[0]), planes(s.astype(U64), e.astype(U64))))
        return pa.Table.from_batches([rows_batch(out, SPANS_ARROW)])

    return run


def repeated_spans(docs: DataFrame, span: int = 400, hot: int = 4096, block_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, text_id, spans): the byte spans to remove, one row per document that has any."""
    spark = docs.sparkSession
    buckets = 4 * shuffle_parts(spark)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id().alias("text_id"), F.col("text").cast("string").alias("text"))
    asked = src.mapInArrow(_scan(buckets, span, block_bytes), EXCHANGE)
    told = asked.groupBy("bucket").applyInArrow(repeated_entries(hot), ANSWER)
    cells = saved(told.groupBy("block").applyInArrow(_cells, CELLS), "suffix-cells")
    runs = opened_rows(src, cells, "cells").mapInArrow(_sorted_runs(buckets, span, block_bytes), EXCHANGE)
    merged = runs.groupBy("bucket").applyInArrow(_merge(span), ANSWER)
    found = merged.groupBy("block").applyInArrow(_spans(span), SPANS)
    return found.groupBy("doc_id", "text_id").agg(F.collect_set("spans").alias("spans"))


def _union(blobs) -> tuple[np.ndarray, np.ndarray]:
    parts = [unplanes(b) for b in (blobs if blobs is not None else ())]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return merged_spans(*(np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (0, 1)))


def _kept(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    at, out = 0, []
    for s, e in zip(start.tolist(), end.tolist(), strict=True):
        out.append(text[at:s])
        at = e
    out.append(text[at:])
    return b"".join(out)


def _with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text_id, ...) with their spans, null where nothing goes."""
    found = saved(spans, "suffix-spans").select(F.col("doc_id").alias("s_doc"), F.col("text_id").alias("s_text"), "spans")
    return rows.join(found, rows["doc_id"].eqNullSafe(found["s_doc"]) & (rows["text_id"] == found["s_text"]), "left").drop("s_doc", "s_text")


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
REPORT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def removal_report(docs: DataFrame, **params) -> DataFrame:
    """Every row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def report(batches):
        for b in batches:
            out = []
            for doc, text, blobs in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                raw = (text.as_py() or "").encode()
                s, e = _union(blobs.as_py())
                out.append((doc, len(raw), int((e - s).sum()), len(s), hashlib.sha256(_kept(raw, s, e)).hexdigest()))
            yield rows_batch(out, REPORT_ARROW)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id().alias("text_id"), F.col("text").cast("string").alias("text"))
    return _with_spans(src, repeated_spans(docs, **params)).select("doc_id", "text", "spans").mapInArrow(report, REPORT)


def without_repeats(docs: DataFrame, **params) -> DataFrame:
    """All rows and columns, the text without its repeated bytes (broken characters at a cut go too) and n_chars to match."""

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        out = []
        for text, blobs in zip(texts, spans, strict=True):
            if text is None or blobs is None:
                out.append(text)
            else:
                out.append(_kept(text.encode(), *_union(blobs)).decode("utf-8", "ignore"))
        return pd.Series(out, dtype=object)

    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_id().alias("text_id"))
    both = _with_spans(rows, repeated_spans(docs, **params))
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(cut(F.col("row.text").cast("string"), "spans"))
    new = both.select("row", text.alias("new_text"))
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("new_text").alias(c))
        elif c == "n_chars":
            cols.append(F.length(F.col("new_text")).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col("row").getField(c).alias(c))
    return new.select(*cols)
