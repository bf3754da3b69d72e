"""Invented documents with the hard cases, and brute-force versions of the dealt operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
VOCAB = "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one".split()


def invented(seed: int = 3, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): copies, edits, shared passages, nulls, empties, repeats, long texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice(VOCAB) if rng.random() < 0.3 else "".join(rng.choice("abcdefghiklmnoprstuvzéüß") for _ in range(rng.randint(2, 9)))
    text = lambda k: " ".join(word() + rng.choice(["", "", "", ",", ".", "\n", "!"]) for _ in range(k))
    passage, line = text(90), text(60)
    rows = []
    for i in range(n):
        kind = i % 10
        if kind == 0 and i:
            t = rows[rng.randrange(len(rows))][1]
        elif kind == 1 and i > 10:
            ws = (rows[rng.randrange(len(rows))][1] or "x").split(" ")
            for _ in range(max(1, len(ws) // 60)):
                ws[rng.randrange(len(ws))] = word()
            t = " ".join(ws)
        elif kind == 2:
            t = text(40) + " " + passage + " " + text(rng.randint(0, 40))
        elif kind == 3:
            t = text(rng.randint(1, 30)) + line + text(80) + line
        elif kind == 4:
            t = text(rng.randint(1, 6))
        elif kind == 5:
            t = "ab " * rng.randint(150, 400) + text(30)
        else:
            t = text(rng.randint(60, 300))
        rows.append((i, t, rng.choice(["en", "de"]), f"src{i % 4}", len(t or "")))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "src0", 0), (n + 2, " \n\t ", "en", None, 4), (n + 3, "one", "en", "src1", 3), (n + 4, "ONE", "en", "src1", 3)]
    rows.append((n + 5, text(3000) + passage, "en", "src2", 0))
    rows.append((n + 6, rows[12][1].upper(), "en", "src2", 0))
    rows.append((n + 7, "x" * 1500, "en", "src3", 1500))
    rows.append(rows[2])
    rows.append(rows[6])
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def raw(text) -> bytes:
    return (text or "").encode()


def union(n: int, starts, width: int):
    gone = [False] * n
    for s in starts:
        for k in range(s, s + width):
            gone[k] = True
    return gone


def brute_bytes(rows, span: int = 400):
    """op5: [(doc_id, n_bytes, n_removed, n_spans, sha)]."""
    seen = Counter()
    for r in rows:
        b = raw(r[1])
        seen.update(b[i : i + span] for i in range(len(b) - span + 1))
    out = []
    for r in rows:
        b = raw(r[1])
        gone = union(len(b), (i for i in range(len(b) - span + 1) if seen[b[i : i + span]] > 1), span)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((r[0], len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_windows(rows, window: int = 20):
    """op7: [(doc_id, n_words, n_removed, sha)]; null ids last."""
    key = lambda d: (d is None, d or 0)
    first = {}
    words = [WORD.findall(raw(r[1])) for r in rows]
    for r, w in zip(rows, words, strict=True):
        for i in range(len(w) - window + 1):
            k, at = tuple(w[i : i + window]), (key(r[0]), i)
            first[k] = min(first.get(k, at), at)
    out = []
    for r, w in zip(rows, words, strict=True):
        starts = [i for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < (key(r[0]), i)]
        gone = union(len(w), starts, window)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((r[0], len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def lower(b: bytes) -> bytes:
    return bytes(x + 32 if 65 <= x <= 90 else x for x in b)


def shingles(text, k: int = 5) -> frozenset:
    w = WORD.findall(lower(raw(text)))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute_components(rows):
    """op6: [(doc_id, n_shingles, component_id)]."""
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    has = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            has[x].append(i)
    shared = Counter()
    for who in has.values():
        for a in range(len(who)):
            for b in range(a):
                shared[who[b], who[a]] += 1
    for (a, b), o in shared.items():
        if 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
            up[find(a)] = find(b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=str)
