"""Alignment of two tokenizers' tokens by sparse incidence products.

1. Both tokenizers encode every whole text; A reads a space before the text, B
   adds it by itself.  A block of documents lies end to end: a token is a byte
   range of the block.
2. Incidence matrices in compressed rows (:class:`Rows`): a token's row names
   the bytes it covers, the byte at which it ends, or its group.  A group is what
   lies between two byte offsets at which tokens of both sides end.
3. Gustavson's row products link the tokens: row i of A·Bᵀ is the sum of the
   rows of Bᵀ that row i of A names.  Bytes give overlap links (the entry is the
   number of shared bytes), last bytes give the links that end together, group
   incidences give shared-group links.
4. Corpus counts of linked id pairs: each block sends its distinct pairs with
   their counts (pre-aggregated, so a pair that is everywhere has a row a block),
   one aggregation adds them, and a join tells the blocks, which hold their
   links as numbers into their own pairs.

A null or empty text, and one whose tokens' bytes are not space + text on both
sides (a text holding U+2581, which B reads as a space), has no tokens: zeros and
an empty digest.  Repeated rows and equal or null doc_ids each give a row.  Long
texts are read whole; a block holds at least one document, whose tokens need
about a hundred times its bytes.  Strings of special tokens in texts are plain
text.  Empty tables give empty results.  Only doc_id and text are read, so other
columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import saved, slices, text_buffer, worker_store

#: How a text is cut before byte-level merging (fixed value of the public vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK = "▁"
#: Partial products held at once.
MOST = 4 << 20
KINDS = ("overlap", "end", "group")

LINKS = "doc_id long, a long, b long, a_id long, b_id long, n long"
LINKS_ARROW = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("a", "b", "a_id", "b_id", "n"))])
SCAN = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pair long, number int, n long"
SCAN_ARROW = pa.schema([
    *((c, pa.int64()) for c in ("block", "doc_id", "n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()),
    ("links", pa.binary()), ("pair", pa.int64()), ("number", pa.int32()), ("n", pa.int64()),
])
REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
REPORT_ARROW = pa.schema([*((c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])


# --- the two tokenizers -----------------------------------------------------


def spelled(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length of each token, its first byte, all bytes end to end)."""
    size = np.array([len(t) for t in tokens], np.int64)
    return size, np.cumsum(size) - size, np.frombuffer(b"".join(tokens), np.uint8)


class ByteLevel:
    """The byte-level side: ids of space + text.  Bytes outside the printable ranges are written moved up by 256."""

    def __init__(self, path: str) -> None:
        import tiktoken

        vocabulary = json.load(open(path, encoding="utf-8"))
        special = {t["content"] for t in vocabulary.get("added_tokens", [])}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = sorted(set(range(256)) - set(printable))
        byte = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(moved)}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary["model"]["vocab"].items() if t not in special}
        tokens = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            tokens[i] = t
        self.size, self.first, self.bytes = spelled(tokens)
        self.encoding = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(" " + text), np.int64)


class Pieces:
    """The piece side.  If only runs of blanks hold a blank behind their start, the pieces of a text without two
    blanks together are those of its space-separated chunks, each encoded once per worker (the store is emptied
    beyond ``most`` pieces); other texts are encoded whole."""

    def __init__(self, path: str, most: int = 1_000_000) -> None:
        import sentencepiece

        self.model, self.most = sentencepiece.SentencePieceProcessor(model_file=path), most
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.size, self.first, self.bytes = spelled([
            bytes([int(t[3:5], 16)]) if self.model.is_byte(i) else t.replace(BLANK, " ").encode() for i, t in enumerate(names)
        ])
        self.chunked = all(BLANK not in t[1:] or not t.strip(BLANK) for t in names)
        self.blank = self.model.piece_to_id(BLANK)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.length, self.ids = array("q"), array("q"), array("q")

    def _learn(self, chunk: str) -> None:
        ids = self.model.encode(chunk) if chunk else [self.blank]
        self.number[chunk] = len(self.start)
        self.start.append(len(self.ids))
        self.length.append(len(ids))
        self.ids.extend(ids)

    def encode(self, text: str) -> np.ndarray:
        if not self.chunked or text[0] == " " or "  " in text or BLANK in text:
            return np.array(self.model.encode(text), np.int64)
        if len(self.ids) > self.most:
            self.clear()
        chunks, number = text.split(" "), self.number
        try:
            at = np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))
        except KeyError:
            for c in chunks:
                if c not in number:
                    self._learn(c)
            at = np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))
        start, n = np.frombuffer(self.start, np.int64)[at], np.frombuffer(self.length, np.int64)[at]
        return np.frombuffer(self.ids, np.int64)[ranges(start, n)]


def sides(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers, loaded once per Python worker."""
    kept = worker_store("alignment")
    if ("align", a_path, b_path) not in kept:
        kept["align", a_path, b_path] = ByteLevel(a_path), Pieces(b_path)
    return kept["align", a_path, b_path]


# --- compressed rows and their product -------------------------------------


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (n of them), for each start."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


@dataclass
class Rows:
    """A sparse matrix of ones by compressed rows: row i names columns[first[i]:first[i + 1]]."""

    first: np.ndarray
    columns: np.ndarray
    width: int

    def transposed(self) -> Rows:
        count = np.bincount(self.columns, minlength=self.width)
        row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        rising = len(self.columns) < 2 or (self.columns[1:] >= self.columns[:-1]).all()
        order = slice(None) if rising else np.argsort(self.columns, kind="stable")
        return Rows(np.concatenate([[0], np.cumsum(count)]), row[order], len(self.first) - 1)


def row_products(a: Rows, b: Rows, most: int = MOST):
    """Gustavson's product a·b: (row, column, value) of its entries, row by row, about ``most`` partial products at a time."""
    fan = np.diff(b.first)[a.columns]
    before = np.concatenate([[0], np.cumsum(fan)])[a.first]
    lo, rows = 0, len(a.first) - 1
    while lo < rows:
        hi = min(rows, max(lo + 1, int(np.searchsorted(before, before[lo] + most, side="right")) - 1))
        mine = slice(a.first[lo], a.first[hi])
        row = np.repeat(np.repeat(np.arange(lo, hi), np.diff(a.first[lo : hi + 1])), fan[mine])
        column = b.columns[ranges(b.first[a.columns[mine]], fan[mine])]
        key = row * b.width + column  # the accumulator: equal places add up
        if len(key) > 1 and not (key[1:] >= key[:-1]).all():
            key = np.sort(key)
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        key, value = key[at], np.diff(np.append(at, len(key)))
        yield key // b.width, key % b.width, value
        lo = hi


# --- a block of documents ----------------------------------------------------


class Block:
    """The tokens of both sides of a block of documents, end to end."""

    def __init__(self, texts: list[str | None], tokenizers) -> None:
        plain = [b" " + t.encode("utf-8") if t else b"" for t in texts]
        size = np.array([len(p) for p in plain], np.int64)
        data = np.frombuffer(b"".join(plain), np.uint8)
        none = np.zeros(0, np.int64)
        found = [[side.encode(t) if t else none for t in texts] for side in tokenizers]
        fits = np.ones(len(texts), bool)
        for side, ids in zip(tokenizers, found, strict=True):
            fits &= self._spelled(side, ids, data, size)
        self.n = len(texts)
        self.size = np.where(fits, size, 0)  # bytes of each document that has tokens
        self.bytes = int(self.size.sum())
        self.ids, self.at, self.end = [], [], []
        for side, ids in zip(tokenizers, found, strict=True):
            mine = [x if ok else none for x, ok in zip(ids, fits, strict=True)]
            ids = np.concatenate([none, *mine])
            self.ids.append(ids)
            self.at.append(np.concatenate([[0], np.cumsum([len(x) for x in mine])]).astype(np.int64))
            self.end.append(np.cumsum(side.size[ids]))

    @staticmethod
    def _spelled(side, ids: list, data: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Which documents' tokens, joined, are exactly the document's bytes."""
        length = np.array([int(side.size[x].sum()) for x in ids], np.int64)
        fits = length == size
        first = np.cumsum(size) - size
        token = np.concatenate([np.zeros(0, np.int64), *(x for x, ok in zip(ids, fits, strict=True) if ok)])
        spelled = side.bytes[ranges(side.first[token], side.size[token])]
        differ = np.concatenate([[0], np.cumsum(spelled != data[ranges(first[fits], size[fits])])])
        ends = np.cumsum(size[fits])
        fits[fits] = differ[ends] == differ[ends - size[fits]]
        return fits

    def incidence(self, side: int, kind: str) -> Rows:
        """Tokens by the bytes they cover, by their last byte, or by their group."""
        ids, end = self.ids[side], self.end[side]
        n = np.arange(len(ids) + 1)
        if kind == "overlap":
            return Rows(np.concatenate([[0], end]), np.arange(self.bytes), self.bytes)
        if kind == "end":
            return Rows(n, end - 1, self.bytes)
        cuts = self.cuts()
        return Rows(n, np.searchsorted(cuts, end), len(cuts))

    def cuts(self) -> np.ndarray:
        """The byte offsets at which tokens of both sides end: where groups end."""
        a, b = self.end
        at = np.searchsorted(b, a)
        return a[np.append(b, -1)[at] == a]

    def links(self, kind: str):
        """(token of A, token of B, entry of the product), in parts."""
        yield from row_products(self.incidence(0, kind), self.incidence(1, kind).transposed())

    def digests(self, cuts: np.ndarray, group: list[np.ndarray]) -> list[str]:
        """Of each document, the digest of its groups `a1,a2|b1;...`; '' without tokens."""
        widest = 1 + int(max((x.max() for x in self.ids if len(x)), default=0))
        # a token's number with what follows it: ',' inside a side, '|' after A's last of a group, ';' after B's last
        shown = np.array([f"{i}{c}".encode() for c in ",|;" for i in range(widest)]) if self.bytes else np.zeros(1, "S1")
        n = [np.bincount(g, minlength=len(cuts)) for g in group]
        code = np.empty(sum(len(x) for x in self.ids), np.int64)
        for side, (ids, g) in enumerate(zip(self.ids, group, strict=True)):
            last = np.concatenate([g[1:] != g[:-1], np.ones(min(1, len(g)), bool)])
            other = np.cumsum(n[1 - side]) - (n[1] if side == 0 else 0)  # tokens of the other side that stand before
            code[np.arange(len(ids)) + other[g]] = ids + widest * np.where(last, 1 + side, 0)
        first = self.at[0] + self.at[1]
        out = []
        for d in range(self.n):
            text = shown[code[first[d] : first[d + 1]]].tobytes().replace(b"\0", b"")
            out.append(hashlib.sha256(text[:-1]).hexdigest() if text else "")
        return out


def blocks(batch: pa.RecordBatch, most: int):
    """(row range, texts) of about ``most`` bytes each."""
    _, offs = text_buffer(batch.column(1))
    for lo, hi in slices(offs, most):
        yield lo, hi, batch.column(1).slice(lo, hi - lo).to_pylist()


def token_links(docs: DataFrame, a_path: str, b_path: str, kind: str = "overlap", block_bytes: int = 1 << 20) -> DataFrame:
    """Every link: doc_id, the tokens' places a and b (from 0), their ids, and the product's entry n.

    ``kind``: ``overlap`` (n: shared bytes), ``end`` (byte ranges that end together) or ``group`` (tokens of one group).
    """
    if kind not in KINDS:
        raise ValueError(f"kind: one of {KINDS}")

    def run(batches):
        tokenizers = sides(a_path, b_path)
        for batch in batches:
            for lo, hi, texts in blocks(batch, block_bytes):
                block, ids = Block(texts, tokenizers), batch.column(0).slice(lo, hi - lo)
                for a, b, n in block.links(kind):
                    doc = np.searchsorted(block.at[0], a, side="right") - 1
                    columns = [a - block.at[0][doc], b - block.at[1][doc], block.ids[0][a], block.ids[1][b], n]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), *map(pa.array, columns)], schema=LINKS_ARROW)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, LINKS)


def _scan(a_path: str, b_path: str, block_bytes: int, kind: str):
    def run(batches):
        from pyspark import TaskContext

        tokenizers, number = sides(a_path, b_path), TaskContext.get().partitionId() << 24
        for batch in batches:
            for lo, hi, texts in blocks(batch, block_bytes):
                number += 1
                block, n = Block(texts, tokenizers), hi - lo
                cuts = block.cuts()
                group = [np.searchsorted(cuts, end) for end in block.end]
                ends = np.concatenate([[0], np.cumsum(block.size)])
                n_groups = np.diff(np.searchsorted(cuts, ends, side="right"))
                a, b = (np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 2, *((a, b) for a, b, _ in block.links(kind)), strict=True))
                n_links = np.diff(np.searchsorted(a, block.at[0]))
                pairs, place, count = np.unique(block.ids[0][a] << 32 | block.ids[1][b], return_inverse=True, return_counts=True)
                order = np.argsort(-count, kind="stable")  # frequent pairs get small numbers
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                width = max(1, (len(pairs).bit_length() + 7) // 8)
                named = rank[place].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
                first = np.concatenate([[0], np.cumsum(n_links)])
                blobs = [np.ascontiguousarray(named[first[d] : first[d + 1]].T).tobytes() for d in range(n)]
                rows = {
                    "block": np.full(n, number), "doc_id": batch.column(0).slice(lo, n), "n_a": np.diff(block.at[0]), "n_b": np.diff(block.at[1]),
                    "n_groups": n_groups, "n_links": n_links, "groups_sha256": block.digests(cuts, group), "links": blobs,
                }
                yield _batch(rows, n)
                for at in range(0, len(pairs), 1 << 16):
                    some = order[at : at + (1 << 16)]
                    rows = {"block": np.full(len(some), number), "pair": pairs[some], "number": np.arange(at, at + len(some)), "n": count[some]}
                    yield _batch(rows, len(some))

    return run


def _batch(rows: dict, n: int) -> pa.RecordBatch:
    cols = [pa.nulls(n, f.type) if f.name not in rows else rows[f.name] if isinstance(rows[f.name], pa.Array) else pa.array(rows[f.name], f.type) for f in SCAN_ARROW]
    return pa.RecordBatch.from_arrays(cols, schema=SCAN_ARROW)


def _settled(docs: pa.Table, told: pa.Table) -> pa.Table:
    """A block's documents with the corpus counts of their links."""
    pairs = len(told)
    count, best = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
    number = told["place"].to_numpy()
    count[number], best[number] = told["count"].to_numpy(), told["best"].to_numpy()
    n = docs["n_links"].to_numpy()
    some, total = [], []
    for blob, k in zip(docs["links"].to_pylist(), n.tolist(), strict=True):
        named = np.zeros((k, 4), np.uint8)
        width = len(blob) // k if k else 0
        named[:, :width] = np.frombuffer(blob, np.uint8).reshape(width, k).T
        at = named.reshape(-1).view("<u4")
        some.append(int(best[at].sum()))
        total.append(int(count[at].sum()))
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    out = out.append_column("n_best", pa.array(some, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
    return out.append_column("groups_sha256", docs["groups_sha256"]).select(REPORT_ARROW.names).cast(REPORT_ARROW)


def pair_counts(scan: DataFrame) -> DataFrame:
    """Corpus-wide: pair (A id << 32 | B id), count, best (1 where the count is the highest of its B id)."""
    counts = scan.filter("pair is not null").groupBy("pair").agg(F.sum("n").alias("count"))
    counts = saved(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")), "align-counts")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))  # a row a B id: bounded by its vocabulary
    return counts.join(F.broadcast(top), "b").select("pair", "count", (F.col("count") == F.col("top")).cast("int").alias("best"))


def alignment_report(docs: DataFrame, a_path: str, b_path: str, kind: str = "end", block_bytes: int = 2 << 20) -> DataFrame:
    """Every document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    src = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scan = saved(src.mapInArrow(_scan(a_path, b_path, block_bytes, kind), SCAN), "align-scan")
    told = scan.filter("pair is not null").select("block", "number", "pair").join(pair_counts(scan), "pair")
    told = told.select(F.col("block").alias("of"), F.col("number").alias("place"), "count", "best")
    rows = scan.filter("pair is null").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    return rows.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(_settled, REPORT)
