"""Exact deduplication by composable polynomial fingerprints.

1. Fingerprints: a chunk of normalised bytes (each run of 0x20 and 0x09-0x0D is
   one space) has the hash sum(byte[i] * B^(n-1-i)) mod 2^31 - 1 for two bases,
   its length, and the shift B^n.  Chunks combine by length-shifted arithmetic,
   H(xy) = H(x) * B^|y| + H(y), whatever their sizes.  Texts of more than
   ``huge`` bytes are cut into pieces that go to other tasks: a piece knows whether
   a blank stands before it, so no run is counted twice; Spark folds the pieces.
2. Counting fingerprints is one aggregation of (length, two hashes).  Rows whose
   fingerprint is alone are done.
3. Rows of a repeated fingerprint are moved once, with their text, to the
   partition of the fingerprint and sorted there.  A task streams through them and
   compares each text chunk by chunk with the text that stands for its group: equal
   fingerprints of different texts split here, so results never rest on hashes.
4. A fingerprint with a thousandth of all rows or more (at most a thousand such,
   so their list is broadcast) is spread over several partitions; each partition
   sends the text that stands for its part to a second, equal round.

The row with the smallest doc_id of equal texts stays; null doc_ids come last, and
of rows with equal doc_ids (repeated rows) one stays, the first as numbered when
they were moved.  A null text is empty.  Long texts are read whole; a task holds
one text beside the one it is compared with.  Empty tables give empty results.
Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import saved, shuffle_parts, slices, text_buffer

PRIME = (1 << 31) - 1
#: Bases of the two hashes (fixed values below the prime).
BASES = (1_315_423_911, 388_251_607)
#: A chunk's terms are below 2**40, so up to 2**24 of them add up in 64 bits.
CHUNK = 1 << 16
PRINT = "n_bytes long, h1 long, h2 long"
KEY = ["n_bytes", "h1", "h2"]


def is_blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def normalised(data: np.ndarray, offs: np.ndarray, after_blank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The rows with each run of blanks as one space; ``after_blank``: a row goes on after a blank, so its leading run is gone."""
    blank = is_blank(data)
    before = np.zeros(len(data), bool)
    before[1:] = blank[:-1]
    starts = offs[:-1]
    some = np.diff(offs) > 0
    before[starts[some]] = False if after_blank is None else after_blank[some]
    keep = ~(blank & before)
    out = np.where(blank, np.uint8(32), data)[keep]
    return out, np.concatenate([[0], np.cumsum(keep)])[offs]


class Powers:
    """B^0 ... B^CHUNK modulo the prime, for both bases."""

    def __init__(self) -> None:
        self.table = np.empty((2, CHUNK + 1), np.int64)
        for k, base in enumerate(BASES):
            at = 1
            for i in range(CHUNK + 1):
                self.table[k, i] = at
                at = at * base % PRIME

    def hashes(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Two hashes of every row, composed of the hashes of its chunks."""
        size = np.diff(offs)
        parts = np.maximum(1, -(-size // CHUNK))
        row = np.repeat(np.arange(len(size)), parts)
        part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        lo = offs[row] + part * CHUNK
        n = np.minimum(lo + CHUNK, offs[row + 1]) - lo
        out = np.zeros((2, len(size)), np.int64)
        left = np.repeat(n, n) - 1 - (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))  # bytes behind, in the chunk
        ends = np.cumsum(n)
        for k in range(2):
            done = np.concatenate([[0], np.cumsum(data * self.table[k][left])])  # slices of 2**20 bytes and one chunk more stay below 2**63
            h = (done[ends] - done[ends - n]) % PRIME
            one = parts == 1
            out[k][one] = h[np.cumsum(parts)[one] - 1]
            for r in np.flatnonzero(~one):  # H(xy) = H(x) * B^|y| + H(y)
                first, total = int(np.cumsum(parts)[r] - parts[r]), 0
                for c in range(first, first + int(parts[r])):
                    total = (total * int(self.table[k][n[c]]) + int(h[c])) % PRIME
                out[k][r] = total
        return out


def fingerprints(data: np.ndarray, offs: np.ndarray, powers: Powers, most: int = 1 << 20) -> np.ndarray:
    """Two hashes of every row; about ``most`` bytes at a time, longer rows by pieces that compose."""
    out = np.zeros((2, len(offs) - 1), np.int64)
    for lo, hi in slices(offs, most):
        if offs[hi] - offs[lo] <= 2 * most:
            out[:, lo:hi] = powers.hashes(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
            continue
        for at in range(offs[lo], offs[hi], most):  # one long row
            end = min(at + most, offs[hi])
            h = powers.hashes(data[at:end], np.array([0, end - at]))[:, 0]
            for k, base in enumerate(BASES):
                out[k, lo] = (int(out[k, lo]) * pow(base, int(end - at), PRIME) + int(h[k])) % PRIME
    return out


SEEN = f"doc_id long, {PRINT}, text_sha256 string"
MOVED = f"{SEEN}, norm binary"


def _scan(keep_text: bool):
    def run(batches):
        powers = Powers()
        for batch in batches:
            data, offs = text_buffer(batch.column(1))
            for lo, hi in slices(offs, 4 << 20):
                norm, at = normalised(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                h = fingerprints(norm, at, powers)
                plain = norm.tobytes()
                texts = [plain[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                sha = [hashlib.sha256(t).hexdigest() for t in texts]
                cols = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(h[0]), pa.array(h[1]), pa.array(sha)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.binary())] if keep_text else cols, names=["doc_id", *KEY, "text_sha256", "norm"][: 5 + keep_text])

    return run


def _pieces(batches):
    """A piece of a huge text: its length, hashes and shifts."""
    powers = Powers()
    for batch in batches:
        for row, piece, part, blank in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            data = np.frombuffer(part, np.uint8)
            norm, at = normalised(data, np.array([0, len(data)]), np.array([blank]))
            h = fingerprints(norm, at, powers)[:, 0]
            shift = [pow(base, len(norm), PRIME) for base in BASES]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (row, piece, len(norm), int(h[0]), int(h[1]), *shift)], names=["row", "piece", "n", "h1", "h2", "s1", "s2"])


def _huge(docs: DataFrame, piece_bytes: int, keep_text: bool) -> DataFrame:
    """Fingerprints of huge texts: pieces are hashed in parallel and folded in their order."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("binary").alias("b"))
    rows = saved(rows, "exact-huge")
    at = F.col("piece") * piece_bytes
    cut = rows.select("row", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.octet_length("b") - 1) / piece_bytes).cast("long"))).alias("piece"))
    before = F.substring("b", at.cast("int"), F.lit(1))
    cut = cut.select("row", "piece", F.substring("b", (at + 1).cast("int"), F.lit(piece_bytes)).alias("part"),
                     ((F.col("piece") > 0) & F.hex(before).isin("20", "09", "0A", "0B", "0C", "0D")).alias("blank"))
    told = cut.repartition(shuffle_parts(docs.sparkSession), "row", "piece").mapInArrow(_pieces, "row long, piece long, n long, h1 long, h2 long, s1 long, s2 long")
    folded = told.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("piece", "n", "h1", "h2", "s1", "s2"))).alias("parts"))
    zero = F.struct(F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))
    step = lambda acc, x: F.struct((acc["n_bytes"] + x["n"]).alias("n_bytes"), ((acc["h1"] * x["s1"] + x["h1"]) % PRIME).alias("h1"), ((acc["h2"] * x["s2"] + x["h2"]) % PRIME).alias("h2"))
    folded = folded.select("row", F.aggregate("parts", zero, step).alias("f"))
    norm = F.encode(F.regexp_replace(F.col("b").cast("string"), r"[\x20\x09-\x0D]+", " "), "utf-8")
    out = rows.join(folded, "row").select("doc_id", "f.*", norm.alias("norm"))
    cols = ["doc_id", *KEY, F.sha2("norm", 256).alias("text_sha256")]
    return out.select(*cols, "norm") if keep_text else out.select(*cols)


def fingerprinted(docs: DataFrame, huge: int = 16 << 20, piece_bytes: int = 1 << 20, keep_text: bool = False) -> DataFrame:
    """Every row: doc_id, n_bytes, h1, h2, text_sha256 (and the normalised bytes)."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > huge
    plain = src.filter(~long).mapInArrow(_scan(keep_text), MOVED if keep_text else SEEN)
    if not src.filter(long).limit(1).count():
        return plain
    return plain.unionByName(_huge(src.filter(long), piece_bytes, keep_text))


def same(a: memoryview, b: memoryview) -> bool:
    """Byte for byte, a chunk at a time."""
    return len(a) == len(b) and all(a[i : i + CHUNK] == b[i : i + CHUNK] for i in range(0, len(a), CHUNK))


def _compared(names: list[str], n_key: int, n_text: int, hot: int | None):
    """Rows sorted by their first ``n_key`` columns: each gets the number of the first equal text of its group, and
    brings that text along if it is the first itself and its group is spread (column ``hot`` above 1)."""

    def run(batches):
        now, texts = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(n_key)), strict=True))
            spread = batch.column(hot).to_pylist() if hot is not None else [1] * len(batch)
            variant, text = [], []
            for i, key in enumerate(keys):
                mine = memoryview(batch.column(n_text)[i].as_buffer()).cast("B")
                if key != now:
                    now, texts = key, []
                at = next((k for k, t in enumerate(texts) if same(t, mine)), len(texts))
                first = at == len(texts)
                if first:
                    texts.append(memoryview(bytes(mine)))
                variant.append(at)
                text.append(bytes(mine) if first and spread[i] > 1 else None)
            cols = [batch.column(names.index(c)) for c in names if c != "norm"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(variant, pa.int32()), pa.array(text, pa.binary())], names=[*(c for c in names if c != "norm"), "variant", "first_text"])

    return run


def classes(docs: DataFrame, huge: int = 16 << 20, spread: int = 1000, **params) -> tuple[DataFrame, DataFrame]:
    """(rows of repeated fingerprints with the class of their text: n_bytes, h1, h2, part, variant; rows that are alone)."""
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    seen = saved(fingerprinted(docs, huge, **params), "exact-prints")
    counts = seen.groupBy(*KEY).agg(F.count("*").alias("c")).filter("c > 1")
    counts = saved(counts, "exact-repeated")
    total = seen.count()
    often = max(2, -(-total // spread))  # at most `spread` fingerprints have so many rows
    hot = F.broadcast(counts.filter(F.col("c") >= often).select(*KEY, F.ceil(F.col("c") * 4 / often).cast("int").alias("salts")))
    repeated = counts.select(*KEY)
    alone = seen.join(repeated, KEY, "left_anti")

    rows = fingerprinted(docs, huge, keep_text=True, **params).join(repeated, KEY, "left_semi").join(hot, KEY, "left")
    rows = rows.withColumn("salts", F.coalesce("salts", F.lit(1)))
    salt = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.col("salts")).cast("int")
    cols = [*KEY, "salt", "salts", "doc_id", "text_sha256", "norm"]
    rows = rows.withColumn("salt", salt).select(*cols).repartition(parts, *KEY, "salt").sortWithinPartitions(*KEY, "salt")
    keys = "n_bytes long, h1 long, h2 long, salt int"
    met = rows.mapInArrow(_compared(cols, 4, 7, 4), f"{keys}, salts int, doc_id long, text_sha256 string, variant int, first_text binary")
    met = saved(met.withColumn("row", F.monotonically_increasing_id()), "exact-met")

    # the parts of a spread group: their first texts meet once more (at most 4 * spread of them, but for collisions)
    firsts = met.filter("first_text is not null").select(*KEY, "salt", F.col("variant").alias("local"), F.col("first_text").alias("norm"))
    firsts = firsts.repartition(parts, *KEY).sortWithinPartitions(*KEY, "salt", "local")
    told = firsts.mapInArrow(_compared([*KEY, "salt", "local", "norm"], 3, 5, None), f"{keys}, local int, variant int, first_text binary")
    told = saved(told.select(*KEY, "salt", "local", F.col("variant").alias("whole")), "exact-told")
    plain = met.drop("first_text")
    one = plain.filter("salts = 1").withColumn("class", F.col("variant"))
    many = plain.filter("salts > 1").join(told.withColumnRenamed("local", "variant"), [*KEY, "salt", "variant"])
    out = ["row", "doc_id", "text_sha256", *KEY, "class"]
    return one.select(*out).union(many.withColumn("class", F.col("whole")).select(*out)), alone


def exact_groups(docs: DataFrame, **params) -> DataFrame:
    """Every row: doc_id, keep_id (doc_id of the row that stays), group_size, kept, text_sha256."""
    rows, alone = classes(docs, **params)
    rows = saved(rows, "exact-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "row")).alias("f")
    groups = rows.groupBy(*KEY, "class").agg(first, F.count("*").alias("group_size"))
    groups = saved(groups.select(*KEY, "class", F.col("f.doc_id").alias("keep_id"), F.col("f.row").alias("keep_row"), "group_size"), "exact-groups")
    out = rows.join(groups, [*KEY, "class"]).select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")
    one = alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return out.union(one)


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """The documents that stay, with all their columns; of repeated rows (equal doc_id and text) any one."""
    found = exact_groups(docs, **params)
    stay = saved(found.filter("kept").select(F.col("doc_id").alias("k_doc"), F.col("text_sha256").alias("k_sha")), "exact-stay")
    sha = F.sha2(F.encode(F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " "), "utf-8"), 256)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), sha.alias("sha"))
    rows = rows.join(stay, F.col("id").eqNullSafe(F.col("k_doc")) & (F.col("sha") == F.col("k_sha")), "left_semi")
    if rows.groupBy("id", "sha").agg(F.count("*").alias("c")).filter("c > 1").limit(1).count():
        rows = rows.dropDuplicates(["id", "sha"])
    return rows.select("row.*")
