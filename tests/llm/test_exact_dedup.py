"""Exact deduplication against a dictionary of normalised texts."""

import hashlib
import re

import numpy as np
import pytest

from touchline.llm import exact_dedup as ex
from tests.llm.fixtures import SCHEMA, invented

BLANKS = re.compile(rb"[\x20\x09-\x0D]+")


def norm(text):
    return BLANKS.sub(b" ", (text or "").encode())


def brute(rows):
    """(doc_id, keep_id, group_size, sha) of every row, and the number of kept rows by text."""
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(((r[0], least[norm(r[1])], len(groups[norm(r[1])]), hashlib.sha256(norm(r[1])).hexdigest()) for r in rows), key=str)


def hard_rows():
    rows = invented(n=40)
    copies = [(1000 + i, rows[7][1].replace(" ", " \t" if i % 2 else "\n"), "en", "s", 0) for i in range(60)]
    nulls = [(None, "the same words", "en", "s", 0)] * 30 + [(None, None, None, None, None), (None, "", "en", "s", 0)]
    long = [(2000 + i, ("lorem  ipsum\n\n" * 9000) + "x" * (i // 2), "en", "s", 0) for i in range(4)]
    edges = [(3000, " a", "en", "s", 0), (3001, "a", "en", "s", 0), (3002, "\ta", "en", "s", 0), (3003, "a ", "en", "s", 0), (3004, "a b", "en", "s", 0), (3005, "a b", "en", "s", 0)]
    return rows + copies + nulls + long + edges


@pytest.mark.parametrize("params", [{}, {"huge": 500, "piece_bytes": 97, "spread": 10}, {"spread": 3}])
def test_groups(spark, params):
    rows = hard_rows()
    got = ex.exact_groups(spark.createDataFrame(rows, SCHEMA).repartition(4), **params).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == brute(rows)
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len({norm(r[1]) for r in rows})  # exactly one row of each text
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_equal_fingerprints_of_different_texts(spark, monkeypatch):
    """Results rest on the comparison: with one fingerprint a length, texts of one length still stay apart."""
    rows = [(i, f"text {i % 7} of one length", "en", "s", 0) for i in range(70)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = ex.fingerprinted

    def flat(*a, **b):
        from pyspark.sql import functions as F

        return found(*a, **b).withColumns({"h1": F.lit(0).cast("long"), "h2": F.lit(0).cast("long")})

    monkeypatch.setattr(ex, "fingerprinted", flat)
    for spread in (1000, 2):
        got = ex.exact_groups(docs, spread=spread).collect()
        assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == {(i, i % 7, 10) for i in range(70)}


def test_composition():
    """Hashes of pieces compose to the hash of the whole, wherever it is cut."""
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 300_000).astype(np.uint8)
    powers = ex.Powers()
    whole = ex.fingerprints(data, np.array([0, len(data)]), powers)[:, 0]
    for cut in (0, 1, 65_535, 65_536, 123_457):
        for k, base in enumerate(ex.BASES):
            a, b = (int(ex.fingerprints(x, np.array([0, len(x)]), powers)[k, 0]) for x in (data[:cut], data[cut:]))
            assert (a * pow(base, len(data) - cut, ex.PRIME) + b) % ex.PRIME == whole[k]
    slow = 0
    for c in data[:5000].tolist():
        slow = (slow * ex.BASES[0] + c) % ex.PRIME
    assert ex.fingerprints(data[:5000], np.array([0, 5000]), powers)[0, 0] == slow
    by_piece = ex.fingerprints(data, np.array([0, len(data)]), powers, most=1000)[:, 0]
    assert (by_piece == whole).all()


def test_keep_one_and_edges(spark):
    rows = hard_rows()
    kept = ex.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(norm(r["text"]) for r in kept) == sorted({norm(r[1]) for r in rows}) and len(kept[0]) == 5
    empty = spark.createDataFrame([], SCHEMA)
    assert ex.exact_groups(empty).count() == 0 and ex.keep_one(empty).count() == 0
    clash = spark.createDataFrame([(1, "a", 2, 3, "z"), (2, "a", 2, 3, "z")], "doc_id long, text string, n_bytes int, row int, class string")
    assert sorted((r["doc_id"], r["kept"]) for r in ex.exact_groups(clash).collect()) == [(1, True), (2, False)]
