"""Deduplication operators against brute force, on invented documents and on the small tables."""

import random

import numpy as np
import pytest

from tests.llm.fixtures import SCHEMA, brute_bytes, brute_components, brute_windows, invented
from touchline.llm import ngram_join, queries, suffix_dedup
from touchline.llm.ngram_join import keep_one, near_duplicates
from touchline.llm.substring_dedup import window_report
from touchline.llm.suffix_dedup import merge_runs, encode_run, read_run, removal_report, shared_prefix, without_repeats


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


SHA5 = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
SHA7 = ("doc_id", "n_words", "n_removed", "kept_sha256")
SETS = ("doc_id", "n_shingles", "component_id")


@pytest.fixture(scope="module")
def small(spark, smoke_dir):
    return [tuple(r) for r in spark.read.parquet(f"{smoke_dir}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def mine(spark):
    rows = invented()
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_suffix_dedup_small_table(spark, smoke_dir, small):
    assert tuples(queries.op5_suffix_dedup(spark, smoke_dir), *SHA5) == brute_bytes(small)


def test_suffix_dedup_invented(mine):
    rows, df = mine
    assert tuples(removal_report(df), *SHA5) == brute_bytes(rows)


def test_suffix_dedup_splits_hot_cores(mine):
    rows, df = mine
    assert tuples(removal_report(df, hot=3), *SHA5) == brute_bytes(rows)


def test_suffix_dedup_small_blocks(mine):
    rows, df = mine
    assert tuples(removal_report(df, block_bytes=2000), *SHA5) == brute_bytes(rows)


def test_suffix_dedup_pieces_of_long_texts():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    data[3000:3700] = data[500:1200]
    poly = suffix_dedup.Poly()
    whole = suffix_dedup.window_runs(data, np.array([0, 5000]), 400, poly)
    parts = suffix_dedup.window_runs(data, np.array([0, 5000]), 400, poly, piece=700)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(2)
    runs, plain = [], []
    for r in range(7):
        own = sorted({(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))), bytes(rng.choice(b"xy") for _ in range(3))) for _ in range(rng.randint(0, 60))})
        plain += [x for x, _ in own]
        runs.append(encode_run(own, list(range(len(own))), [False] * len(own)))
        assert [(x, y) for _, x, y, _, _ in read_run(runs[-1])] == own
    got = list(merge_runs(runs))
    assert [g[1] for g in got] == sorted(plain)
    assert [g[0] for g in got][1:] == [shared_prefix(a[1], b[1]) for a, b in zip(got[:-1], got[1:], strict=True)]


def test_stage_without_repeats_keeps_rows_and_columns(mine):
    rows, df = mine
    extra = df.selectExpr("*", "1 as spans", "'x' as cells", "2 as node")
    out = without_repeats(extra)
    assert out.columns == extra.columns and out.count() == len(rows)
    removed = {r["doc_id"]: r["n_removed"] for r in removal_report(df).collect()}
    for r in out.collect():
        assert r["n_chars"] is None or r["n_chars"] == len(r["text"])
        if r["text"] is not None and removed[r["doc_id"]] == 0:
            assert (r["doc_id"], r["text"]) in {(x[0], x[1]) for x in rows}


def test_substring_dedup_small_table(spark, smoke_dir, small):
    assert tuples(queries.op7_substring_dedup(spark, smoke_dir), *SHA7) == brute_windows(small)


def test_substring_dedup_invented(spark, mine):
    rows, df = mine
    assert tuples(window_report(df), *SHA7) == brute_windows(rows)
    with_null = [*rows, (None, rows[2][1], "en", "s", 1)]
    assert tuples(window_report(spark.createDataFrame(with_null, SCHEMA), block_bytes=3000), *SHA7) == brute_windows(with_null)


def test_ngram_join_small_table(spark, smoke_dir, small):
    assert tuples(queries.op6_ngram_jaccard(spark, smoke_dir), *SETS) == brute_components(small)


def test_ngram_join_invented(mine):
    rows, df = mine
    assert tuples(near_duplicates(df), *SETS) == brute_components(rows)


def chains(n=40, words=60, seed=5):
    """Documents that drift: neighbours are linked, ends are not; and many that share frequent shingles only."""
    rng = random.Random(seed)
    ws = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(n):
        rows.append((i, " ".join(ws), "en", "s", 0))
        ws = ws[rng.randint(1, 3) :] + [f"n{i}-{k}" for k in range(2)]
    common = " ".join(f"c{k}" for k in range(40))
    for i in range(40):
        rows.append((100 + i, common + " " + " ".join(f"d{i // 2}-{k}" for k in range(rng.randint(4, 14))), "en", "s", 0))
    return rows


@pytest.mark.parametrize("few", [64, 2])
def test_ngram_join_chains_and_frequent_tokens(spark, few, monkeypatch):
    monkeypatch.setattr(ngram_join, "LOCAL_MANY", 3)
    rows = chains()
    assert tuples(near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), few=few), *SETS) == brute_components(rows)


def test_keep_one_per_component(spark, mine):
    rows, df = mine
    kept = keep_one(df.selectExpr("*", "0 as comp", "'y' as row"))
    assert kept.columns == [*df.columns, "comp", "row"]
    groups = {d: c for d, _, c in brute_components(rows)}
    want = sorted({c for d, c in groups.items()})
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert removal_report(empty).count() == window_report(empty).count() == near_duplicates(empty).count() == 0
    assert without_repeats(empty).count() == keep_one(empty).count() == 0


def test_many_equal_rows_stay_one_to_one(spark, monkeypatch):
    """5,000 equal rows without an id: the join of texts with what the buckets told gives a row a row, results as ever."""
    from touchline.llm import common, substring_dedup

    rng = random.Random(5)
    text = lambda k: " ".join("".join(rng.choice("abcdefghik") for _ in range(rng.randint(3, 8))) for _ in range(k))
    copy = text(80)
    rows = [(None, copy, "en", "s", 0)] * 5000 + [(1, text(90) + " " + copy, "en", "s", 0), (2, text(90), "en", "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    joined = []

    def counted(*args):
        out = common.opened_rows(*args)
        joined.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "opened_rows", counted)
    monkeypatch.setattr(substring_dedup, "opened_rows", counted)
    some = [r for i, r in enumerate(rows) if i < 2 or i >= 5000]
    want5, want7 = brute_bytes(some), brute_windows(some)
    got5, got7 = tuples(removal_report(df), *SHA5), tuples(window_report(df), *SHA7)
    assert len(got5) == len(got7) == 5002 and set(got5) == set(want5) and set(got7) == set(want7)
    assert joined and all(n <= 5002 for n in joined)


def test_planted_passages_of_400_bytes_and_more(spark):
    """Passages of 400 bytes and more planted in otherwise clean documents: all caught by n_removed, clean documents left alone."""
    rng = random.Random(11)
    text = lambda k: " ".join("".join(rng.choice("abcdefghiklmnoprstuvz") for _ in range(rng.randint(2, 9))) for _ in range(k))
    passages = []
    while len(passages) < 12:
        p = text(rng.randint(70, 140))
        passages += [p] if len(p) >= 400 else []
    planted = [(i, f"{text(60)} {passages[i % 12]} {text(60)}", "en", "s", 0) for i in range(48)]
    clean = [(100 + i, text(rng.randint(1, 400)), "en", "s", 0) for i in range(60)]
    got = {r["doc_id"]: r for r in removal_report(spark.createDataFrame(planted + clean, SCHEMA).repartition(4)).collect()}
    assert all(got[i]["n_removed"] >= len(passages[i % 12]) for i in range(48))
    assert all(got[r[0]]["n_removed"] == 0 for r in clean)
