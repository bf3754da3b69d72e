"""Packing and mixing: exact round trips, quotas and bounds."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import SCHEMA, WORD, invented, raw
from touchline.llm.mixing import mix_report, mixture, split_quotas, targets
from touchline.llm.packing import ChunkEncoder, best_filled, pack, pieces, plan_sequences, solve_configurations
from touchline.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def expected(tokenizer, rows, capacity):
    out = []
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for k, lo in enumerate(range(0, len(ids), capacity)):
            part = ids[lo : lo + capacity]
            out.append((r[0], k, lo, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return Counter(out)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pack_round_trip(spark, tokenizer, capacity):
    rows = invented()
    got = pack(spark.createDataFrame(rows, SCHEMA).repartition(3), tokenizer_path(), capacity).collect()
    assert Counter((g.doc_id, g.piece, g.start, g.length, g.ids_crc32) for g in got) == expected(tokenizer, rows, capacity)
    seqs = defaultdict(list)
    for g in got:
        seqs[g.sequence_id].append((g.offset, g.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(g.length for g in got)
    assert len(seqs) <= 1.05 * total / capacity + 2


def test_pack_empty(spark):
    assert pack(spark.createDataFrame([], SCHEMA), tokenizer_path()).count() == 0


@pytest.mark.parametrize("text", ["", " ", "don't  stop\tnow\n\nx.y, 12 é é ΑΣ İ ...", "<|endoftext|> a<|endoftext|>b", "a\x85b\x1cc d", "Word, word. WORD! ́x"])
def test_chunk_encoder_agrees_with_the_tokenizer(tokenizer, text):
    assert ChunkEncoder(tokenizer).encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_plan_places_every_length_once():
    rng = np.random.default_rng(2)
    for capacity in (50, 4096):
        h = Counter(rng.integers(1, capacity + 1, 3000).tolist()) + Counter({capacity // 3: 500})
        plan = plan_sequences(dict(h), capacity)
        placed = Counter()
        for content, k in plan:
            assert sum(content) <= capacity and k > 0
            for n in content:
                placed[n] += k
        assert placed == h
    assert plan_sequences({}, 10) == []


def test_configurations_reach_the_known_optimum():
    assert sum(n for _, n in solve_configurations([6, 4], [10, 10], 10)) == pytest.approx(10)
    assert best_filled(np.array([5, 3]), np.array([0.5, 0.34]), 9)[1] == pytest.approx(1.02)


def test_targets():
    assert targets([100, 100, 100]) == pytest.approx([200, 166.6666667, 83.3333333])
    assert targets([10, 1000]) == pytest.approx([20, 1495])
    assert targets([]) == [] and targets([0, 0]) == [0, 0]


def test_quotas_are_exact():
    draws = np.array([7, 0, 130, 41])
    q = split_quotas(draws, 9, 3)
    assert q.sum(axis=0).tolist() == draws.tolist() and q.sum(axis=1).max() - q.sum(axis=1).min() <= 1


def test_mix_report(spark):
    rows = invented(n=400)
    df = spark.createDataFrame([(*r, "t", 3) for r in rows], SCHEMA + ", target string, size int").repartition(4)
    got = mix_report(df).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(WORD.findall(raw(r[1])))
    names = sorted(x for x in size if x is not None) + [None]
    want = dict(zip(names, targets([size[x] for x in names]), strict=True))
    taken, most = Counter(), Counter()
    assert Counter((g.doc_id, g.size) for g in got) == Counter((r[0], len(WORD.findall(raw(r[1])))) for r in rows)
    for g in got:
        assert g.source_size == size[g.source] and g.target == pytest.approx(want[g.source]) and 0 <= g.taken <= 2 * g.size
        taken[g.source] += g.taken
        most[g.source] = max(most[g.source], g.size)
    for s in names:
        assert abs(taken[s] - want[s]) <= most[s]
    again = mix_report(df.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mixture_repeats_rows_as_reported(spark):
    rows = invented(n=200)
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixture(df)
    assert out.columns == df.columns
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(raw(r.text)))
    told = Counter()
    for g in mix_report(df).collect():
        told[g.doc_id] += g.taken
    assert +words == +told
    assert mix_report(df.limit(0)).count() == mixture(df.limit(0)).count() == 0


def _equal_rows(word: str, n: int = 600):
    """Three sources of one thousand documents; ``n`` rows of the last one are equal, without an id."""
    rng = np.random.default_rng(len(word))
    text = lambda k: " ".join(word + str(x) for x in rng.integers(0, 10**6, k))
    rows = [(i, text(100 if i < 2000 else 50), "en", f"src{i // 1000}", 0) for i in range(3000 - n)]
    return rows + [(None, " ".join(f"{word}{k}" for k in range(50)), "en", "src2", 0)] * n


@pytest.mark.parametrize("word", ["a", "lorem", "xyz"])
def test_a_large_group_of_equal_rows_is_split(spark, word):
    """Equal rows have places of their own: the source meets its target, whatever the order and number of partitions."""
    rows = _equal_rows(word)
    told = []
    for parts in (1, 5):
        got = mix_report(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
        taken = Counter()
        for g in got:
            assert 0 <= g.taken <= 2 * g.size
            taken[g.source] += g.taken
        for g in got:
            assert abs(taken[g.source] - g.target) <= 100
        told.append(Counter(map(tuple, got)))
    assert told[0] == told[1]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sum(len(r.text.split()) for r in mixture(df).collect()) == sum(r.taken for r in mix_report(df).collect())


def test_the_tree_decides_what_is_taken(spark, monkeypatch):
    """With another tree other documents are taken, and the shards' quotas are those of the tree."""
    from touchline.llm import mixing

    df = spark.createDataFrame(invented(n=800), SCHEMA)
    want = Counter(map(tuple, mix_report(df).collect()))

    def first_shards(draws, shards, seed, sizes=None):
        """Sources in turn instead of draws."""
        sizes = [int(draws.sum()) * (i + 1) // shards - int(draws.sum()) * i // shards for i in range(shards)] if sizes is None else list(sizes)
        out, left = np.zeros((shards, len(draws)), np.int64), draws.copy()
        for i, n in enumerate(sizes):
            for s in range(len(draws)):
                k = min(int(left[s]), int(n))
                out[i, s], left[s], n = k, left[s] - k, n - k
        return out

    monkeypatch.setattr(mixing, "split_quotas", first_shards)
    other = Counter(map(tuple, mix_report(df).collect()))
    assert want != other
    taken = lambda told: Counter({(r[0], r[1], r[5]): n for r, n in told.items()})
    assert taken(want) != taken(other)


def test_many_sources(spark, monkeypatch):
    """More sources than rows of a broadcast plan, and groups of several sources, mix as few do."""
    from touchline.llm import mixing

    monkeypatch.setattr(mixing, "PLAN_ROWS", 10)
    monkeypatch.setattr(mixing, "GROUPS", 7)
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "en", f"s{i % 500:03d}", 0) for i in range(6000)]
    got = mix_report(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1].split())
    names = sorted(size)
    want = dict(zip(names, targets([size[s] for s in names]), strict=True))
    taken = Counter()
    for g in got:
        taken[g.source] += g.taken
        assert g.target == pytest.approx(want[g.source])
    assert len(got) == 6000 and all(abs(taken[s] - want[s]) <= 9 for s in names)


def test_drawn_blocks():
    """Every block once before any twice; the words reach the target."""
    from touchline.llm.mixing import planned

    words = {b: 10 + b for b in range(20)}
    for target in (0.0, 5.0, 150.0, 390.0, 391.0, 600.0, 780.0):
        plan = planned("s", words, target, np.array([3, 0, 9, 8]), 1)
        assert sum(w * plan[b][0] + (plan[b][1] or 0) for b, w in words.items()) == pytest.approx(target, abs=0.5)
        draws = [len(p[2]) for p in plan.values()]
        assert max(draws) - min(draws) <= 1 and sum(p[1] is not None for p in plan.values()) <= 1
