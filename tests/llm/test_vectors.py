"""Vector searches against brute force."""

import numpy as np
import pytest

from touchline.llm import queries
from touchline.llm.bit_sliced import BitSlices, quantise, top_inner_products
from touchline.llm.multi_index import MultiIndex, codes, fit_codes, hamming, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def rows(n=300, d=12, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)).astype(np.float32)
    x[200:260] = x[0]
    out = [(i, [float(v) for v in x[i]], 0, "x") for i in range(n)]
    out[5] = (5, None, 0, "x")
    out[6] = (6, [], 0, "x")
    out[7] = (7, [float("nan")] * d, 0, "x")
    out[8] = (8, [float("inf")] + [0.0] * (d - 1), 0, "x")
    out[9] = (9, [None] + [0.0] * (d - 1), 0, "x")
    out[100] = (100, [0.0] * d, 0, "x")
    out[11] = (11, [1.0, 2.0], 0, "x")
    out += [(None, [1.0] * d, 0, "x"), out[50], out[50], out[60]]
    return out


def valid(data, zero=True):
    good = [(r[0], np.array(r[1], float)) for r in data if r[0] is not None and r[1] and all(v is not None and np.isfinite(v) for v in r[1])]
    return good if zero else [g for g in good if g[1].any()]


def brute_inner(data, every, k):
    good, out = valid(data), []
    for q, v in {i: x for i, x in good if i % every == 0}.items():
        s = [(-int((quantise(v) * quantise(x)).sum()), i) for i, x in good if i != q and len(x) == len(v)]
        out += [(q, r + 1, i, -a) for r, (a, i) in enumerate(sorted(s)[:k])]
    return sorted(out)


def brute_nearest(data, every, k):
    good, out = valid(data, False), []
    for q, v in {i: x for i, x in good if i % every == 0}.items():
        s = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in good if i != q and len(x) == len(v))[:k]
        out += [(q, r + 1, i, a) for r, (a, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [16384, 64])
def test_top_inner_products_invented(spark, block_rows):
    data = rows()
    got = top_inner_products(spark.createDataFrame(data, SCHEMA), every=10, block_rows=block_rows, query_rows=7)
    assert sorted(map(tuple, got.collect())) == brute_inner(data, 10, 5)


def test_bit_slices_sum_exactly():
    rng = np.random.default_rng(1)
    for top in (1, 3, 300, 1 << 40):
        v, q = rng.integers(-top, top + 1, (130, 5)), rng.integers(-top, top + 1, 5)
        index = BitSlices(v)
        want = sorted((-sum(int(a) * int(b) for a, b in zip(r, q, strict=True)), i) for i, r in enumerate(v))[:9]
        assert sorted((-s, r) for r, s in index.top(q, 9, index.valid)) == want


def test_small_tables(spark, smoke_dir):
    data = [tuple(r)[:2] for r in spark.read.parquet(f"{smoke_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, queries.op10_top_k_search(spark, smoke_dir).collect())) == brute_inner(data, 50, 5)
    got = sorted(map(tuple, queries.op2_nearest_neighbours(spark, smoke_dir).collect()))
    want = brute_nearest(data, 100, 10)
    assert len(got) == len(want) and recall(got, want) >= 0.9


def recall(got, want):
    return len({g[:1] + g[2:3] for g in got} & {w[:1] + w[2:3] for w in want}) / max(1, len(want))


@pytest.mark.parametrize("block_rows", [16384, 100])
def test_nearest_invented(spark, block_rows):
    data = rows()
    got = sorted(map(tuple, nearest(spark.createDataFrame(data, SCHEMA), every=10, block_rows=block_rows, query_rows=7).collect()))
    want = brute_nearest(data, 10, 10)
    assert len(got) == len(want) and recall(got, want) >= 0.9
    where = {(w[0], w[2]): w[3] for w in brute_nearest(data, 10, 400)}
    assert all(abs(where[g[0], g[2]] - g[3]) < 1e-12 for g in got)


def test_nearest_recall_at_sf001(spark):
    sf = "/root/testdata/sf0.01"
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert recall(list(map(tuple, queries.op2_nearest_neighbours(spark, sf).collect())), brute_nearest(data, 100, 10)) >= 0.9


def test_pigeonhole_probes_miss_no_code():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((500, 16))
    code = codes(x, *fit_codes(x, turns=3))
    index = MultiIndex(code)
    for q in range(0, 500, 50):
        for radius in (0, 2, 3, 7, 14, 22):
            assert index.within(code[q], radius).tolist() == np.flatnonzero(hamming(code, code[q]) <= radius).tolist()


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert top_inner_products(empty).count() == nearest(empty).count() == 0


def test_one_id_with_many_vectors(spark):
    """An id on a third of the rows, with different vectors: the smallest asks, whatever the partitions; its rows are its own."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((120, 6)).astype(np.float32)
    data = [(50 if i < 40 else i, [float(c) for c in v], 0, "x") for i, v in enumerate(x)]
    told = []
    for parts in (1, 3, 5):
        df = spark.createDataFrame(data, SCHEMA).repartition(parts)
        told.append([sorted(map(tuple, f(df, every=10, block_rows=16).collect())) for f in (top_inner_products, nearest)])
    assert told[0] == told[1] == told[2]
    asked = min(v for i, v, *_ in data if i == 50)
    others = [(i, v) for i, v, *_ in data if i != 50]
    want = sorted((-int((quantise(np.array(asked)) * quantise(np.array(v))).sum()), i) for i, v in others)[:5]
    assert [(r[2], r[3]) for r in told[0][0] if r[0] == 50] == [(i, -s) for s, i in want]


def test_cells_build_once_and_stream_the_queries(spark):
    """More queries do not copy the vectors again, and a cell's index is built once."""
    from touchline.llm import vector_grid

    data = rows()
    df = vector_grid.usable_vectors(spark.createDataFrame(data, SCHEMA))
    built = spark.sparkContext.accumulator(0)

    def build(ids, x):
        built.add(1)
        return len(ids)

    from touchline.llm.bit_sliced import FOUND_ARROW

    plan = vector_grid.in_cells(df, vector_grid.distinct_queries(df, 1), build, lambda n, q, v: [(q, n, n)], FOUND_ARROW, 64, 65536)
    seen = {}
    for r in plan.collect():
        seen[r[0]] = seen.get(r[0], 0) + r[1]
    assert set(seen.values()) >= {sum(len(v) == 12 for _, v in ((r.vec_id, r.vector) for r in df.collect()))}
    assert built.value <= 2 * -(-df.count() // 64)  # a block, and a vector length


def test_probes_meet_few_codes():
    """Long substrings: on isotropic vectors the probes meet under a third of the codes at the fitted radius."""
    from touchline.llm.multi_index import fit_radius

    rng = np.random.default_rng(2)
    x = rng.standard_normal((6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centre, projections = fit_codes(x[:2000])
    code = codes(x, centre, projections)
    radius = fit_radius(x[:2000], code[:2000], 10, 0.97)
    index, met = MultiIndex(code), []
    for q in range(0, 6000, 300):
        share, more = divmod(radius + 1, code.shape[1])
        seen = np.zeros(len(code), bool)
        for j in range(code.shape[1]):
            seen |= np.bitwise_count(code[:, j] ^ code[q, j]) <= share - 1 + (j < more)
        met.append(seen.mean())
        assert index.within(code[q], radius).tolist() == np.flatnonzero(hamming(code, code[q]) <= radius).tolist()
    assert np.mean(met) < 1 / 3, np.mean(met)
