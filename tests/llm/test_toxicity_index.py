"""The toxicity index: how many examples a search meets."""

import numpy as np

from touchline.llm.toxicity import BlockMaxIndex, weigh


def test_a_better_floor_spares_most_dense_parts():
    """Examples made of dense terms only: nearly all bounds reach the first floor, few dense parts are added, the answer is exact."""
    rng = np.random.default_rng(3)
    idf = rng.random(60) + 0.1
    pick = lambda: weigh({int(t): int(rng.integers(1, 4)) for t in rng.choice(60, 20, replace=False)}, idf)
    vecs = [pick() for _ in range(4000)]
    base, near_base = pick(), []
    for _ in range(20):  # near the queries, in one block
        t, w = base
        near_base.append((t, w * (1 + 0.02 * rng.random(len(w)))))
    vecs[640:660] = [(t, w / np.sqrt((w * w).sum())) for t, w in near_base]
    dense = np.zeros((len(vecs), 60))
    for i, (t, w) in enumerate(vecs):
        dense[i, t] = w
    index, met = BlockMaxIndex(vecs), []
    add = index._dense
    index._dense = lambda ids, *more: met.append(len(ids)) or add(ids, *more)
    t, w = base
    s = np.round(dense[:, t] @ w, 9)
    assert [j for _, j in index.nearest(t, w, 9)] == np.lexsort((np.arange(len(s)), -s))[:9].tolist()
    assert sum(met) < len(vecs) / 4
    for k in (1, 9, 64, 100):  # also more neighbours than are met first
        for t, w in (pick() for _ in range(5)):
            s = np.round(dense[:, t] @ w, 9)
            assert [j for _, j in index.nearest(t, w, k)] == np.lexsort((np.arange(len(s)), -s))[:k].tolist()
