"""The n-gram join keeps out of its shuffles what no later step asks for."""

from __future__ import annotations

from touchline.llm import ngram_join


def _classes(spark):
    bits = [0] * ngram_join.BITMAP
    other = [-1, -1] + bits[2:]
    rows = [(1, 4, 0, [11, 12, 13, 14], bits), (2, 4, 0, [11, 12, 13, 14], bits), (3, 4, 0, [11, 22, 23, 24], other)]
    return spark.createDataFrame(rows, "node long, n long, alone long, tokens array<long>, bits array<long>")


def test_star_rounds_hand_on_only_tokens_of_several_components(spark):
    rows = [(11, 1, 4, 0, 1), (11, 2, 4, 0, 2), (12, 1, 4, 1, 1), (13, 3, 4, 1, 3)]
    own = spark.createDataFrame(rows, "token long, node long, n long, i int, comp long")
    links, left = ngram_join._star_round(own, _classes(spark), 75, 0)
    assert {tuple(sorted(r)) for r in links.collect()} == {(1, 2)}
    assert sorted(tuple(r) for r in left.select("token", "node", "n", "i").collect()) == [(11, 1, 4, 0), (11, 2, 4, 0)]


def test_token_lists_are_joined_for_possible_pairs_only(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    near = ngram_join._near(pairs, _classes(spark), 75, "test-near")
    assert [tuple(r) for r in near.collect()] == [(1, 2)]
    some = ngram_join._only(_classes(spark), near.selectExpr("a as node"), "test-only")
    assert [r["node"] for r in some.collect()] == [1]
    assert [tuple(r) for r in ngram_join._verified(near, _classes(spark), 75, "test-verified").collect()] == [(1, 2)]
