from decimal import Decimal

from pyspark.sql import functions as F

from touchline.functions import match_key
from touchline.operators.consolidate import consolidate
from touchline.operators.reconcile import ambiguous, reconcile, summary, unmatched


def _hub(spark):
    data = [
        (1, "Ana", "AT", 1, 2000),
        (2, "Ana", "AT", 1, 2000),  # same name + position + team as 1
        (3, "Bo", "DF", 2, 1999),
        (4, "Bo", "MT", 2, 1999),  # one name, two positions
        (5, "Cy", "GB", 3, 2001),
        (6, "Cy", "GB", 4, 2003),  # one name, two teams
    ]
    return spark.createDataFrame(data, "id long, name string, pos string, team int, born int")


def _facts(spark):
    perf = spark.createDataFrame(
        [(1, 3, 1), (2, 2, 0), (3, 0, 0), (4, 1, 1), (5, 0, 0), (6, 4, 2), (6, 1, 1)],  # id 6: two fact rows
        "id long, goals int, cards int",
    )
    time = spark.createDataFrame(
        [(1, 100, Decimal("1.11")), (2, 50, Decimal("0.56")), (3, 90, Decimal("1.00")), (4, 10, Decimal("0.11")),
         (5, 0, Decimal("0.00")), (6, 900, Decimal("10.00"))],
        "id long, minutes int, nineties decimal(6,2)",
    )
    return perf, time


def test_consolidate_merges_and_keeps_min_id(spark):
    perf, time = _facts(spark)
    v = consolidate(_hub(spark), [perf, time], ["name", "pos", "team"], ["goals", "cards", "minutes", "nineties"], "id")
    got = {(r.name, r.pos, r.team): (r.id_reference, r.goals, r.cards, r.minutes, r.nineties) for r in v.collect()}
    assert got[("Ana", "AT", 1)] == (1, 5, 1, 150, Decimal("1.67"))
    assert ("Bo", "DF", 2) in got and ("Bo", "MT", 2) in got  # different positions stay apart
    # Two fact rows for id 6 are added once; minutes are not doubled by the join.
    assert got[("Cy", "GB", 4)] == (6, 5, 3, 900, Decimal("10.00"))
    assert v.count() == 5


def test_consolidate_preserves_sums_and_is_idempotent(spark):
    perf, time = _facts(spark)
    measures = ["goals", "cards", "minutes", "nineties"]
    hub = _hub(spark)
    v = consolidate(hub, [perf, time], ["name", "pos", "team"], measures, "id")
    totals = v.agg(*[F.sum(m).alias(m) for m in measures]).first()
    assert totals.goals == 11 and totals.cards == 5 and totals.minutes == 1150
    again = consolidate(
        v.select(F.col("id_reference").alias("id"), "name", "pos", "team"),
        [v.select(F.col("id_reference").alias("id"), *measures)],
        ["name", "pos", "team"],
        measures,
        "id",
    )
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, v.collect()))


def _target(spark):
    data = [(10, "Jean Dupont", 30), (11, "Jean Dupont", 30), (12, "Jean Dupont", 25), (13, "Lea Martin", 22),
            (14, "Max Roy", 40), (15, "Max Roy", 41)]
    return spark.createDataFrame(data, "id long, name string, age int").select(
        "id", match_key("name").alias("k_name"), F.col("age").alias("k_age")
    )


def _source(spark):
    data = [
        (100, "  JEAN DUPONT ", 25, None),  # name + age -> 12
        (101, "jean dupont", 31, None),  # age off -> name only, two candidates+ -> lowest id 10
        (102, "Lea Martin", 99, None),  # name only -> 13
        (103, "Nobody", 20, None),  # nothing
        (104, "Max Roy", 40, None),  # name + age -> 14 (pass 1 wins over pass 2)
        (105, "Max Roy", None, 15),  # already linked: kept
        (106, None, 30, None),  # no name: no match
    ]
    return spark.createDataFrame(data, "src long, name string, age int, id long").withColumns(
        {"k_name": match_key("name"), "k_age": F.col("age")}
    )


def test_reconcile_passes_and_lowest_id(spark):
    out = reconcile(_source(spark), _target(spark), [["k_name", "k_age"], ["k_name"]], "id", "id")
    got = {r.src: (r.id, r.matched_pass, r.n_candidates) for r in out.collect()}
    assert got[100] == (12, 1, 1)
    assert got[101] == (10, 2, 3)
    assert got[102] == (13, 2, 1)
    assert got[103] == (None, None, None)
    assert got[104] == (14, 1, 1)
    assert got[105] == (15, 0, None)
    assert got[106] == (None, None, None)
    assert out.count() == 7  # one row per source row, never a candidate fan-out


def test_reconcile_reports(spark):
    out = reconcile(_source(spark), _target(spark), [["k_name", "k_age"], ["k_name"]], "id", "id")
    s = summary(out, "id").first()
    assert (s.total, s.linked, s.unlinked) == (7, 5, 2)
    assert s.total == s.linked + s.unlinked
    assert [r.src for r in unmatched(out, "id", ["src"]).collect()] == [103, 106]
    assert [r.src for r in ambiguous(out).collect()] == [101]


def test_reconcile_pass_one_is_never_overridden(spark):
    one = reconcile(_source(spark), _target(spark), [["k_name", "k_age"]], "id", "id")
    two = reconcile(_source(spark), _target(spark), [["k_name", "k_age"], ["k_name"]], "id", "id")
    first = {r.src: r.id for r in one.collect() if r.id is not None}
    second = {r.src: r.id for r in two.collect()}
    assert all(second[k] == v for k, v in first.items())


def test_lookup_join_splits_hot_keys(spark):
    from touchline.operators.joins import lookup_join

    big = spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
    )
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    plain = sorted(map(tuple, big.join(lookup, ["k"], "left").select("row", "k", "v").collect()))
    split = lookup_join(big, lookup, ["k"], "left", min_rows=100)
    assert sorted(map(tuple, split.select("row", "k", "v").collect())) == plain
    inner = lookup_join(big, lookup, ["k"], "inner", min_rows=100)
    assert inner.count() == big.join(lookup, ["k"]).count()
    # The hot key's rows meet the lookup through a broadcast, not a shuffle.
    assert "BroadcastHashJoin" in split._jdf.queryExecution().executedPlan().toString()


def test_reconcile_with_a_hot_name(spark):
    src = spark.range(3000).select(
        F.col("id").alias("src"),
        F.when(F.col("id") % 3 == 0, F.lit("jean dupont")).otherwise(F.lit("lea martin")).alias("k_name"),
        F.lit(30).alias("k_age"),
    )
    out = reconcile(src, _target(spark), [["k_name", "k_age"], ["k_name"]], "id", "id", hot_key_rows=100)
    got = {(r.k_name, r.id, r.matched_pass, r.n_candidates): r.c for r in out.groupBy("k_name", "id", "matched_pass", "n_candidates").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert got == {("jean dupont", 10, 1, 2): 1000, ("lea martin", 13, 2, 1): 2000}


def test_lookup_join_without_hot_keys_is_a_plain_join(spark):
    from touchline.operators.joins import lookup_join

    big = spark.range(100).select(F.col("id").alias("row"), (F.col("id") % 10).alias("k"))
    lookup = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = lookup_join(big, lookup, ["k"], "left", min_rows=1000)
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.select("row", "v").collect())) == [(i, (i % 10) * 2) for i in range(100)]


def test_lookup_join_null_flood_is_split(spark):
    from touchline.operators.joins import lookup_join

    big = spark.range(500).select(
        F.col("id").alias("row"), F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.lit("a")).alias("k")
    )
    lookup = spark.createDataFrame([("a", 1)], "k string, v int")
    out = lookup_join(big, lookup, ["k"], "left", min_rows=100)
    got = {r.k: r.c for r in out.groupBy("k").agg(F.count("v").alias("c")).collect()}
    assert got == {None: 0, "a": 250}
    assert out.count() == 500


def test_hot_keys_by_level_matches_separate_aggregations(spark):
    from touchline.operators.joins import hot_keys, hot_keys_by_level

    df = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.concat(F.lit("n"), (F.col("id") % 40).cast("string"))).alias("name"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise((F.col("id") % 3).cast("int")).alias("age"),
    )
    levels = [["name", "age"], ["name"]]
    together = hot_keys_by_level(df, levels, min_rows=40)
    for level, got in zip(levels, together):
        want = hot_keys(df, level, min_rows=40)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_reconcile_decides_all_passes_in_one_join(spark):
    out = reconcile(_source(spark), _target(spark), [["k_name", "k_age"], ["k_name"]], "id", "id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_reconcile_forms_agree(spark, monkeypatch):
    """Nested candidates, and the chain for too many candidates or no common key, link alike (ids, passes, counts)."""
    from touchline.operators import reconcile as module

    target = spark.range(400).select(
        F.col("id"), F.when(F.col("id") % 9 == 0, None).otherwise(F.concat(F.lit("n"), (F.col("id") % 23).cast("string"))).alias("k_name"),
        F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 5).cast("int")).alias("k_age"), (F.col("id") % 3).cast("int").alias("k_club"),
    )
    source = spark.range(900).select(
        F.col("id").alias("src"), F.when(F.col("id") % 3 == 0, F.lit("n1")).otherwise(F.concat(F.lit("n"), (F.col("id") % 29).cast("string"))).alias("k_name"),
        F.when(F.col("id") % 8 == 0, None).otherwise((F.col("id") % 6).cast("int")).alias("k_age"), (F.col("id") % 4).cast("int").alias("k_club"),
    )
    passes = [["k_name", "k_age", "k_club"], ["k_name", "k_club"], ["k_name", "k_age"], ["k_name"]]
    key = lambda df: sorted(map(tuple, df.select("src", "id", "matched_pass", "n_candidates").collect()))
    nested = reconcile(source, target, passes, "id", "id")
    assert nested._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    want = key(nested)
    monkeypatch.setattr(module, "NEST_MAX", 1)
    chained = reconcile(source, target, passes, "id", "id", hot_key_rows=50)
    assert chained._jdf.queryExecution().optimizedPlan().toString().count("Join ") > 1 and key(chained) == want
    monkeypatch.undo()
    none = reconcile(source, target, [["k_name"], ["k_age"]], "id", "id")
    assert none._jdf.queryExecution().optimizedPlan().toString().count("Join ") > 1 and none.count() == 900
