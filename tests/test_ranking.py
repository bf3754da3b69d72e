from pyspark.sql import functions as F

from touchline.operators.ranking import asc, best_per_group, desc, ranked_shortlist, top_k
from touchline.operators.shares import share_of_total


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _players(spark):
    # Equal top values inside a group and at the cut of the top-k.
    data = [
        (1, "A", 10.0), (2, "A", 10.0), (3, "A", 7.0),
        (4, "B", 5.0), (5, "B", None), (6, "B", 5.0),
        (7, "C", 10.0), (8, "C", 1.0),
    ]
    return spark.createDataFrame(data, "id long, team string, v double")


def test_top_k_tie_break_is_deterministic(spark):
    df = _players(spark)
    out = [r.id for r in top_k(df, [desc("v")], 3, tie=["id"]).collect()]
    # DESC puts NULL first (the source server's order), then ties by id.
    assert out == [5, 1, 2]
    assert "TakeOrderedAndProject" in _plan(top_k(df, [desc("v")], 3, tie=["id"]))


def test_best_per_group(spark):
    df = _players(spark)
    best = {r.team: r.id for r in best_per_group(df, ["team"], [F.col("v").desc_nulls_last()], tie=["id"]).collect()}
    assert best == {"A": 1, "B": 4, "C": 7}
    two = best_per_group(df, ["team"], [F.col("v").desc_nulls_last()], tie=["id"], k=2)
    assert sorted(r.id for r in two.collect()) == [1, 2, 4, 6, 7, 8]


def test_best_per_group_limits_before_shuffle(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    plan = _plan(best_per_group(df, ["g"], [desc("v")], tie=["v"]))
    assert "WindowGroupLimit" in plan


def test_ranked_shortlist(spark):
    df = _players(spark)
    out = ranked_shortlist(df.filter(F.col("v").isNotNull()), [desc("v")], 4, tie=["id"]).orderBy("rang").collect()
    assert [(r.rang, r.id) for r in out] == [(1, 1), (2, 2), (3, 7), (4, 3)]


def test_share_of_total(spark):
    grouped = spark.createDataFrame([("DF", 1), ("MT", 1), ("AT", 1)], "p string, n long")
    out = {r.p: str(r.pct) for r in share_of_total(grouped, "n", "pct").collect()}
    assert out == {"DF": "33.33", "MT": "33.33", "AT": "33.33"}
    plan = _plan(share_of_total(grouped, "n", "pct"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_asc_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "id int, v int")
    assert [r.id for r in df.orderBy(asc("v")).collect()] == [2, 1]


def test_share_of_total_is_one_lazy_scan(spark, smoke_dir):
    """No job runs before the result is asked for, and the input is scanned once."""
    from touchline.plans import QUERIES

    spark.sparkContext.setJobGroup("share", "share of total")
    try:
        part = spark.read.parquet(f"{smoke_dir}/part.parquet")
        spark.sparkContext.setJobGroup("share-lazy", "nothing may run")
        out = share_of_total(part.groupBy("p_type").count(), "count", "pct")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("share-lazy")
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert _plan(out).count("FileScan parquet") == 1 and "SinglePartition" not in _plan(out)
    assert _plan(QUERIES["c03"](spark, smoke_dir)).count("part.parquet") == 1


def test_share_of_total_edges(spark):
    rows = [("a", 1), ("a", 1), (None, 2), ("b", None), ("c", 0)]  # equal rows, a null group, a null value
    got = sorted((r.p or "", r.n, str(r.pct)) for r in share_of_total(spark.createDataFrame(rows, "p string, n long"), "n", "pct").collect() if r.n is not None)
    assert got == [("", 2, "50.00"), ("a", 1, "25.00"), ("a", 1, "25.00"), ("c", 0, "0.00")]
    assert share_of_total(spark.createDataFrame(rows, "p string, n long"), "n", "pct").count() == 5
    assert share_of_total(spark.createDataFrame([], "p string, n long"), "n", "pct").count() == 0
