from decimal import Decimal

from pyspark.sql import functions as F

from touchline.functions import diff, floor_int, match_key, mean, ratio, round2, sorted_distinct_join


def test_ratio_null_on_zero_and_half_up(spark):
    df = spark.createDataFrame([(1, 8), (29, 200), (3, 0), (None, 5), (2, 3)], "a int, b int")
    out = df.select(
        ratio("a", "b").alias("r"), ratio("a", "b", percent=True).alias("p"), ratio("a", "b", scale=3).alias("r3")
    ).collect()
    assert out[0].r == Decimal("0.13")  # 0.125 -> HALF_UP
    assert out[0].p == Decimal("12.50")
    assert out[1].r == Decimal("0.15")  # 0.145 exactly -> 0.15 (a DOUBLE path may give 0.14)
    assert out[2].r is None and out[2].p is None  # NULLIF(b, 0)
    assert out[3].r is None
    assert out[4].p == Decimal("66.67") and out[4].r3 == Decimal("0.667")


def test_mean_is_exact_decimal(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("x", 2), ("y", None)], "k string, v int")
    out = {r.k: r.m for r in df.groupBy("k").agg(mean("v").alias("m")).collect()}
    assert out["x"] == Decimal("1.67")
    assert out["y"] is None  # AVG of no value is NULL, not a division by zero


def test_round_floor_diff(spark):
    df = spark.createDataFrame([(Decimal("2.675"), 7, None)], "d decimal(10,3), n int, z int")
    r = df.select(
        round2("d").alias("r"),
        floor_int(F.col("d") * 3).alias("f"),
        diff("n", "z").alias("g"),
    ).first()
    assert r.r == Decimal("2.68")
    assert r.f == 8
    assert r.g == 7


def test_match_key_trims_blanks_only(spark):
    df = spark.createDataFrame([("  Jean DUPONT ",), ("\tJean Dupont",)], "n string")
    keys = [r.k for r in df.select(match_key("n").alias("k")).collect()]
    assert keys == ["jean dupont", "\tjean dupont"]


def test_sorted_distinct_join(spark):
    df = spark.createDataFrame([("a", "Nice"), ("a", "Brest"), ("a", "Nice"), ("b", "Lens")], "k string, t string")
    out = {r.k: r.t for r in df.groupBy("k").agg(sorted_distinct_join("t").alias("t")).collect()}
    assert out == {"a": "Brest, Nice", "b": "Lens"}


def test_scale_conf_sizes_partitions():
    from touchline.session import scale_conf

    big = scale_conf(100 * 1024**4, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600  # 100 TiB / 256 MiB
    small = scale_conf(10 * 1024**2, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # at least two waves of task slots
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_distinct_lists(spark):
    """Values in byte order, each once, sums and minima beside them; NULL without a value; parts of many beginnings."""
    from touchline.operators.listing import distinct_lists

    names = ["Zoé", "Éa", "a", "ab", "abc", "b", "Ab", "😀x", "é", "", "ab"]
    rows = [("k", n, 1, i) for i, n in enumerate(names)] + [("n", None, 2, 5), ("n", None, 3, 4), (None, "x", 1, 1)] + [("hot", f"team {i % 700:04d}", 1, i) for i in range(3000)]
    out = {r.k: r for r in distinct_lists(spark.createDataFrame(rows, "k string, t string, n long, m long").repartition(5), ["k"], "t", "teams", ["n"], ["m"]).collect()}
    assert out["k"].teams == ", ".join(sorted(set(names), key=lambda x: x.encode())) and (out["k"].n, out["k"].m) == (11, 0)
    assert out["n"].teams is None and (out["n"].n, out["n"].m) == (5, 4) and out[None].teams == "x"
    assert out["hot"].teams == ", ".join(f"team {i:04d}" for i in range(700)) and out["hot"].n == 3000
    only = {r.k: r.teams for r in distinct_lists(spark.createDataFrame(rows, "k string, t string, n long, m long"), ["k"], "t", "teams", sep="|").collect()}
    assert only["k"].count("|") == len(set(names)) - 1
