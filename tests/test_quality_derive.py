from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from touchline.operators import quality
from touchline.operators.compare import Measure, diff_report, side
from touchline.operators.derive import (
    apply_corrections,
    delete_cascade,
    delete_set_null,
    generated_columns,
    surrogate_key,
)


def _report(df):
    return {(r.table_name, r.constraint_type, r.columns): r.violations for r in df.collect()}


def test_primary_key_and_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (3, "c"), (4, None)], "k int, name string")
    rep = _report(quality.primary_key(df, "t", ["k"]))
    assert rep[("t", "PRIMARY KEY", "k")] == 2  # key 1 duplicated + one NULL key
    rep = _report(quality.unique(df, "t", ["name"]))
    assert rep[("t", "UNIQUE", "name")] == 1  # 'c' twice; the two NULLs never clash


def test_not_null_check_length_numeric(spark):
    df = spark.createDataFrame(
        [("abc", -1, "12345.678"), (None, 2, "1.005"), ("toolongname", None, "0,5")],
        "name string, n int, txt string",
    )
    rep = _report(quality.not_null(df, "t", ["name", "n"]))
    assert rep[("t", "NOT NULL", "name")] == 1 and rep[("t", "NOT NULL", "n")] == 1
    rep = _report(quality.check(df, "t", {"n >= 0": F.col("n") >= 0}))
    assert rep[("t", "CHECK", "n >= 0")] == 1  # NULL passes a CHECK
    rep = _report(quality.max_length(df, "t", {"name": 10}))
    assert rep[("t", "LENGTH", "length(name) <= 10")] == 1
    rep = _report(quality.numeric_range(df, "t", {"txt": (6, 2)}))
    assert rep[("t", "NUMERIC RANGE", "txt as decimal(6,2)")] == 2  # overflow and '0,5'


def test_foreign_key(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1,), (3,), (None,), (3,)], "pid int")
    rep = _report(quality.foreign_key(child, "c", ["pid"], parent, ["id"]))
    assert rep[("c", "FOREIGN KEY", "pid")] == 2  # NULL child keys are not checked


def test_deletes(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, pid int")
    deleted = spark.createDataFrame([(10,), (10,)], "pid int")
    assert sorted(r.id for r in delete_cascade(child, deleted, "pid", "pid").collect()) == [2, 3]
    out = {r.id: r.pid for r in delete_set_null(child, deleted, "pid", "pid").collect()}
    assert out == {1: None, 2: 20, 3: None}


def test_corrections_fill_and_override(spark):
    hub = spark.createDataFrame([(1, None, 2001), (2, "FRA", None), (3, "ESP", 1999)], "id int, nation string, born int")
    fixes = spark.createDataFrame(
        [(1, "nation", "COD", "checked"), (2, "born", "2006", "checked"), (3, "nation", "ITA", "typo")],
        "id int, column string, value string, reason string",
    )
    filled = {r.id: (r.nation, r.born) for r in apply_corrections(hub, fixes, "id", ["nation", "born"]).collect()}
    assert filled == {1: ("COD", 2001), 2: ("FRA", 2006), 3: ("ESP", 1999)}  # only NULLs are filled
    over = {r.id: r.nation for r in apply_corrections(hub, fixes, "id", ["nation"], mode="override").collect()}
    assert over[3] == "ITA"
    with pytest.raises(ValueError):
        apply_corrections(hub, fixes, "id", ["nation"], mode="bogus")


def test_generated_columns_replace_file_totals(spark):
    df = spark.createDataFrame([(Decimal("1.10"), Decimal("0.20"), Decimal("9.99"))], "npxg decimal(6,2), xag decimal(6,2), npxg_xag decimal(6,2)")
    out = generated_columns(df, {"npxg_xag": F.col("npxg") + F.col("xag")}).first()
    assert out.npxg_xag == Decimal("1.30")


def test_surrogate_key_dense(spark):
    df = spark.range(0, 500, 1, numPartitions=7).select((F.col("id") * 7 % 500).alias("k"))
    out = surrogate_key(df, ["k"], "sk")
    got = sorted((r.sk, r.k) for r in out.collect())
    assert [g[0] for g in got] == list(range(1, 501))
    assert [g[1] for g in got] == sorted(g[1] for g in got)  # keys follow the order


def test_diff_report_null_rules(spark):
    before = spark.createDataFrame([("A", 3, Decimal("1.50")), ("B", 0, None), ("C", 2, Decimal("1.00"))], "k string, n long, r decimal(6,2)")
    after = spark.createDataFrame([("A", 3, Decimal("1.50")), ("C", 4, Decimal("1.00")), ("D", 1, Decimal("0.50"))], "k string, n long, r decimal(6,2)")
    ms = [Measure("n", "n", "n_b", "n_a", gap="gap_n"), Measure("r", "r", "r_b", "r_a", fill=False, gap="gap_r", gap_scale=2)]
    out = {r.k: r for r in diff_report(before, after, ["k"], ms).collect()}
    # B exists only before with 0 / NULL: equal to the defaults, so not a difference.
    assert set(out) == {"C", "D"}
    assert (out["C"].n_b, out["C"].n_a, out["C"].gap_n) == (2, 4, 2)
    assert out["D"].n_b == 0 and out["D"].r_b is None and out["D"].gap_r == Decimal("0.50")
    all_rows = diff_report(before, after, ["k"], ms, only_differences=False)
    assert all_rows.count() == 4
    guarded = diff_report(before, after, ["k"], ms, guard=side("before", "n") > 0)
    assert [r.k for r in guarded.collect()] == ["C"]
