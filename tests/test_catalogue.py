"""Every registered query against its SQL oracle, plus plan properties."""

import pytest

from touchline.oracle_check import compare, duck
from touchline.plans import ORACLE, QUERIES

ROWS_ONLY: set[str] = set()
FORBIDDEN_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def con(smoke_dir):
    return duck(smoke_dir)


def test_every_key_has_an_oracle_unless_rows_only():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, smoke_dir, key):
    r = compare(spark, con, smoke_dir, key, QUERIES[key], ORACLE.get(key))
    assert r["columns"] and r["values"] and r["order"], r


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_stays_in_the_jvm_without_cartesian_products(spark, smoke_dir, key):
    plan = _plan(QUERIES[key](spark, smoke_dir))
    for node in FORBIDDEN_NODES:
        assert node not in plan, f"{key}: {node}"


def test_ordered_oracles_exist():
    from touchline.oracle_check import is_ordered

    assert {"q05", "q06", "q09", "q10", "q11", "q12", "q13", "q14", "c06", "c09", "c10", "c11", "preview", "top_k"} <= {k for k, v in ORACLE.items() if is_ordered(v)}


def test_plan_shapes(spark, smoke_dir):
    assert "TakeOrderedAndProject" in _plan(QUERIES["q06"](spark, smoke_dir))
    assert "WindowGroupLimit" in _plan(QUERIES["c10"](spark, smoke_dir))
    q04 = _plan(QUERIES["q04"](spark, smoke_dir))
    assert "StringContains(p_type,MO)" in q04  # LIKE '%..%' reaches the parquet scan
    # Dimensions go in as broadcasts after their size check.
    assert "BroadcastHashJoin" in _plan(QUERIES["q01"](spark, smoke_dir))


def test_results_do_not_depend_on_partitioning(spark, smoke_dir):
    keys = ["q01", "q03", "c06", "c11", "d05_all", "d10", "reconcile_summary"]
    before = {k: sorted(map(tuple, QUERIES[k](spark, smoke_dir).collect())) for k in keys}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        after = {k: sorted(map(tuple, QUERIES[k](spark, smoke_dir).collect())) for k in keys}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert before == after


def test_consolidation_preserves_sums(spark, smoke_dir):
    from pyspark.sql import functions as F

    from touchline.plans import season
    from touchline.plans.model import CONSOLIDATED_MEASURES

    s = season(spark, smoke_dir)
    raw = s.joueur.join(s.stats, "id_joueur").agg(*[F.sum(m).alias(m) for m in CONSOLIDATED_MEASURES]).first()
    cons = s.consolidated.agg(*[F.sum(m).alias(m) for m in CONSOLIDATED_MEASURES]).first()
    assert raw == cons
    assert s.consolidated.count() <= s.joueur.count()
    # The sum-preserving comparisons are empty.
    for k in ("d01", "d05", "d06", "d08", "d09"):
        assert QUERIES[k](spark, smoke_dir).count() == 0, k


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(entry.queries())


def test_model_tables_have_the_declared_schemas(spark, smoke_dir):
    from touchline.plans import season
    from touchline.plans.load import _model_tables
    from touchline.sources.schemas import TABLES, insert_into, shape

    tables = _model_tables(season(spark, smoke_dir))
    for name, schema in TABLES.items():
        assert shape(tables[name].schema) == shape(schema), name
        assert shape(insert_into(tables[name], schema).schema) == shape(schema)


def test_persisted_model_gives_the_cold_results(spark, smoke_dir):
    from touchline.plans import Season, opened

    keys = ["q01", "q08", "q11", "q14", "consolidate", "c06", "c11", "d03", "d10", "d11",
            "dq_check", "dq_foreign_key", "reconcile", "delete_set_null", "apply_corrections"]
    for key in keys:
        cold = sorted(map(tuple, QUERIES[key](spark, smoke_dir).collect()), key=str)
        with opened(Season(spark, smoke_dir, keep=True)):
            warm = sorted(map(tuple, QUERIES[key](spark, smoke_dir).collect()), key=str)
        assert warm == cold, key
