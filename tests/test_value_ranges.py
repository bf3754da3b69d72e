"""Amounts and brands beyond the driver tables' ranges: every fact key still equals its oracle."""

import shutil

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

from touchline.oracle_check import compare, duck
from touchline.plans import ORACLE, QUERIES

KEYS = ["q01", "q02", "q06", "q07", "q09", "q10", "q11", "q12", "q13", "q14", "top_k", "consolidate", "c06", "c09", "c10", "c11", "d07", "d09_all",
        "d10", "coerce_decimal_comma", "share_of_total", "perf_join", "missing_facts"]


@pytest.fixture(scope="module")
def wide_dir(tmp_path_factory, smoke_dir):
    path = tmp_path_factory.mktemp("wide")
    shutil.copytree(smoke_dir, path, dirs_exist_ok=True, copy_function=shutil.copyfile)
    li = pq.read_table(f"{smoke_dir}/lineitem.parquet")
    i = li.schema.get_field_index("l_extendedprice")
    li = li.set_column(i, "l_extendedprice", pc.multiply(li["l_extendedprice"], 1500.0))
    i = li.schema.get_field_index("l_quantity")
    li = li.set_column(i, "l_quantity", pc.add(pc.cast(li["l_quantity"], "float64"), 0.7))
    pq.write_table(li, path / "lineitem.parquet")
    part = pq.read_table(f"{smoke_dir}/part.parquet")
    brands = part["p_brand"].to_pylist()
    brands[0], brands[1], brands[2] = "no digits", "Other#" + brands[3].split("#")[1], ""
    i = part.schema.get_field_index("p_brand")
    pq.write_table(part.set_column(i, "p_brand", [brands]), path / "part.parquet")
    return str(path)


@pytest.mark.parametrize("key", KEYS)
def test_wide_values_match_oracle(spark, wide_dir, key):
    r = compare(spark, duck(wide_dir), wide_dir, key, QUERIES[key], ORACLE[key])
    assert r["columns"] and r["values"] and r["order"], r


def test_more_hot_keys_than_the_limit(spark):
    from pyspark.sql import functions as F

    from touchline.operators.joins import lookup_join

    big = spark.range(4000).select(F.col("id").alias("row"), F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 37).alias("k"))
    lookup = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    for how in ("left", "inner"):
        want = sorted(map(tuple, big.join(lookup, ["k"], how).select("row", "k", "v").collect()), key=str)
        got = lookup_join(big, lookup, ["k"], how, min_rows=2, max_hot_keys=4)
        assert sorted(map(tuple, got.select("row", "k", "v").collect()), key=str) == want
