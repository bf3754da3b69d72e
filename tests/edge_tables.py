"""A small folder of driver-shaped tables with invented rows and every awkward case.

The driver tables hold no NULLs, so NULL handling, orphans, duplicates and
missing facts are exercised here: the whole catalogue runs on this folder
against its SQL oracle.
"""

from __future__ import annotations

import random
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq

NAMES = ["ash bolt", "ash gear", "elm ring", "oak nut", "fir pin"]
BRANDS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4"]
TYPES = ["PROMO", "SMALL", "LARGE", "ECONOMY PROMO"]


_REVERSE = {"on": False}


def _write(path: str, name: str, columns: dict, types: dict) -> None:
    if _REVERSE["on"]:
        columns = {k: list(reversed(v)) for k, v in columns.items()}
    table = pa.table({k: pa.array(v, type=types[k]) for k, v in columns.items()})
    pq.write_table(table, f"{path}/{name}.parquet")


def write_edge_tables(path: str, seed: int = 7, reverse_rows: bool = False) -> None:
    """Write the tables; ``reverse_rows`` stores the same rows in the opposite order."""
    _REVERSE["on"] = reverse_rows
    try:
        _write_all(path, seed)
    finally:
        _REVERSE["on"] = False


def _write_all(path: str, seed: int) -> None:
    rnd = random.Random(seed)
    # -- part: duplicates by (name, brand, type), NULLs in every descriptive column
    part = {k: [] for k in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")}
    for key in range(66):
        part["p_partkey"].append(key)
        part["p_name"].append(rnd.choice(NAMES))
        part["p_brand"].append(rnd.choice(BRANDS))
        part["p_type"].append(rnd.choice(TYPES))
        part["p_size"].append(rnd.randint(1, 6))
        part["p_retailprice"].append(round(900 + rnd.random() * 150, 1))
    for col, key in (("p_brand", 3), ("p_type", 5), ("p_name", 8), ("p_size", 11), ("p_retailprice", 12)):
        part[col][key] = None
    part["p_partkey"][20] = None  # a part without a key
    for i in (30, 31, 32):  # an exact duplicate group
        part["p_name"][i], part["p_brand"][i], part["p_type"][i], part["p_size"][i] = "oak nut", "Brand#2", "PROMO", 4
    _write(path, "part", part, {
        "p_partkey": pa.int64(), "p_name": pa.string(), "p_brand": pa.string(), "p_type": pa.string(),
        "p_size": pa.int32(), "p_retailprice": pa.float64(),
    })

    # -- lineitem: orphan part keys (70-72), parts without lines (7, 13), NULL measures, duplicate line keys
    li = {k: [] for k in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                          "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")}
    keys = [k for k in range(66) if k not in (7, 13)] + [70, 71, 72]
    for i in range(700):
        li["l_orderkey"].append(rnd.randint(0, 99))
        li["l_partkey"].append(rnd.choice(keys))
        li["l_suppkey"].append(rnd.randint(0, 9))
        li["l_linenumber"].append(rnd.randint(1, 4))
        li["l_quantity"].append(float(rnd.randint(1, 50)) if rnd.random() > 0.03 else None)
        li["l_extendedprice"].append(round(rnd.random() * 90000, 2) if rnd.random() > 0.03 else None)
        li["l_discount"].append(rnd.randint(0, 10) / 100 if rnd.random() > 0.03 else None)
        li["l_tax"].append(rnd.randint(0, 8) / 100)
        li["l_returnflag"].append(rnd.choice("ANR") if rnd.random() > 0.03 else None)
        li["l_linestatus"].append(rnd.choice("FO"))
        li["l_shipdate"].append(datetime(2000, 1, 1))
    li["l_partkey"][0] = None
    for i in range(40):  # part 41 only has lines with NULL quantity and discount
        li["l_partkey"][100 + i] = 41 if i < 3 else li["l_partkey"][100 + i]
    for i in (100, 101, 102):
        li["l_quantity"][i] = None
        li["l_discount"][i] = None
    _write(path, "lineitem", li, {
        "l_orderkey": pa.int64(), "l_partkey": pa.int64(), "l_suppkey": pa.int64(), "l_linenumber": pa.int32(),
        "l_quantity": pa.float64(), "l_extendedprice": pa.float64(), "l_discount": pa.float64(),
        "l_tax": pa.float64(), "l_returnflag": pa.string(), "l_linestatus": pa.string(),
        "l_shipdate": pa.timestamp("us"),
    })

    # -- orders (keys 0-89: lines of orders 90-99 are orphans) and customers (negative and NULL balances)
    orders = {
        "o_orderkey": list(range(90)),
        "o_custkey": [rnd.randint(0, 24) for _ in range(90)],
        "o_orderstatus": ["O"] * 90,
        "o_totalprice": [round(rnd.random() * 1000, 2) for _ in range(90)],
        "o_orderdate": [datetime(2000, 1, 1)] * 90,
        "o_orderpriority": ["1-URGENT"] * 90,
    }
    orders["o_custkey"][5] = None
    _write(path, "orders", orders, {
        "o_orderkey": pa.int64(), "o_custkey": pa.int64(), "o_orderstatus": pa.string(),
        "o_totalprice": pa.float64(), "o_orderdate": pa.timestamp("us"), "o_orderpriority": pa.string(),
    })
    customer = {
        "c_custkey": list(range(20)),
        "c_name": [f"Customer#{i}" for i in range(20)],
        "c_nationkey": [i % 5 for i in range(20)],
        "c_acctbal": [round(rnd.random() * 2000 - 500, 2) for _ in range(20)],
        "c_mktsegment": ["BUILDING"] * 20,
    }
    customer["c_acctbal"][3] = None
    _write(path, "customer", customer, {
        "c_custkey": pa.int64(), "c_name": pa.string(), "c_nationkey": pa.int32(), "c_acctbal": pa.float64(),
        "c_mktsegment": pa.string(),
    })
