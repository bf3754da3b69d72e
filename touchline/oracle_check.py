"""Side-by-side check of a recipe against its SQL oracle (DuckDB).

``python -m touchline.oracle_check /root/testdata/sf0.01 [key ...]`` prints
one line per key: row counts, column names, an exact comparison of the values,
and of the row order where the oracle states one.
"""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    """A DuckDB connection with a view per driver table present in ``sf_dir``."""
    import os

    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(float(v)))
    if isinstance(v, bool):
        return (1, repr(int(v)))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, int):
        return (1, repr(int(v)))
    return (2, str(v))


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def rows_of(columns, rows):
    return sorted(in_order(columns, rows))


def is_ordered(sql: str) -> bool:
    """Whether the statement itself (not a subquery or window) ends in ORDER BY."""
    depth, flat = 0, []
    for ch in sql:
        depth += (ch == "(") - (ch == ")")
        if depth == 0:
            flat.append(ch)
    return "ORDER BY" in "".join(flat)


def compare(spark, con, sf_dir: str, key: str, recipe, sql: str | None):
    t = time.time()
    sdf = recipe(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    elapsed = time.time() - t
    if sql is None:
        return {"key": key, "rows": len(s_rows), "oracle": None, "sec": round(elapsed, 2)}
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    same_cols = sorted(s_cols) == sorted(o_cols)
    same_vals = same_cols and rows_of(s_cols, s_rows) == rows_of(o_cols, o_rows)
    out = {
        "key": key,
        "rows": len(s_rows),
        "oracle_rows": len(o_rows),
        "columns": same_cols,
        "values": same_vals,
        "order": same_vals and (not is_ordered(sql) or in_order(s_cols, s_rows) == in_order(o_cols, o_rows)),
        "sec": round(elapsed, 2),
    }
    if not same_cols:
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(o_cols)
    elif not same_vals:
        a, b = rows_of(s_cols, s_rows), rows_of(o_cols, o_rows)
        out["only_spark"] = [r for r in a if r not in b][:3]
        out["only_oracle"] = [r for r in b if r not in a][:3]
    return out


def main(argv: list[str]) -> int:
    from touchline.plans import ORACLE, QUERIES
    from touchline.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, sf_dir, k, QUERIES[k], ORACLE.get(k))
        except Exception as e:  # report and continue with the next key
            r = {"key": k, "error": f"{type(e).__name__}: {str(e)[:300]}"}
        ok = r.get("order", r.get("oracle") is None and "error" not in r)
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
