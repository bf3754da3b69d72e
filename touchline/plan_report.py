"""Physical-plan summary of every catalogue query, as planned for large tables.

``python -m touchline.plan_report <sf_dir> > PLANS.md`` counts, per key, the
operators that decide the cost at scale: scans, shuffles (hash, range,
single partition), broadcasts, join strategies, partial aggregations, group
limits and top-k.  Automatic broadcast by size estimate is switched off so
that only explicitly checked broadcasts (dimensions, bounded hot keys)
remain, as on a cluster where the hub and facts are large.
"""

from __future__ import annotations

import re
import sys

COUNTERS = [
    ("scans", r"FileScan parquet|Scan parquet|InMemoryTableScan"),
    ("hash shuffles", r"Exchange hashpartitioning"),
    ("range shuffles", r"Exchange rangepartitioning"),
    ("single-partition", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("sort-merge joins", r"SortMergeJoin"),
    ("broadcast joins", r"BroadcastHashJoin"),
    ("partial aggs", r"partial_"),
    ("group limits", r"WindowGroupLimit .* Partial"),
    ("top-k", r"TakeOrderedAndProject"),
    ("python", r"BatchEvalPython|ArrowEvalPython"),
    ("cartesian", r"CartesianProduct|BroadcastNestedLoopJoin"),
]


def _outside_cached(lines: list[str]) -> list[str]:
    """Drop the subplans printed under a cached relation (computed once, then read)."""
    kept, skip_deeper_than = [], None
    for ln in lines:
        depth = len(ln) - len(ln.lstrip(" :+-"))
        if skip_deeper_than is not None:
            if depth > skip_deeper_than:
                continue
            skip_deeper_than = None
        kept.append(ln)
        if "InMemoryRelation" in ln:
            skip_deeper_than = depth
    return kept


def summarize(plan: str) -> dict[str, int]:
    lines = _outside_cached(plan.splitlines())
    out = {}
    for name, pattern in COUNTERS:
        rx = re.compile(pattern)
        if name == "partial aggs":
            out[name] = sum(1 for ln in lines if "HashAggregate" in ln and rx.search(ln))
        else:
            out[name] = sum(1 for ln in lines if rx.search(ln))
    return out


def main(argv: list[str]) -> int:
    from touchline.plans import QUERIES
    from touchline.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    names = [n for n, _ in COUNTERS]
    print("# Physical plans at scale (automatic broadcast off, model not persisted)\n")
    print("Generated by `python -m touchline.plan_report`. Counts of plan operators per query, each "
          "question planned from the raw tables, the default mode (an opened season persists the fact "
          "aggregate, the reconciled source and the consolidated view instead); a cached dimension counts as one scan (its one-time build is not repeated). Broadcasts are "
          "the dimensions (behind a row-count check), hot keys and the one-row scalar results. "
          "Inputs that a query writes first (matching candidates, files) count as one scan.\n")
    print("| key | " + " | ".join(names) + " |")
    print("| --- |" + " --- |" * len(names))
    for key, recipe in QUERIES.items():
        plan = recipe(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = summarize(plan)
        print(f"| {key} | " + " | ".join(str(counts[n]) for n in names) + " |")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
