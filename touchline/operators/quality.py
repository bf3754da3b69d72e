"""Table constraints re-expressed as data-quality jobs.

Spark does not enforce keys, checks or types on files, so each constraint
becomes a job that counts its violations.  Every job returns rows of
``(table_name, constraint_type, columns, violations)`` so that several
checks union into one report that always has one row per constraint, also
when nothing is violated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ("table_name", "constraint_type", "columns", "violations")


def _row(df: DataFrame, table: str, kind: str, columns: str, violations: Column) -> DataFrame:
    return df.agg(violations.cast("long").alias("violations")).select(
        F.lit(table).alias("table_name"),
        F.lit(kind).alias("constraint_type"),
        F.lit(columns).alias("columns"),
        F.coalesce(F.col("violations"), F.lit(0).cast("long")).alias("violations"),
    )


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), reports)


def _key_report(df: DataFrame, table: str, keys: Sequence[str], kind: str, nulls_violate: bool) -> DataFrame:
    any_null = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    dup_keys = F.count_if(~any_null & (F.col("__n") > 1))
    violations = dup_keys + F.coalesce(F.sum(F.when(any_null, F.col("__n"))), F.lit(0)) if nulls_violate else dup_keys
    return _row(per_key, table, kind, ", ".join(keys), violations)


def primary_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, plus rows with a NULL key part.

    One grouping by the key (partial + final aggregation): a hot key value is
    reduced inside each task before the shuffle.
    """
    return _key_report(df, table, keys, "PRIMARY KEY", nulls_violate=True)


def unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Non-NULL key values that occur more than once (NULLs never clash)."""
    return _key_report(df, table, keys, "UNIQUE", nulls_violate=False)


def _labelled(counts: DataFrame, kind: str, entries: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One report row per (table label, constraint text, count column) from a one-row count frame.

    The rows are exploded out of the single aggregate row, so the counts
    are computed in one pass (a union of one projection per count would be
    pruned into one aggregation, and one scan, per constraint).
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(kind).alias("constraint_type"),
                F.lit(text).alias("columns"),
                F.col(col).cast("long").alias("violations"),
            )
            for table, text, col in entries
        ]
    )
    return counts.select(F.explode(rows).alias("__r")).select("__r.*")


def not_null(
    df: DataFrame, table: str, columns: Sequence[str], labels: Sequence[str] | None = None
) -> DataFrame:
    """NULL count of every column, all in one scan.

    ``labels`` (one per column) reports a column under another table name:
    tables that are projections of one relation are checked in one pass.
    """
    labels = list(labels) if labels is not None else [table] * len(columns)
    distinct = list(dict.fromkeys(columns))
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(distinct)])
    index = {c: i for i, c in enumerate(distinct)}
    return _labelled(counts, "NOT NULL", [(t, c, f"__n{index[c]}") for t, c in zip(labels, columns)])


def check(
    df: DataFrame, table: str, rules: Mapping[str, Column], labels: Sequence[str] | None = None
) -> DataFrame:
    """Rows where a CHECK rule is false; a NULL outcome passes, as in SQL.

    ``labels`` (one per rule) reports a rule under another table name.
    """
    labels = list(labels) if labels is not None else [table] * len(rules)
    counts = df.agg(*[F.count_if(~cond).alias(f"__r{i}") for i, cond in enumerate(rules.values())])
    return _labelled(counts, "CHECK", [(t, name, f"__r{i}") for i, (t, name) in enumerate(zip(labels, rules))])


def relabel(report: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Repeat a report for several table names (projections of one checked relation)."""
    return report.withColumn("table_name", F.explode(F.array(*[F.lit(t) for t in tables])))


def foreign_key(
    child: DataFrame,
    table: str,
    child_cols: Sequence[str],
    parent: DataFrame,
    parent_cols: Sequence[str],
) -> DataFrame:
    """Child rows whose non-NULL key has no parent row.

    Child rows are counted per distinct key first (partial aggregation), so
    only distinct keys reach the anti join and a hot key is one row there.
    """
    keys = child.select(*child_cols)
    for c in child_cols:
        keys = keys.filter(F.col(c).isNotNull())
    counted = keys.groupBy(*child_cols).agg(F.count(F.lit(1)).alias("__rows"))
    ref = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_cols, child_cols)])
    orphans = counted.join(ref, list(child_cols), "left_anti")
    return _row(orphans, table, "FOREIGN KEY", ", ".join(child_cols), F.coalesce(F.sum("__rows"), F.lit(0)))


def max_length(
    df: DataFrame, table: str, limits: Mapping[str, int], labels: Sequence[str] | None = None
) -> DataFrame:
    """Values longer than the declared VARCHAR(n)."""
    rules = {f"length({c}) <= {n}": F.length(c) <= n for c, n in limits.items()}
    return check(df, table, rules, labels).withColumn("constraint_type", F.lit("LENGTH"))


def numeric_range(
    df: DataFrame, table: str, types: Mapping[str, tuple[int, int]], labels: Sequence[str] | None = None
) -> DataFrame:
    """Non-NULL values that do not fit NUMERIC(p, s) (would abort a cast)."""
    rules = {
        f"{c} as decimal({p},{s})": F.col(c).isNull() | F.col(c).try_cast(f"decimal({p},{s})").isNotNull()
        for c, (p, s) in types.items()
    }
    return check(df, table, rules, labels).withColumn("constraint_type", F.lit("NUMERIC RANGE"))
