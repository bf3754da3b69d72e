"""Load-time derivations: generated columns, corrections, deletes, surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.joins import HOT_KEY_MIN_ROWS, lookup_join


def generated_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Derive stored columns (``GENERATED ALWAYS AS (...)``) at load time.

    A value of the same name already present (a total carried by the file)
    is replaced by the recomputed one.
    """
    return df.withColumns(dict(exprs))


def apply_corrections(
    df: DataFrame,
    corrections: DataFrame,
    key: str,
    columns: Sequence[str],
    mode: str = "fill",
) -> DataFrame:
    """Apply documented manual corrections held as ``(key, column, value, reason)``.

    ``mode="fill"`` only replaces NULLs (the rule: missing values are kept
    unless a reliable value was found); ``mode="override"`` replaces the
    value.  Corrections are pivoted to one row per key first, so the join
    never multiplies rows; when a key has two values for one column the
    greatest wins.  No broadcast is forced: a manual corrections file is
    small by its file size and the planner broadcasts it; a derived one is
    sized by AQE at runtime.
    """
    if mode not in ("fill", "override"):
        raise ValueError("mode must be 'fill' or 'override'")
    fixes = corrections.groupBy(F.col(key).alias("__key")).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"__fix_{c}") for c in columns]
    )
    joined = df.join(fixes, F.col(key) == F.col("__key"), "left")
    types = dict(df.dtypes)
    out = {}
    for c in columns:
        fix = F.col(f"__fix_{c}").cast(types[c])
        out[c] = F.coalesce(F.col(c), fix) if mode == "fill" else F.coalesce(fix, F.col(c))
    return joined.withColumns(out).select(*df.columns)


def _with_deleted(child: DataFrame, deleted: DataFrame, child_col: str, parent_col: str, min_rows: int) -> DataFrame:
    """``child`` with a flag ``__gone`` where its parent is deleted (hot and NULL keys are spread)."""
    gone = deleted.select(F.col(parent_col).alias(child_col)).distinct().withColumn("__gone", F.lit(True))
    return lookup_join(child, gone, [child_col], "left", min_rows)


def delete_cascade(
    child: DataFrame, deleted: DataFrame, child_col: str, parent_col: str, min_rows: int = HOT_KEY_MIN_ROWS
) -> DataFrame:
    """Child rows that survive deleting the ``deleted`` parents (ON DELETE CASCADE)."""
    flagged = _with_deleted(child, deleted, child_col, parent_col, min_rows)
    return flagged.filter(F.col("__gone").isNull()).select(*child.columns)


def delete_set_null(
    child: DataFrame, deleted: DataFrame, child_col: str, parent_col: str, min_rows: int = HOT_KEY_MIN_ROWS
) -> DataFrame:
    """Child rows with the key set to NULL where the parent was deleted (ON DELETE SET NULL)."""
    flagged = _with_deleted(child, deleted, child_col, parent_col, min_rows)
    return flagged.withColumn(child_col, F.when(F.col("__gone").isNull(), F.col(child_col))).select(*child.columns)


# monotonically_increasing_id puts the partition index above bit 33 and the
# row position inside the partition below it.
_ROW_BITS = 33


def surrogate_key(df: DataFrame, order: Sequence[str | Column], out_col: str, start: int = 1) -> DataFrame:
    """Dense keys ``start .. start+n-1`` following ``order`` (SERIAL / IDENTITY).

    Column names sort ascending with NULLs last, as in SQL.  Equal order values
    are ordered by a hash of the row, so they spread over the range partitions.

    Range-partitioned sort, then each row's position inside its partition
    plus the number of rows in all earlier partitions.  The numbered rows are
    checkpointed to reliable storage first so that both uses read the same
    numbering, even after a lost executor recomputes a partition.  Only the
    per-partition counts (one row per partition) are combined in one task.
    """
    spark = df.sparkSession
    from touchline.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    keys = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    numbered = df.orderBy(*keys, F.xxhash64(*df.columns)).withColumn("__mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    numbered = numbered.withColumns(
        {
            "__part": F.shiftright(F.col("__mid"), _ROW_BITS),
            "__pos": F.col("__mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    counts = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    offsets = offsets.select("__part", "__offset")
    # One row per partition of the range-partitioned sort, whose number is the
    # configured shuffle partition count: metadata, broadcast.
    offsets = F.broadcast(offsets)
    keyed = numbered.join(offsets, "__part").withColumn(
        out_col, F.col("__offset") + F.col("__pos") + F.lit(start)
    )
    return keyed.select(out_col, *df.columns)
