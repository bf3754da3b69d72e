"""Distinct, ordered lists of a group's values (``STRING_AGG(DISTINCT x)``) beside its sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Leading characters that make a part of a list.
PREFIX = 2


def distinct_lists(
    df: DataFrame, keys: Sequence[str], value: str, out_col: str, sums: Sequence[str] = (), mins: Sequence[str] = (), sep: str = ", "
) -> DataFrame:
    """One row per group: keys, ``out_col`` (its distinct values in byte order, joined by ``sep``), the sums and the minima.

    Three aggregations, each with partial sums before its shuffle: by group and value (distinct), by group and the
    value's first characters (a sorted part of the list), by group (the parts in order).  So no buffer holds more
    than a part of one group's values before the list itself is put together, and the rows of a hot group spread over
    its values.  A group without a non-NULL value has a NULL list.
    """
    keys = list(keys)
    added = [*(F.sum(c).alias(c) for c in sums), *(F.min(c).alias(c) for c in mins)]
    each = df.groupBy(*keys, value).agg(*added) if added else df.select(*keys, value).distinct()
    part = F.substring(value, 1, PREFIX)  # values with a smaller beginning come earlier, whole characters or not
    listed = F.array_sort(F.collect_list(value)).alias("__values")
    parts = each.groupBy(*keys, part.alias("__part")).agg(listed, *added)
    joined = F.struct("__part", F.array_join("__values", sep).alias("__text"))
    whole = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.size("__values") > 0, joined))).alias("__parts"), *added)
    text = F.array_join(F.transform("__parts", lambda p: p["__text"]), sep)
    return whole.select(*keys, F.when(F.size("__parts") > 0, text).alias(out_col), *sums, *mins)
