"""Ranking operators: top-k, best row per group, ranked shortlist.

Every ordering takes an explicit tie-break so a result never depends on
input order: the SQL the catalogue comes from ranks with ties left open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column | str]


def _cols(order: Order) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]


def desc(c: str) -> Column:
    """DESC as in SQL servers that put NULL first on a descending sort."""
    return F.col(c).desc_nulls_first()


def asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def top_k(df: DataFrame, order: Order, k: int, tie: Order = ()) -> DataFrame:
    """``ORDER BY order, tie LIMIT k``.

    Planned as ``TakeOrderedAndProject``: each task keeps its own k best rows
    and only those are merged, so no full sort or single-partition shuffle.
    """
    return df.orderBy(*_cols(order), *_cols(tie)).limit(k)


def best_per_group(
    df: DataFrame, group: Sequence[str], order: Order, tie: Order = (), k: int = 1
) -> DataFrame:
    """Rows with ``ROW_NUMBER() OVER (PARTITION BY group ORDER BY order, tie) <= k``.

    The filter on the row number lets the optimizer insert a partial
    ``WindowGroupLimit`` before the shuffle: each task ships at most k rows
    per group, so a group holding a third of all rows does not land whole in
    one task.
    """
    w = Window.partitionBy(*group).orderBy(*_cols(order), *_cols(tie))
    rn = "__rank_in_group"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k).drop(rn)


def ranked_shortlist(
    df: DataFrame, order: Order, k: int, tie: Order = (), rank_col: str = "rang"
) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order, tie)`` kept where ``<= k``.

    The global row number is computed on the top-k rows only (a k-row
    window), never on the whole input in one partition.
    """
    ordered = _cols(order) + _cols(tie)
    best = df.orderBy(*ordered).limit(k)
    w = Window.orderBy(*ordered)
    return best.withColumn(rank_col, F.row_number().over(w))
