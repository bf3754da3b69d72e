"""Merge duplicate entities into one consolidated row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def consolidate(
    hub: DataFrame,
    facts: Sequence[DataFrame],
    keys: Sequence[str],
    measures: Sequence[str],
    id_col: str,
    reference_col: str | None = None,
) -> DataFrame:
    """One row per ``keys`` with ``MIN(id)`` and the sum of every measure.

    Each fact is first summed per entity id, so a fact holding several rows
    for one id adds them once instead of multiplying the other facts' sums
    through the join.  The joins are inner (an entity missing from any fact
    is left out).  Both aggregations are partial + final, so a business key
    that holds a third of all rows is reduced inside every task before the
    shuffle.
    """
    reference_col = reference_col or f"{id_col}_reference"
    joined = hub.select(id_col, *keys)
    placed: set[str] = set()
    for fact in facts:
        mine = [m for m in measures if m in fact.columns and m not in placed]
        placed.update(mine)
        per_id = fact.groupBy(id_col).agg(*[F.sum(m).alias(m) for m in mine])
        joined = joined.join(per_id, id_col, "inner")
    missing = [m for m in measures if m not in placed]
    if missing:
        raise ValueError(f"measures not found in any fact: {missing}")
    return joined.groupBy(*keys).agg(
        F.min(id_col).alias(reference_col), *[F.sum(m).alias(m) for m in measures]
    ).select(reference_col, *keys, *measures)
