"""Before/after comparison of two results on a common key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """One compared value.

    ``before``/``after`` name the column on each side; ``out_before`` /
    ``out_after`` name the output columns (``None`` hides it).  ``fill``
    outputs ``COALESCE(x, default)`` instead of the raw value.  ``gap``
    names an ``after - before`` column (NULL read as ``default``), rounded
    when ``gap_scale`` is set.  ``compare`` puts the measure in the
    "rows that differ" predicate.
    """

    before: str
    after: str
    out_before: str | None = None
    out_after: str | None = None
    fill: bool = True
    gap: str | None = None
    gap_scale: int | None = None
    compare: bool = True
    default: Any = 0


def _filled(c: Column, m: Measure) -> Column:
    return F.coalesce(c, F.lit(m.default))


def diff_report(
    before: DataFrame,
    after: DataFrame,
    on: Sequence[str],
    measures: Sequence[Measure],
    only_differences: bool = True,
    guard: Column | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Full outer join of ``before`` and ``after`` on ``on`` (keys coalesced).

    A NULL on either side (a key present on one side only, or a NULL value)
    counts as ``default`` when compared, so NULL vs 0 is *not* a
    difference.  With ``only_differences`` only rows where a compared
    measure differs are kept, further restricted by ``guard`` (a predicate
    over the filled values, written with :func:`side`).  Both inputs are
    grouped results, at most one row per key, so the join is one-to-one.
    """
    b, a = before.alias("__b"), after.alias("__a")
    cond = [F.col(f"__b.{k}") == F.col(f"__a.{k}") for k in on]
    joined = b.join(a, cond, "full")

    cols: list[Column] = [F.coalesce(F.col(f"__b.{k}"), F.col(f"__a.{k}")).alias(k) for k in on]
    predicates: list[Column] = []
    gaps: list[Column] = []
    for m in measures:
        cb, ca = F.col(f"__b.{m.before}"), F.col(f"__a.{m.after}")
        if m.out_before:
            cols.append((_filled(cb, m) if m.fill else cb).alias(m.out_before))
        if m.out_after:
            cols.append((_filled(ca, m) if m.fill else ca).alias(m.out_after))
        if m.gap:
            g = _filled(ca, m) - _filled(cb, m)
            if m.gap_scale is not None:
                g = F.round(g, m.gap_scale)
            cols.append(g.alias(m.gap))
            gaps.append(F.abs(F.col(m.gap)))
        if m.compare:
            predicates.append(_filled(cb, m) != _filled(ca, m))

    out = joined
    if only_differences and predicates:
        keep = predicates[0]
        for p in predicates[1:]:
            keep = keep | p
        if guard is not None:
            keep = keep & guard
        out = out.filter(keep)
    out = out.select(*cols)
    if order is None:
        order = [g.desc() for g in gaps[:1]] + [F.col(k).asc() for k in on]
    return out.orderBy(*order) if order else out


def side(which: str, col: str, default: Any = 0) -> Column:
    """``COALESCE(<side>.col, default)`` inside a :func:`diff_report` guard."""
    prefix = {"before": "__b", "after": "__a"}[which]
    return F.coalesce(F.col(f"{prefix}.{col}"), F.lit(default))
