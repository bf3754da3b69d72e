"""String helpers used by matching and listing operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def match_key(c: Column | str) -> Column:
    """``LOWER(TRIM(c))``: trims blanks only (tab and no-break space are kept)."""
    return F.lower(F.trim(_col(c)))


def sorted_distinct_join(c: Column | str, sep: str = ", ") -> Column:
    """``STRING_AGG(DISTINCT c, sep)`` in a stable (byte) order.

    ``collect_set`` is deduplicated on the map side, so the buffer per group
    is bounded by the number of distinct values (a dimension), not by the
    number of rows in the group.
    """
    values = F.collect_set(_col(c))
    # NULL, not '', when the group has no non-NULL value (as STRING_AGG).
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), sep))


def full_name(*parts: Column | str) -> Column:
    """Parts joined by a blank; NULL when any part is NULL (SQL ``a || ' ' || b``).

    A missing part makes the whole name unknown, so it matches nothing.
    """
    cols = [_col(p) for p in parts]
    out = [cols[0]]
    for c in cols[1:]:
        out += [F.lit(" "), c]
    return F.concat(*out)
