"""Exact decimal arithmetic helpers.

Every ratio, mean and rounding in the query catalogue is done on DECIMAL
values so that results do not depend on row order or on the number of
partitions (a DOUBLE sum does).  Rounding is HALF_UP, the rule of SQL
``ROUND(numeric, n)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numerators are widened to DECIMAL(38, 18) before a division.  Spark keeps at
# least 16 fractional digits for divisors of up to 20 integer digits, so a
# later ROUND(..., 2) never rounds twice in a way that changes the result.
WIDE = "decimal(38,18)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_div(num: Column | str, den: Column | str) -> Column:
    """``num / den`` in wide decimal; NULL when ``den`` is NULL."""
    return _col(num).cast(WIDE) / _col(den)


def ratio(num: Column | str, den: Column | str, scale: int = 2, percent: bool = False) -> Column:
    """``ROUND(num [* 100] / NULLIF(den, 0), scale)``: NULL on a zero divisor."""
    n = _col(num).cast(WIDE)
    if percent:
        n = n * F.lit(100)
    return F.round(n / F.nullif(_col(den), F.lit(0)), scale)


def mean(c: Column | str, scale: int = 2) -> Column:
    """``ROUND(AVG(c), scale)`` with a decimal result (an aggregate expression).

    ``avg`` over integers is DOUBLE in Spark; the SQL mean of integers is an
    exact numeric, so it is written as SUM / COUNT in decimal.
    """
    x = _col(c)
    return F.round(exact_div(F.sum(x), F.nullif(F.count(x), F.lit(0))), scale)


def round2(c: Column | str) -> Column:
    """``ROUND(c, 2)`` HALF_UP on a decimal."""
    return F.round(_col(c).cast(WIDE), 2)


def floor_int(c: Column | str) -> Column:
    """``FLOOR(c)::int``."""
    return F.floor(_col(c)).cast("int")


def diff(a: Column | str, b: Column | str, default=0) -> Column:
    """``COALESCE(a, default) - COALESCE(b, default)``."""
    return F.coalesce(_col(a), F.lit(default)) - F.coalesce(_col(b), F.lit(default))
