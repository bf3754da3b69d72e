"""Small SQL text builders for the oracle statements.

DuckDB divides decimals in DOUBLE; casting the quotient to DECIMAL(38,10)
before ROUND gives the HALF_UP result of exact decimal division for every
quotient in the catalogue (the double error is far below 1e-10).
"""

from __future__ import annotations


def ratio(num: str, den: str, percent: bool = False, scale: int = 2) -> str:
    n = f"CAST({num} AS DOUBLE)" + (" * 100" if percent else "")
    return f"round(CAST({n} / NULLIF({den}, 0) AS DECIMAL(38,10)), {scale})"


def mean(x: str, scale: int = 2) -> str:
    return f"round(CAST(avg({x}) AS DECIMAL(38,10)), {scale})"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def teams(x: str = "e.nom_equipe") -> str:
    """STRING_AGG(DISTINCT x, ', ') in byte order."""
    return f"string_agg(DISTINCT {x}, ', ' ORDER BY {x})"


def floor_ratio(num: str, den: str) -> str:
    return f"CAST(floor(CAST(CAST({num} AS DOUBLE) / NULLIF({den}, 0) AS DECIMAL(38,10))) AS INTEGER)"
