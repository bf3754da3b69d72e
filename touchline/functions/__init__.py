"""Column-level helpers (pure ``pyspark.sql.functions`` expressions)."""

from touchline.functions.numeric import diff, exact_div, floor_int, mean, ratio, round2
from touchline.functions.text import full_name, match_key, sorted_distinct_join

__all__ = [
    "diff",
    "exact_div",
    "floor_int",
    "full_name",
    "match_key",
    "mean",
    "ratio",
    "round2",
    "sorted_distinct_join",
]
