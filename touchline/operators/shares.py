"""Share of a grand total (``x * 100.0 / SUM(x) OVER ()``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.numeric import ratio


def share_of_total(grouped: DataFrame, value_col: str, out_col: str, scale: int = 2) -> DataFrame:
    """Add ``ROUND(value * 100 / total, scale)`` where total sums ``value_col``.

    The total is a row of one aggregation with the groups (``GROUPING SETS ((keys), ())``).  It is then sent to
    every partition of the groups, where a window reads it beside them: one lazy job that scans the input once,
    without an un-partitioned window (every group in one task), a join or a second scan.  Equal rows stay apart.
    """
    columns = grouped.columns
    parts = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    both = grouped.groupingSets([columns, []], *columns).agg(
        F.sum(value_col).alias("__sum"), F.count(F.lit(1)).alias("__rows"), F.grouping_id().alias("__total")
    )
    own = F.array(F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    placed = both.withColumn("__part", F.explode(F.when(F.col("__total") > 0, every).otherwise(own)))
    total = F.max(F.when(F.col("__total") > 0, F.col("__sum"))).over(Window.partitionBy("__part"))
    rows = placed.withColumn("__all", total).filter(F.col("__total") == 0)
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__rows"))))
    return rows.select(*columns, ratio(F.col(value_col), F.col("__all"), scale=scale, percent=True).alias(out_col))
