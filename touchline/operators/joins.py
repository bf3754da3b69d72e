"""Join helpers: checked broadcasts and a hot-key-safe lookup join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Plan-only parameters: results never depend on them.
#
# A dimension is broadcast when it has at most this many rows; beyond it the
# season model writes it to the shared folder, so that joins with it have plain
# shuffles on both sides, which adaptive execution splits when a key is hot.
DIM_BROADCAST_MAX_ROWS = 100_000

# A join key carried by at least this many rows of the probing side is "hot":
# one task would have to stream all of them.  The heaviest HOT_KEYS_MAX_ROWS
# such keys are salted over HOT_KEY_SALTS tasks; a key beyond them is lighter
# than every salted one.
HOT_KEY_MIN_ROWS = 1_000_000
HOT_KEYS_MAX_ROWS = 100_000
HOT_KEY_SALTS = 64


def bounded_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Runs one small job; ``limit`` stops the count as soon as the bound is
    passed, so an unexpectedly large side is not counted in full.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def hot_keys(
    df: DataFrame, keys: Sequence[str], min_rows: int = HOT_KEY_MIN_ROWS, most: int = HOT_KEYS_MAX_ROWS
) -> DataFrame:
    """The heaviest key values carried by at least ``min_rows`` rows (partial + final aggregation)."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") >= min_rows)
    return counted.orderBy(F.desc("__rows"), *keys).limit(most).select(*keys)


def hot_keys_by_level(
    df: DataFrame, levels: Sequence[Sequence[str]], min_rows: int = HOT_KEY_MIN_ROWS, most: int = HOT_KEYS_MAX_ROWS
) -> list[DataFrame]:
    """:func:`hot_keys` for several key sets in one aggregation (``GROUPING SETS``).

    One scan and one shuffle of ``df`` serve every level; the result (hot
    keys only, a bounded set) is cached so each level reads it.
    """
    cols = list(dict.fromkeys(k for level in levels for k in level))
    found = (
        df.groupingSets([list(level) for level in levels], *cols)
        .agg(F.count(F.lit(1)).alias("__rows"), F.grouping_id().alias("__level"))
        .filter(F.col("__rows") >= min_rows)
        .orderBy(F.desc("__rows"), "__level", *cols)
        .limit(most)
        .cache()
    )
    out = []
    for level in levels:
        # grouping_id sets the bit of every column aggregated away at this level.
        gid = sum(1 << (len(cols) - 1 - j) for j, c in enumerate(cols) if c not in level)
        out.append(found.filter(F.col("__level") == gid).select(*level))
    return out


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    min_rows: int = HOT_KEY_MIN_ROWS,
    max_hot_keys: int = HOT_KEYS_MAX_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``big JOIN lookup USING (keys)`` where ``lookup`` has at most one row per key.

    A shuffle join sends every row of a key to one task, so a key held by a
    third of ``big`` would make one task do a third of the work.  Here every
    row gets a salt: 0 for ordinary keys, a spread value for hot keys and for
    rows with a NULL key part (they never match, and would pile up).  A hot
    key's lookup row is repeated once per salt value.  It is one scan of
    ``big`` and one join, whatever the number of hot keys.

    ``how`` is ``"left"`` or ``"inner"``.  Finding the hot keys is one
    aggregation; they are at most ``max_hot_keys`` rows, cached and broadcast.
    ``hot`` passes hot keys found beforehand (e.g. on the rows ``big`` was
    derived from).
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    hot = hot_keys(big, keys, min_rows, max_hot_keys).cache() if hot is None else hot.select(*keys)
    hot = F.broadcast(hot.limit(max_hot_keys).withColumn("__hot", F.lit(True)))
    # The same row always gets the same salt (a retried task agrees with itself);
    # equal rows in different input partitions get different ones.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *big.columns), F.lit(HOT_KEY_SALTS)).cast("int")
    rows = big.filter(~any_null) if how == "inner" else big
    rows = rows.withColumn("__spread", spread).join(hot, keys, "left")
    salted = F.when(F.col("__hot") | any_null, F.col("__spread")).otherwise(F.lit(0))
    rows = rows.withColumn("__salt", salted).drop("__spread", "__hot")
    salts = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(HOT_KEY_SALTS - 1))).otherwise(F.array(F.lit(0)))
    spots = lookup.join(hot, keys, "left").withColumn("__salt", F.explode(salts)).drop("__hot")
    return rows.join(spots, [*keys, "__salt"], how).drop("__salt")
