"""Link rows of an external source to hub entities in ordered matching passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.joins import HOT_KEY_MIN_ROWS, hot_keys_by_level, lookup_join
from touchline.session import written

#: Candidate entries under one common key (distinct values of the other keys) up to which they travel with it.
NEST_MAX = 4096


def _nested(target: DataFrame, passes: Sequence[Sequence[str]], common: Sequence[str], target_id: str) -> DataFrame | None:
    """One row per common key: its candidates by the other keys, as a list of (keys, smallest id, count).

    A second aggregation over the first, so a hot name is reduced to its distinct other keys before it is gathered.
    Written once: the join then has plain shuffles on both sides, which adaptive execution splits at a hot key.  None
    if a key has more than ``NEST_MAX`` entries.
    """
    every = list(dict.fromkeys(k for keys in passes for k in keys))
    others = [k for k in every if k not in common]
    base = target.groupBy(*every).agg(F.min(target_id).alias("__id"), F.count(F.lit(1)).alias("__n"))
    entry = F.struct(*[F.col(k).alias(f"__{k}") for k in others], "__id", "__n")
    nested = base.groupBy(*common).agg(F.collect_list(entry).alias("__entries"))
    nested = written(nested, "reconcile")
    most = nested.agg(F.max(F.size("__entries"))).first()[0] or 0
    return nested if most <= NEST_MAX else None


def _pass_columns(out: DataFrame, nested: DataFrame, passes, common) -> tuple[DataFrame, list[Column], list[Column]]:
    """``out`` joined once with the nested candidates, and each pass's smallest id and number of candidates."""
    joined = out.join(nested, list(common), "left")
    ids, counts = [], []
    for keys in passes:
        extra = [k for k in keys if k not in common]
        hits = F.col("__entries")
        if extra:
            hits = F.filter(hits, lambda e: reduce(lambda a, b: a & b, [e[f"__{k}"] == F.col(k) for k in extra]))  # noqa: B023
        ids.append(F.array_min(F.transform(hits, lambda e: e["__id"])))
        total = F.aggregate(hits, F.lit(0).cast("long"), lambda a, e: a + e["__n"])
        counts.append(F.when(F.size(hits) > 0, total))
    return joined, ids, counts


def _chained(out: DataFrame, source: DataFrame, target: DataFrame, passes, target_id: str, hot_key_rows: int):
    """One lookup join a pass, for passes without a common key (or with too many candidates under it)."""
    ids, counts = [], []
    hot_by_pass = hot_keys_by_level(source, passes, hot_key_rows)  # hot keys of every pass from one aggregation
    for i, (keys, hot) in enumerate(zip(passes, hot_by_pass, strict=True), start=1):
        cand = target.groupBy(*keys).agg(F.min(target_id).alias(f"__id{i}"), F.count(F.lit(1)).alias(f"__n{i}"))
        out = lookup_join(out, cand, list(keys), "left", min_rows=hot_key_rows, hot=hot)
        ids.append(F.col(f"__id{i}"))
        counts.append(F.col(f"__n{i}"))
    return out, ids, counts


def reconcile(
    source: DataFrame,
    target: DataFrame,
    passes: Sequence[Sequence[str]],
    target_id: str,
    out_col: str,
    hot_key_rows: int = HOT_KEY_MIN_ROWS,
) -> DataFrame:
    """Return ``source`` with ``out_col``, ``matched_pass`` and ``n_candidates``.

    ``passes`` lists key-column sets present in both frames (already
    normalised by the caller).  A source row takes the lowest target id among
    the candidates of the first pass that finds any; a row already carrying
    ``out_col`` keeps it (pass 0).  Unmatched rows keep a NULL id.

    Keys that every pass has (the name) join once: the target is first reduced
    to one row per such key, which carries its candidates by the other keys (age ->
    smallest id, count).  All passes are decided on the joined row, so no
    candidate pairs are built, and the source is scanned and shuffled once.
    Passes without a common key are chained, one lookup join each; there a key
    shared by ``hot_key_rows`` source rows is salted.
    """
    columns = [*source.columns, *([] if out_col in source.columns else [out_col])]
    out = source if out_col in source.columns else source.withColumn(out_col, F.lit(None).cast("long"))
    common = [k for k in passes[0] if all(k in keys for keys in passes)]
    nested = _nested(target, passes, common, target_id) if common else None
    if nested is not None:
        out, ids, counts = _pass_columns(out, nested, passes, common)
    else:
        out, ids, counts = _chained(out, source, target, passes, target_id, hot_key_rows)

    matched = F.when(F.col(out_col).isNotNull(), F.lit(0))
    n_cand = F.when(F.col(out_col).isNotNull(), F.lit(None).cast("long"))
    for i, (id_c, n_c) in enumerate(zip(ids, counts, strict=True), start=1):
        matched = matched.when(id_c.isNotNull(), F.lit(i))
        n_cand = n_cand.when(id_c.isNotNull(), n_c)
    linked = F.coalesce(F.col(out_col), *ids).alias(out_col)
    return out.select(*[linked if c == out_col else F.col(c) for c in columns], matched.alias("matched_pass"), n_cand.alias("n_candidates"))


def summary(reconciled: DataFrame, id_col: str) -> DataFrame:
    """Total, linked and unlinked rows (one row)."""
    return reconciled.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(id_col).alias("linked"),
    ).withColumn("unlinked", F.col("total") - F.col("linked"))


def unmatched(reconciled: DataFrame, id_col: str, order: Sequence[str]) -> DataFrame:
    """Rows left without a link, ordered."""
    return reconciled.filter(F.col(id_col).isNull()).orderBy(*order)


def ambiguous(reconciled: DataFrame) -> DataFrame:
    """Rows whose winning pass offered more than one candidate."""
    return reconciled.filter(F.col("n_candidates") > 1)
