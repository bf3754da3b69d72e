"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Every row has a key: a hash of doc_id, text and its number among rows equal in
   both, so equal rows differ too.  A block is the rows of a source whose key falls
   in one of ``blocks`` classes: disjoint pseudo-random parts, without a sort.
   One aggregation gives the words of each block.
2. Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and
   share ``share`` times all words; a target stops at ``most`` times its
   source's words, the excess is reshared by weight until none is above.
3. A source whose target is f times its words has a quota of f times its blocks
   (rounded up).  A binary tree splits the quotas among the output shards: at each
   node the draws left are divided between the halves by a multivariate
   hypergeometric draw.  The tree first splits the quotas of source groups (a
   bounded number, on the driver), then a task a group splits its own among its
   sources, which is the same distribution.
4. Each shard draws its quota from the blocks the source has left: all blocks once,
   in a permutation of the shard's own, before any twice.  So the tree decides
   which blocks, and thereby which documents, the mix takes how often.  Blocks
   differ in words, so draws at the end are dropped or added until the words
   reach the target; the last block gives only the documents below a cut of
   the key, found by 64-fold refinement.
5. Inside a shard documents are ordered by a keyed hash.

The driver holds numbers by source group and shard; everything by source or block is
a table.  The plan (a row a block) is broadcast only up to ``PLAN_ROWS`` rows.  A
null text has size 0; a null source is a source of its own, the last; a null
doc_id counts as "".  Rows equal in doc_id, source and text are numbered over the
tasks that hold them, so a large group of them is spread over blocks and split at a
cut like other rows; which of them is taken is open if their other columns differ.
Documents without words are taken when their block is (they add no words); a
source without words is not taken.  Empty tables give empty results.  Other
columns are carried as one struct, so their names cannot clash.  Everything is keyed by
``seed``: reruns agree whatever the partitioning.  Draws: fewer than 10^9 in all.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.common import WORD, saved, shuffle_parts, text_id
from touchline.operators.derive import surrogate_key

WEIGHTS = (5, 2, 1)
#: Source groups of the tree's upper part; rows up to which the plan is broadcast.
GROUPS, PLAN_ROWS = 1024, 100_000
PLAN = "source string, block int, whole int, left double, deals array<struct<copy:int,shard:int,part:boolean>>"
DEAL = pa.struct([("copy", pa.int32()), ("shard", pa.int32()), ("part", pa.bool_())])
PLAN_ARROW = pa.schema([("source", pa.string()), ("block", pa.int32()), ("whole", pa.int32()), ("left", pa.float64()), ("deals", pa.list_(DEAL))])


def targets(sizes: list[int], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words for each source (in weight order): shares by weight, capped, the excess reshared."""
    n = len(sizes)
    weight = [WEIGHTS[i % len(WEIGHTS)] for i in range(n)]
    cap = [most * s for s in sizes]
    out, free, left = [0.0] * n, set(range(n)), share * sum(sizes)
    while free:
        unit = left / sum(weight[i] for i in free)
        over = [i for i in free if unit * weight[i] > cap[i]]
        if not over:
            for i in free:
                out[i] = unit * weight[i]
            break
        for i in over:
            out[i] = cap[i]
            left -= cap[i]
            free.discard(i)
    return out


def split_quotas(draws: np.ndarray, shards: int, seed, sizes: np.ndarray | None = None) -> np.ndarray:
    """Exact (shard, source) quotas by a binary tree of multivariate hypergeometric draws; ``sizes``: of the shards, else equal."""
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(draws)), np.int64)
    total = int(draws.sum())
    ends = [(total * (i + 1)) // shards for i in range(shards)] if sizes is None else np.cumsum(sizes).tolist()
    todo = [(0, shards, draws.astype(np.int64))]
    while todo:
        lo, hi, have = todo.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid = (lo + hi) // 2
        size = ends[mid - 1] - (ends[lo - 1] if lo else 0)
        part = rng.multivariate_hypergeometric(have, size, method="marginals") if have.sum() else have
        todo += [(lo, mid, part), (mid, hi, have - part)]
    return out


class Drawer:
    """Draws of one source's blocks: every block once before any twice, each shard by a permutation of its own."""

    def __init__(self, name: str | None, blocks: list[int], seed: int) -> None:
        self.name, self.blocks, self.seed = zlib.crc32((name or "").encode()) + (name is None), blocks, seed
        self.copy, self.free = 0, list(blocks)

    def draw(self, shard: int, n: int) -> list[tuple[int, int, int]]:
        """(block, copy, shard) of n draws."""
        rng, out = np.random.default_rng([self.seed, shard, self.name]), []
        while n > 0:
            some = [self.free[k] for k in rng.permutation(len(self.free))[:n]]
            out += [(b, self.copy, shard) for b in some]
            n -= len(some)
            taken = set(some)
            self.free = [b for b in self.free if b not in taken]
            if not self.free:
                self.copy, self.free = self.copy + 1, list(self.blocks)
        return out


def planned(name: str | None, words: dict[int, int], target: float, quota: np.ndarray, seed: int) -> dict[int, list]:
    """{block: [whole draws, words of a partial draw or None, deals]} of a source by its shards' quotas."""
    drawer = Drawer(name, sorted(words), seed)
    draws = [d for shard, n in enumerate(quota.tolist()) for d in drawer.draw(shard, n)]
    total = sum(words[b] for b, _, _ in draws)
    last = draws[-1][2] if draws else 0
    while draws and total - words[draws[-1][0]] >= target:
        total -= words[draws.pop()[0]]
    while draws and total < target - 0.5:
        draws += drawer.draw(last, 1)
        total += words[draws[-1][0]]
    out = {b: [0, None, []] for b in words}
    for k, (b, copy, shard) in enumerate(draws):
        part = k == len(draws) - 1 and total > target + 0.5
        if part:
            out[b][1] = target - (total - words[b])
        else:
            out[b][0] += 1
        out[b][2].append({"copy": copy, "shard": shard, "part": part})
    return out


# --- keys and targets, as tables ---------------------------------------------


SAME = ["doc", "source", "tid"]


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``tag``, the place they were written at) numbered within equal doc, source and tid, as column occ.

    A task's rows follow those of earlier tasks; only counts by task are combined.
    """
    rows = rows.withColumn("task", F.shiftright("tag", 33))
    per = rows.groupBy(*SAME, "task").agg(F.count("*").alias("c"))
    ahead = F.sum("c").over(Window.partitionBy(*SAME).orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(*(F.col(c).alias(f"p_{c}") for c in (*SAME, "task")), F.coalesce(ahead, F.lit(0)).alias("ahead"))
    mine = F.row_number().over(Window.partitionBy(*SAME, "task").orderBy("tag")) - 1
    same = [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in (*SAME, "task")]
    rows = rows.withColumn("mine", mine).join(per, same[0] & same[1] & same[2] & same[3])
    return rows.withColumn("occ", F.col("ahead") + F.col("mine")).drop("task", "mine", "ahead", *(f"p_{c}" for c in (*SAME, "task")))


def _identified(docs: DataFrame, *more) -> DataFrame:
    """doc, source, tid of every row, and ``more``."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(*more, doc.alias("doc"), F.col("source").cast("string").alias("source"), text_id().alias("tid"))


def _with_keys(rows: DataFrame, twice: DataFrame | None, blocks: int, seed: int) -> DataFrame:
    """``rows`` with block and sub; those equal to others are numbered first."""
    if twice is None:
        rows = rows.withColumn("occ", F.lit(0).cast("long"))
    else:
        told = twice.select(*(F.col(c).alias(f"t_{c}") for c in SAME))
        same = F.col("doc").eqNullSafe(F.col("t_doc")) & F.col("source").eqNullSafe(F.col("t_source")) & (F.col("tid") == F.col("t_tid"))
        many = saved(rows.join(told, same, "left_semi").withColumn("tag", F.monotonically_increasing_id()), "mix-equal")
        one = rows.join(told, same, "left_anti").withColumn("occ", F.lit(0).cast("long"))
        rows = one.unionByName(_numbered(many).drop("tag"))
    key = F.xxhash64(F.lit(seed), "doc", "tid", "occ")
    block = F.pmod(F.shiftrightunsigned(key, 32), F.lit(blocks)).cast("int")
    return rows.withColumns({"block": block, "sub": key.bitwiseAND(F.lit(0xFFFFFFFF))}).drop("occ", "doc", "tid")


def source_targets(sizes: DataFrame, share: float, most: float) -> DataFrame:
    """(source, size) with ``target``: :func:`targets`, by one aggregation a turn over the table of sources."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = saved(surrogate_key(sizes, ["source"], "rank", start=0).withColumn("weight", weight), "mix-ranked")
    cap, unit, over = F.col("size") * F.lit(float(most)), 0.0, -1
    while True:
        above = cap < F.col("weight") * F.lit(unit)
        told = ranked.agg(F.sum("size"), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)).first()
        if told[3] == over or not told[2]:
            break
        over, unit = told[3], (share * told[0] - (told[1] or 0.0)) / told[2]
    return ranked.withColumn("target", F.least(cap, F.col("weight") * F.lit(unit)) if told[2] else cap).drop("rank", "weight")


def _cuts(narrow: DataFrame, edges: DataFrame) -> DataFrame:
    """(source, block, cut) of every partial block: documents with a smaller sub are taken.

    The range that holds the cut is refined 64-fold by aggregation until it holds one document or one sub: no block
    is sorted or collected, and what is open is a row a source.
    """
    done, now = [], edges.select("source", "block", F.lit(0).cast("long").alias("lo"), F.col("left").alias("rest"))
    for step in (1 << 26, 1 << 20, 1 << 14, 1 << 8, 1 << 2, 1):
        now = saved(now, "mix-open")
        if not now.limit(1).count():
            break
        at = now.select(F.col("source").alias("o_source"), F.col("block").alias("o_block"), "lo", "rest")
        inside = narrow.join(at, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("block") == F.col("o_block")))
        inside = inside.filter((F.col("sub") >= F.col("lo")) & (F.col("sub") < F.col("lo") + 64 * step))
        parts = inside.groupBy("source", "block", "lo", "rest", F.floor((F.col("sub") - F.col("lo")) / step).alias("part"))
        parts = parts.agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        w = Window.partitionBy("source", "block").orderBy("part")
        parts = parts.withColumn("rest", F.col("rest") - (F.sum("words").over(w) - F.col("words")))  # before this part
        first = F.row_number().over(w.orderBy("part"))
        parts = saved(parts.filter("words > rest").withColumn("first", first).filter("first = 1"), "mix-parts")
        start = F.col("lo") + F.col("part") * step
        last = (F.col("n") == 1) | F.lit(step == 1)
        cut = start + F.when(F.col("words") / 2 <= F.col("rest"), F.lit(step)).otherwise(0)
        done.append(parts.filter(last).select("source", "block", cut.alias("cut")))
        hit = parts.select(F.col("source").alias("o_source"))
        none = now.join(hit, F.col("source").eqNullSafe(F.col("o_source")), "left_anti")  # all of the range fits
        done.append(none.select("source", "block", (F.col("lo") + 64 * step).alias("cut")))
        now = parts.filter(~last).select("source", "block", start.alias("lo"), "rest")
    out = done[0] if done else edges.select("source", "block", F.lit(0).cast("long").alias("cut"))
    for more in done[1:]:
        out = out.union(more)
    return out


def decisions(docs: DataFrame, share: float = 1.5, most: float = 2.0, blocks: int = 64, shards: int = 32, seed: int = 17):
    """(narrow rows with their key, plan, equal rows or None): what every document's key decides."""
    spark = docs.sparkSession
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    narrow = saved(_identified(docs, "doc_id", size.alias("size")), "mix-narrow")
    twice = saved(narrow.groupBy(*SAME).agg(F.count("*").alias("c")).filter("c > 1"), "mix-twice")
    twice = twice if twice.limit(1).count() else None
    narrow = _with_keys(narrow, twice, blocks, seed)
    narrow = narrow if twice is None else saved(narrow, "mix-keyed")
    have = saved(narrow.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    sizes = have.groupBy("source").agg(F.sum("words").alias("size"), F.count("*").alias("there"))
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0)
    group = F.pmod(F.xxhash64("source"), F.lit(GROUPS)).cast("int")
    quota = F.floor(ratio) * F.col("there") + F.ceil((ratio - F.floor(ratio)) * F.col("there") - 1e-9)
    sources = source_targets(sizes, share, most).withColumn("grp", group).withColumn("quota", quota.cast("long"))
    sources = saved(sources, "mix-sources")
    per = dict(sorted(tuple(r) for r in sources.groupBy("grp").agg(F.sum("quota")).collect()))  # at most GROUPS rows
    upper = split_quotas(np.array(list(per.values()), np.int64), shards, seed)
    of_group = spark.sparkContext.broadcast({g: upper[:, i] for i, g in enumerate(per)})

    def plan_group(rows: pa.Table) -> pa.Table:
        words: dict = {}
        aim, quotas = {}, {}
        for r in rows.to_pylist():
            words.setdefault(r["source"], {})[r["block"]] = r["words"]
            aim[r["source"]], quotas[r["source"]] = r["target"], r["quota"]
        names = sorted(words, key=lambda s: (s is None, s or ""))
        grp = rows["grp"][0].as_py()
        lower = split_quotas(np.array([quotas[s] for s in names], np.int64), shards, [seed, grp], of_group.value[grp])
        out = [(s, b, *p) for i, s in enumerate(names) for b, p in planned(s, words[s], aim[s], lower[:, i], seed).items()]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), PLAN_ARROW, strict=True)], schema=PLAN_ARROW)

    told = sources.select(F.col("source").alias("s_source"), "target", "quota", "grp")
    asked = have.join(told, F.col("source").eqNullSafe(F.col("s_source"))).select("source", "block", "words", "target", "quota", "grp")
    plan = saved(asked.groupBy("grp").applyInArrow(plan_group, PLAN), "mix-plan")
    cuts = _cuts(narrow, plan.filter("left is not null")).select(F.col("source").alias("c_source"), F.col("block").alias("c_block"), "cut")
    plan = plan.join(cuts, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("block") == F.col("c_block")), "left")
    known = sources.select(F.col("source").alias("s_source"), F.col("size").alias("source_size"), "target")
    plan = plan.join(known, F.col("source").eqNullSafe(F.col("s_source")))
    plan = plan.select(F.col("source").alias("p_source"), F.col("block").alias("p_block"), "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut"), "deals")
    plan = saved(plan, "mix-decided")
    return narrow, F.broadcast(plan) if plan.count() <= PLAN_ROWS else plan, twice


def mix_report(docs: DataFrame, **params) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken, shards (those that hold its copies, "3,17")."""
    narrow, plan, _ = decisions(docs, **params)
    out = narrow.join(plan, narrow["source"].eqNullSafe(plan["p_source"]) & (narrow["block"] == plan["p_block"]))
    below = F.col("sub") < F.col("cut")
    times = F.col("whole") + below.cast("int")
    shards = F.array_join(F.transform(F.filter("deals", lambda d: ~d["part"] | below), lambda d: d["shard"].cast("string")), ",")
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * times).alias("taken"), shards.alias("shards"))


def mixture(docs: DataFrame, blocks: int = 64, seed: int = 17, **params) -> DataFrame:
    """The mix itself: every drawn copy of a document with all its columns, shard by shard, each shuffled."""
    _, plan, twice = decisions(docs, blocks=blocks, seed=seed, **params)
    kept = _with_keys(_identified(docs, F.struct("*").alias("row")), twice, blocks, seed)
    out = kept.join(plan, kept["source"].eqNullSafe(plan["p_source"]) & (kept["block"] == plan["p_block"]))
    out = out.withColumn("deal", F.explode("deals")).filter(~F.col("deal.part") | (F.col("sub") < F.col("cut")))
    place = F.xxhash64(F.lit(seed), F.col("sub"), F.col("block"), F.col("deal.copy"), F.col("deal.shard"))
    out = out.select("row", F.col("deal.shard").alias("shard"), place.alias("place"))
    parts = shuffle_parts(docs.sparkSession)
    return out.repartitionByRange(parts, "shard", "place").sortWithinPartitions("shard", "place").select("row.*")
