"""Near-duplicate join on word shingles: exact Jaccard by token-combination prefixes.

1. Every text's distinct 5-word shingles are hashed (48 bits) where it lies.
   A block exchange counts in how many documents each shingle occurs and tells
   the blocks; shingles of one document only can never be shared, so a document
   keeps just its shared ones, rarest first (the global order).
2. Documents with equal shingle sets are one class; only classes are compared.
3. Prefixes: sets of size n that reach Jaccard t share a token among their first
   n - ceil(tn) + 1 tokens in that order, and two tokens among one token more
   (the extended prefix).  Classes whose prefix has no shared token are alone.
4. Star rounds: within each prefix token and size band the classes are compared
   with one centre (another each round); verified links give components, and
   tokens held by one component only are done.  A group of near copies becomes one
   component in a few rounds of as many comparisons as it has classes.
5. Pairs, for links the stars cannot show: classes of *different* components that
   still share a prefix token.  Tokens of few classes are indexed singly; for
   frequent ones the index key is a combination of two, then three tokens of the
   prefix extended by one and two, where that is less than the pairs.  Keys held by
   the same classes are one.  Size and position bounds prune, the rest is verified on
   the whole sets.  Links inside one component change nothing, so
   every component is exact; no pairs of a group of copies are listed.

A null text, and one without words, has an empty set and is linked with
nothing; a text of fewer than five words has one shingle, its whole sequence.
Repeated rows are members of one class.  Rows with a null doc_id take part;
the smallest id ignores nulls.  Long texts are read whole.  Empty tables give
empty results.  Only doc_id and text are read, so other columns cannot clash.
Hash collisions: 48-bit shingles, 64-bit classes; two texts' sets would have to
collide for a wrong answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import (
    ANSWER, ANSWER_ARROW, BLOCK, EXCHANGE, EXCHANGE_ARROW, KEYS, POLY, U64, Poly, components, lowered, mix, planes,
    rows_batch, saved, send, shuffle_parts, slices, span_hashes, text_buffer, text_id, unplanes, words_of, worker_store,
)

LOCAL = 2
#: Words of a class's parity bitmap.
BITMAP = 16
#: Occurrences of a token in one block from which the block sends a count instead of the documents.
LOCAL_MANY = 16
DOCS = "doc_id long, text_id long, n_shingles long, node long, prefix int, tokens array<long>, bits array<long>"
DOCS_ARROW = pa.schema([("doc_id", pa.int64()), ("text_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("prefix", pa.int32()), ("tokens", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])


def shingle_sets(data: np.ndarray, offs: np.ndarray, poly: Poly, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, 48-bit shingle) of every distinct shingle of the rows, by row and shingle."""
    start, end, at = words_of(data, offs)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    w = span_hashes(lowered(data), start, end, poly)
    scale = [U64(pow(POLY, k + 2, 1 << 64) | 1) for k in range(words)]
    padded = np.concatenate([w, np.zeros(words, U64)])
    row = np.repeat(np.arange(len(offs) - 1), np.diff(at))
    left = at[1:][row] - np.arange(len(w))  # words from here to the row's end
    h = np.zeros(len(w), U64)
    for k in range(words):
        h += np.where(left > k, padded[k : k + len(w)], U64(0)) * scale[k]
    whole = (left >= words) | ((np.arange(len(w)) == at[:-1][row]) & (left < words))
    h = mix(h + np.minimum(left, words).astype(U64))[whole] >> U64(16)
    row = row[whole]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[first], h[first]


def _scan(buckets: int, words: int, most: int):
    def run(batches):
        from pyspark import TaskContext

        worker_store("ngram")  # what another operator kept in this worker goes

        poly, block = Poly(), TaskContext.get().partitionId() << 24
        for batch in batches:
            data, offs = text_buffer(batch.column(2))
            for lo, hi in slices(offs, most):
                block += 1
                part = offs[lo : hi + 1]
                row, h = shingle_sets(data[part[0] : part[-1]], part - part[0], poly, words)
                n = np.bincount(row, minlength=hi - lo)
                sums = np.concatenate([[U64(0)], np.cumsum(mix(h ^ U64(POLY)))])
                ends = np.cumsum(n)
                node = mix((sums[ends] - sums[ends - n]) + n.astype(U64))
                docs = batch.column(0).slice(lo, hi - lo)
                null = np.asarray(docs.is_null())
                ids = docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").view("<u8")
                texts = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype("<i8").view("<u8")
                out = [(block % buckets, block, BLOCK, planes(ids, null.astype("<u8"), texts, n.astype("<u8"), node))]
                order = np.argsort(h, kind="stable")
                h, row = h[order], row[order]
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
                count = np.diff(np.append(first, len(h)))
                many = np.repeat(count > LOCAL_MANY, count)
                if many.any():
                    out.append((block % buckets, block, LOCAL, planes(h[many], row[many].astype(U64))))
                    lead = first[count > LOCAL_MANY]
                    h2 = np.concatenate([h[~many], h[lead]])
                    r2 = np.concatenate([row[~many], np.zeros(len(lead), np.int64)]).astype(U64)
                    c2 = np.concatenate([np.zeros((~many).sum(), U64), count[count > LOCAL_MANY].astype(U64)])
                else:
                    h2, r2, c2 = h, row.astype(U64), np.zeros(len(h), U64)
                if len(h2):
                    out += send(h2 << U64(16), r2, buckets, block, c2)
                for k in range(0, len(out), 64):
                    yield rows_batch(out[k : k + 64], EXCHANGE_ARROW)

    return run


def _frequencies(rows: pa.Table) -> pa.Table:
    """A bucket: document frequency of each token; a block gets its entries that occur in two or more."""
    worker_store("ngram")
    cells = list(zip(rows["block"].to_pylist(), rows["kind"].to_pylist(), rows["payload"].to_pylist(), strict=True))
    out = [c for c in cells if c[1] != KEYS]
    mine = [(b, unplanes(x)) for b, k, x in cells if k == KEYS]
    if mine:
        keys = np.concatenate([x[0] for _, x in mine])
        weight = np.concatenate([np.maximum(x[2], U64(1)) for _, x in mine])
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        df = np.empty(len(keys), U64)
        df[order] = np.repeat(np.add.reduceat(weight[order], first), np.diff(np.append(first, len(keys))))
        at = 0
        for b, x in mine:
            f = df[at : at + len(x[0])]
            at += len(x[0])
            hit = f > 1
            if hit.any():
                out.append((b, KEYS, planes(x[0][hit] >> U64(16), x[1][hit], f[hit], (x[2][hit] > 0).astype(U64))))
    return pa.Table.from_batches([rows_batch(out, ANSWER_ARROW)])


def _assemble(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        """A block: each document's shared tokens, rarest first, and how many of them its prefix reaches."""
        worker_store("ngram")
        kinds, blobs = rows["kind"].to_pylist(), rows["payload"].to_pylist()
        ids, null, texts, n, node = unplanes(next(x for k, x in zip(kinds, blobs, strict=True) if k == BLOCK))
        told = [unplanes(x) for k, x in zip(kinds, blobs, strict=True) if k == KEYS]
        token, row, df, many = (np.concatenate([t[i] for t in told]) for i in range(4)) if told else (np.zeros(0, U64),) * 4
        local = [unplanes(x) for k, x in zip(kinds, blobs, strict=True) if k == LOCAL]
        if local:
            t = np.concatenate([x[0] for x in local])
            r = np.concatenate([x[1] for x in local])
            known, f = token[many > 0], df[many > 0]
            order = np.argsort(known)
            spot = order[np.searchsorted(known[order], t)]
            token, row, df = (np.concatenate([a[many == 0], b]) for a, b in ((token, t), (row, r), (df, f[spot])))
        order = np.lexsort((token, df, row))
        token, row = token[order], row[order].astype(np.int64)
        have = np.bincount(row, minlength=len(n))
        n = n.astype(np.int64)
        prefix = n - -(-percent * n // 100) + 1 - (n - have)
        live = (have > 0) & (prefix > 0)
        keep = live[row] if len(row) else np.zeros(0, bool)
        sizes = np.where(live, have, 0)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(token[keep].view("<i8")))
        # parity bitmap of a document's shared tokens: two documents differ in at least as many tokens as bits
        at = np.cumsum(live) - 1
        bits = np.zeros((int(live.sum()), BITMAP), U64)
        mine = token[keep]
        np.bitwise_xor.at(bits, (at[row[keep]], ((mine >> U64(6)) % U64(BITMAP)).astype(np.int64)), U64(1) << (mine & U64(63)))
        ends = np.concatenate([[0], np.cumsum(live * BITMAP)]).astype(np.int32)
        maps = pa.ListArray.from_arrays(pa.array(ends), pa.array(bits.reshape(-1).view("<i8")))
        cols = [pa.array(ids.view("<i8"), mask=null > 0), pa.array(texts.view("<i8")), pa.array(n), pa.array(node.view("<i8")), pa.array(np.where(live, np.minimum(prefix, have), 0).astype(np.int32)), lists, maps]
        return pa.Table.from_arrays(cols, schema=DOCS_ARROW)

    return run


def shared_tokens(docs: DataFrame, words: int = 5, percent: int = 75, block_bytes: int = 4 << 20) -> DataFrame:
    """Every row: doc_id, text_id, n_shingles, node (its set's id), prefix, tokens (its shared ones, if its prefix has any)."""
    buckets = 4 * shuffle_parts(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long"), text_id().alias("text_id"), F.col("text").cast("string"))
    asked = src.mapInArrow(_scan(buckets, words, block_bytes), EXCHANGE)
    told = asked.groupBy("bucket").applyInArrow(_frequencies, ANSWER)
    return told.groupBy("block").applyInArrow(_assemble(percent), DOCS)


def _near(pairs: DataFrame, classes: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose bitmaps leave the similarity possible."""
    left, right = (classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("alone").alias(f"alone{x}"), F.col("bits").alias(f"bits{x}")) for x in "ab")
    return saved(pairs.join(left, "a").join(right, "b").filter(_possible("{}a", "{}b", percent)).select(*pairs.columns), name)


def _possible(a: str, b: str, percent: int) -> Column:
    """What certainly differs (shingles of one document only, bits in which the bitmaps differ) leaves the similarity possible."""
    differ = F.col(a.format("alone")) + F.col(b.format("alone"))
    for k in range(BITMAP):
        differ = differ + F.bit_count(F.element_at(a.format("bits"), k + 1).bitwiseXOR(F.element_at(b.format("bits"), k + 1)))
    # an overlap o of at least percent / (100 + percent) of both sizes leaves n + n - 2 o differing shingles at most
    return (100 + percent) * differ <= (100 - percent) * (F.col(a.format("n")) + F.col(b.format("n")))


def _only(classes: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """The token lists of ``nodes``: lists that nobody asks for stay out of the joins."""
    nodes = saved(nodes.select("node").distinct(), f"{name}-nodes")
    return saved(classes.select("node", "n", "tokens").join(nodes, "node", "left_semi"), f"{name}-some")


def _verified(pairs: DataFrame, classes: DataFrame, percent: int, name: str, *more: str) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity; exact."""
    some = _only(classes, pairs.select(F.explode(F.array("a", "b")).alias("node")), name)
    left = some.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = some.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ta", "tb")).cast("long")
    return both.withColumn("o", shared).filter(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b", *more)


def _relabelled(labels: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``labels`` (node, comp) after links between their components (edges a, b)."""
    merged = components(edges, name=name).select(F.col("node").alias("was"), F.col("comp").alias("now"))
    out = labels.join(merged, labels.comp == merged.was, "left").select("node", F.coalesce("now", "comp").alias("comp"))
    return saved(out, f"{name}-labels")


def _mixed(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` (with comp) whose key is held by classes of two components or more, and c, how many hold it."""
    held = rows.groupBy(key).agg(F.count("*").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    held = saved(held.filter("lo <> hi").select(key, "c"), f"{name}-held")
    return saved(rows.join(held, key), name)


def _grouped(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` of keys held by several components; and of each such key c, how many classes hold it, and kept: one key
    for all that are held by the same classes, whose pairs are met once."""
    at = (F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (1, 2))
    held = rows.groupBy("key").agg(F.count("*").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), *at)
    held = saved(held.filter("lo <> hi").drop("lo", "hi"), f"{name}-held")
    alike = held.groupBy("c", "x1", "x2").agg(F.min("key").alias("kept"))
    lists = saved(held.join(alike, ["c", "x1", "x2"]).select("key", "kept", "c"), f"{name}-lists")
    return saved(rows.join(lists.select("key"), "key"), name), lists


def _star_round(own: DataFrame, classes: DataFrame, percent: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b: components) between classes and the centres of their tokens: one centre a token and size band, another each turn;
    and the rows of ``own`` whose token several components hold (of others no later turn makes any).

    A class is compared with one class of each other component that it meets so, whatever the tokens they share.
    """
    post = _mixed(own, "token", f"join-live{turn}").drop("c")
    # band b and b + 1 hold every size that can be linked with a size of band b
    live = post.withColumn("band", F.floor(F.log("n") / F.lit(float(np.log(100 / percent)))).cast("int"))
    first = F.min(F.struct(F.xxhash64("node", "token", F.lit(turn)).alias("h"), F.col("node").alias("centre"), F.col("comp").alias("c_comp"), F.col("n").alias("c_n"))).alias("f")
    centre = live.groupBy("token", "band").agg(first).select("token", F.explode(F.array("band", F.col("band") + 1)).alias("band"), "f.centre", "f.c_comp", "f.c_n")
    met = live.join(saved(centre, f"join-centres{turn}"), ["token", "band"]).filter((F.col("comp") != F.col("c_comp")) & (100 * F.least("n", "c_n") >= percent * F.greatest("n", "c_n")))
    one = met.groupBy("node", "comp", "c_comp").agg(F.min(F.struct(F.xxhash64("centre", "node", F.lit(turn)).alias("h"), "centre")).alias("f"))
    pairs = saved(one.select(F.col("node").alias("a"), F.col("f.centre").alias("b"), "comp", "c_comp"), f"join-met{turn}")
    pairs = _near(pairs, classes, percent, f"join-near{turn}")
    links = _verified(pairs, classes, percent, f"join-star{turn}", "comp", "c_comp").select(F.col("comp").alias("a"), F.col("c_comp").alias("b")).distinct()
    return saved(links, f"join-star{turn}"), post.drop("comp")


def link_components(rows: DataFrame, percent: int = 75, few: int = 64, turns: int = 4, tokens: int = 3) -> DataFrame:
    """(node, comp) of every class with a shared token in its prefix."""
    live = rows.filter("prefix > 0").groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"), F.first("tokens").alias("tokens"), F.first("bits").alias("bits"))
    classes = saved(live.withColumn("m", F.size("tokens")).withColumn("alone", F.col("n") - F.col("m")), "join-classes")
    post = classes.select("node", "n", F.posexplode(F.slice("tokens", F.lit(1), F.col("prefix"))).alias("i", "token"))
    post = saved(post.select("token", "node", "n", "i"), "join-post")
    labels = saved(classes.select("node", F.col("node").alias("comp")), "join-labels")
    total, own = classes.count(), post.withColumn("comp", F.col("node"))
    for turn in range(turns):
        links, post = _star_round(own, classes, percent, turn)
        n = links.count()
        if n:
            labels = _relabelled(labels, links, f"join-cc{turn}")
        own = saved(post.join(labels, "node"), f"join-own{turn}")
        if 100 * n <= total:  # what is left is not for stars to find
            break

    # Pairs: classes of different components that still share a token, or a combination of several.
    level = own.join(classes.select("node", "m", "prefix"), "node")
    level = level.select(F.col("token").alias("key"), "node", "n", "i", (F.col("n") - F.col("m") + F.col("i")).alias("pos"), "m", "prefix", "comp")
    level = saved(level, "join-level")
    ready, maps = None, classes.select("node", "alone", "bits")
    for k in range(1, tokens + 1):
        level, lists = _grouped(level, f"join-level{k}")
        direct, children = lists.withColumn("direct", F.lit(True)), None
        if k < tokens:
            wide = saved(level.join(lists.filter(F.col("c") > few).select("key"), "key", "left_semi"), f"join-wide{k}")
            wide = wide.join(_only(classes, wide, f"join-wide{k}").select("node", "tokens"), "node")
            room = F.greatest(F.least(F.col("m"), F.col("prefix") + k) - F.col("i") - 1, F.lit(0))  # k + 1 shared tokens lie in the prefix extended by k
            ahead = F.posexplode(F.slice("tokens", F.col("i") + 2, room)).alias("at", "token")
            wide = wide.select("key", "node", "n", "i", "pos", "m", "prefix", "comp", ahead)
            index = F.xxhash64("key", "token").alias("key")
            children = saved(wide.select(F.col("key").alias("parent"), index, "node", "n", (F.col("i") + 1 + F.col("at")).alias("i"), "pos", "m", "prefix", "comp"), f"join-wider{k}")
            # a key is extended only where its extensions have fewer pairs to meet
            held = children.groupBy("parent", "key").agg(F.count("*").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
            held = saved(held.select("parent", "key", "c"), f"join-deeper{k}")
            cost = held.groupBy("parent").agg(F.sum(F.col("c") * (F.col("c") - 1)).alias("cost"))
            direct = lists.join(cost.withColumnRenamed("parent", "key"), "key", "left")
            direct = saved(direct.withColumn("direct", (F.col("c") <= few) | (F.coalesce("cost", F.lit(0)) >= F.col("c") * (F.col("c") - 1))), f"join-direct{k}")
        mine = level.join(direct.filter("direct").select("key", "kept"), "key")
        mine = mine.groupBy(F.col("kept").alias("key"), "node").agg(F.min("pos").alias("pos"), F.first("n").alias("n"), F.first("comp").alias("comp"))
        mine = mine.select("key", "node", "n", "pos", "comp")
        ready = mine if ready is None else ready.union(mine)
        if children is not None:
            deeper = held.join(direct.filter(~F.col("direct")).select(F.col("key").alias("parent")), "parent", "left_semi").select("parent", "key")
            level = children.join(saved(deeper, f"join-next{k}"), ["parent", "key"], "left_semi").drop("parent")
    keyed = saved(saved(ready, "join-keyed").join(maps, "node"), "join-mapped")
    a, b = keyed.alias("a"), keyed.alias("b")
    fits = (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.comp") != F.col("b.comp"))
    size = 100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")
    ahead = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    reach = (100 + percent) * ahead >= percent * (F.col("a.n") + F.col("b.n"))
    pairs = a.join(b, fits & size & reach & _possible("a.{}", "b.{}", percent)).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.comp").alias("x"), F.col("b.comp").alias("y")).distinct()
    more = _verified(saved(pairs, "join-pairs"), classes, percent, "join-more", "x", "y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    more = saved(more, "join-more")
    return _relabelled(labels, more, "join-cc") if more.limit(1).count() else labels


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75, few: int = 64) -> DataFrame:
    """Every row: doc_id, text_id, n_shingles, component_id (smallest doc_id of its component), node, comp."""
    rows = saved(shared_tokens(docs, words, percent), "join-docs")
    comp = link_components(rows, percent, few)
    ids = rows.select("doc_id", "text_id", "n_shingles", "node")
    sets = saved(ids.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least")), "join-sets")
    where = sets.join(comp, "node", "left").select("node", "least", F.coalesce("comp", "node").alias("comp"))
    where = saved(where, "join-where")
    low = where.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = saved(where.join(low, "comp").select("node", "comp", "component_id"), "join-named")
    full = ids.filter("n_shingles > 0").join(named, "node")
    empty = ids.filter("n_shingles = 0").withColumns({"comp": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    cols = ["doc_id", "text_id", "n_shingles", "component_id", "node", "comp"]
    return full.select(*cols).unionByName(empty.select(*cols))


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """One document of each component (the smallest doc_id, then text id), with all columns; empty sets all stay."""
    found = saved(near_duplicates(docs, **params), "join-found")
    best = found.filter("n_shingles > 0").groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_id")).alias("k"))
    keep = best.select(F.col("k.doc_id").alias("k_doc"), F.col("k.text_id").alias("k_text"))
    keep = keep.union(found.filter("n_shingles = 0").select("doc_id", "text_id").distinct())
    keep = saved(keep, "join-keep")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("k_doc0"), text_id().alias("k_text0"))
    kept = rows.join(keep, F.col("k_doc0").eqNullSafe(F.col("k_doc")) & (F.col("k_text0") == F.col("k_text")))
    twice = found.filter("n_shingles > 0").groupBy("doc_id", "text_id").agg(F.count("*").alias("c")).filter("c > 1").limit(1).count()
    if twice:  # equal rows (same id and text): one of them stays
        words = F.length(F.trim(F.translate(F.coalesce("row.text", F.lit("")), "\t\n\x0b\x0c\r", "     "))) > 0
        kept = kept.filter(~words).unionByName(kept.filter(words).dropDuplicates(["k_doc0", "k_text0"]))
    return kept.select("row.*")
