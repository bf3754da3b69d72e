"""Query sets against all vectors in blocks: bounded cells, merged by rank."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.common import shuffle_parts


def usable_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", zero: bool = True) -> DataFrame:
    """(vec_id long, vector array<double>) of rows with an id and a vector without null or non-finite parts."""
    v = F.col("vector")
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    out = out.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine)
    return out if zero else out.filter(F.exists(v, lambda x: x != 0))


def distinct_queries(vectors: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``, once an id: where rows of one id differ, the smallest vector asks."""
    return vectors.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def in_cells(vectors: DataFrame, queries: DataFrame, build, search, schema: pa.Schema, block_rows: int, query_rows: int) -> DataFrame:
    """Every block of vectors meets every query: ``search(build(ids, matrix), query id, query vector)`` gives result rows.

    A cell is a block of about ``block_rows`` vectors and a chunk of at most about ``query_rows`` queries: it builds its
    index once and the queries stream past it, so a vector is copied once a chunk (once up to ``query_rows`` queries)
    and memory holds a block, whatever the number of queries.  Blocks go by id and vector: an id on many rows is spread.
    """
    n, q = vectors.count(), queries.count()
    blocks, chunks = max(1, -(-n // block_rows)), max(1, -(-q // query_rows))
    left = vectors.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int").alias("block"),
                          F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(0).alias("kind"))
    right = queries.select("vec_id", "vector", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                           F.pmod(F.xxhash64(F.lit(1), F.col("vec_id")), F.lit(chunks)).cast("int").alias("chunk"), F.lit(1).alias("kind"))
    cell = ["block", "chunk"]
    rows = left.unionByName(right).repartition(shuffle_parts(vectors.sparkSession), *cell).sortWithinPartitions(*cell, "kind")
    ddl = ", ".join(f"{f.name} {'double' if f.type == pa.float64() else 'long'}" for f in schema)

    def run(batches):
        now, held, index = None, [], {}
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in (2, 3, 4)])
            cuts = np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                if lo == hi:
                    continue
                part, at = batch.slice(lo, hi - lo), tuple(where[:2, lo])
                if at != now:
                    now, held, index = at, [], {}
                if where[2, lo] == 0:
                    held.append(part)
                    continue
                if held:  # the block is whole: its vectors come first
                    index = {d: build(*x) for d, x in by_length(pa.Table.from_batches(held)).items()}
                    held = []
                out = [r for d, (ids, x) in by_length(pa.Table.from_batches([part])).items() if d in index for i, v in zip(ids.tolist(), x, strict=True) for r in search(index[d], i, v)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return rows.mapInArrow(run, ddl)


def best_ranked(found: DataFrame, k: int, *order) -> DataFrame:
    """The k first rows of each query (each cell brought at most k)."""
    w = Window.partitionBy("query_id").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)


def by_length(rows: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{vector length: (ids, matrix)}, rows in id order."""
    ids = rows["vec_id"].to_numpy()
    vectors = rows["vector"].combine_chunks()
    n = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    start = np.cumsum(n) - n
    out = {}
    for d in np.unique(n):
        at = np.flatnonzero(n == d)
        at = at[np.argsort(ids[at], kind="stable")]
        out[int(d)] = (ids[at], flat[start[at][:, None] + np.arange(d)])
    return out
