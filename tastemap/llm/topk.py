"""Exact top-k inner products: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz.

The vectors are range-partitioned by descending length into blocks.  A rotation by the
right singular vectors of all vectors (eigenvectors of their Gram matrix, summed in Spark;
d x d numbers on the driver) puts most of every inner product into the first coordinates.

Every query first meets the block of the longest vectors, which gives it a score that k
vectors reach.  It then meets only the blocks whose longest vector times its own length
can reach that score, and within a block a candidate's remaining coordinates are added
only if its partial sum plus the product of the residual lengths can.  Scores themselves
are computed from the unrotated integer vectors, so they are exact; the bounds carry a
margin for rounding.

Queries are dealt in chunks, candidates in blocks; a task holds one of each.  Per pair of
them at most k rows a query leave the task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K = 5
SCALE = 256
QUERY_STEP = 50
BLOCK_ROWS = 8192
CHUNK_ROWS = 4096
HEAD = 16                     # rotated coordinates of the partial sums
EXACT_DOUBLE = 2.0 ** 53


# ------------------------------------------------------------------ vectors

def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<double> of integers, norm) of the distinct rows that take part."""
    x = F.col("x")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    base = base.filter(F.col("vec_id").isNotNull() & x.isNotNull() & fine)
    whole = base.select("vec_id", F.transform(x, lambda c: F.floor(c * float(scale)).cast("double")).alias("v")).distinct()
    return whole.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)))


def _matrix(column, width: int) -> np.ndarray:
    """Arrow list column -> float64 matrix of ``width`` columns (missing ones are 0)."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, col] = flat
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, largest singular value first."""
    def gram(batches):
        import pyarrow as pa
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width), pa.int32()), pa.array(total.ravel())],
                                         names=["cell", "x"])
    cells = vectors.select("v").mapInArrow(gram, "cell int, x double").groupBy("cell").agg(F.sum("x").alias("x"))
    total = np.zeros(width * width)
    for r in cells.collect():                         # width^2 numbers
        total[r["cell"]] = r["x"]
    values, vectors_ = np.linalg.eigh(total.reshape(width, width))
    return np.ascontiguousarray(vectors_[:, ::-1])


# ------------------------------------------------------------------ chunk against block

def inner_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products as int64."""
    bound = np.sqrt((q * q).sum(1).max(initial=0) * (x * x).sum(1).max(initial=0))
    if bound < EXACT_DOUBLE:
        return (q @ x.T).astype(np.int64)
    if bound >= 2.0 ** 63:
        raise ValueError("a score does not fit 64 bits")
    return q.astype(np.int64) @ x.T.astype(np.int64)


def best_of_block(q_ids, q, floor, x_ids, x, turn: np.ndarray, k: int, step: int = 256):
    """(query row, candidate row, score) of the k best candidates of each query that can
    reach ``floor``; ties to the smaller id.  ``step`` queries are held at a time."""
    head = min(HEAD, turn.shape[1])
    qr, xr = q @ turn, x @ turn
    rest_q, rest_x = (np.sqrt((m[:, head:] ** 2).sum(1)) for m in (qr, xr))
    size_q, size_x = (np.sqrt((m * m).sum(1)) for m in (q, x))
    found = []
    for s in range(0, len(q), step):
        part = slice(s, min(s + step, len(q)))
        reach = qr[part, :head] @ xr[:, :head].T
        # residual lengths by Cauchy-Schwarz, and a margin for rounding
        reach += np.column_stack([rest_q[part], 1e-9 * size_q[part]]) @ np.stack([rest_x, size_x])
        open_ = reach >= floor[part, None] - 1e-6
        open_ &= q_ids[part, None] != x_ids[None, :]
        products = inner_products(q[part], x) if open_.mean() > 0.05 else None
        for i in np.flatnonzero(open_.any(axis=1)).tolist():
            at = np.flatnonzero(open_[i])
            score = inner_products(q[s + i:s + i + 1], x[at])[0] if products is None else products[i, at]
            if len(at) > k:
                keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                at, score = at[keep], score[keep]
            order = np.lexsort((x_ids[at], -score))[:k]
            found.append((np.full(len(order), s + i), at[order], score[order]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(z) for z in zip(*found))


def _search(queries: DataFrame, blocks: DataFrame, turn: np.ndarray, k: int) -> DataFrame:
    """queries (chunk, block, vec_id, v, floor) against blocks (chunk, block, vec_id, v)."""
    width = turn.shape[0]

    def pair(left, right):
        import pyarrow as pa
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                 "score": pa.array([], pa.int64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        q_ids, x_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        floor = left["floor"].to_numpy()
        i, j, s = best_of_block(q_ids, _matrix(left["v"], width), floor, x_ids, _matrix(right["v"], width), turn, k)
        return pa.table({"query_id": pa.array(q_ids[i]), "vec_id": pa.array(x_ids[j]), "score": pa.array(s)})

    keys = ["chunk", "block"]

    def own(df, *columns):            # columns of its own: both sides may stem from one table
        return df.select(*[F.col(c).alias(c) for c in (*keys, "vec_id", "v", *columns)])

    return (own(queries, "floor").groupBy(*keys).cogroup(own(blocks).groupBy(*keys))
            .applyInArrow(pair, "query_id long, vec_id long, score long"))


# ------------------------------------------------------------------ operator

def top_inner_products(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
                       query_step: int = QUERY_STEP, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
                       chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query (ids divisible
    by ``query_step``), all others if fewer.

    Rows with a null id or vector, or a vector with null or non-finite components, take no
    part; repeated rows count once; a shorter vector counts as padded with zeros; rows
    with the query's id are not its candidates.  No valid rows give an empty result."""
    vectors = integer_vectors(rows, id_col, vector_col, scale)
    vectors = written(vectors, "integer-vectors")
    totals = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = totals["n"], max(1, totals["width"] or 1)
    turn = rotation(vectors, width)
    n_blocks = max(1, -(-n // block_rows))
    blocks = written(vectors.repartitionByRange(n_blocks, F.desc("norm"), "vec_id")
                     .withColumn("block", F.spark_partition_id()), "norm-blocks")
    lengths = blocks.groupBy("block").agg(F.max("norm").alias("longest"), F.count("*").alias("n"))
    first_block = lengths.agg(F.min("block").alias("b")).first()["b"] or 0
    is_query = F.pmod(F.col("vec_id"), F.lit(query_step)) == 0
    n_queries = vectors.filter(is_query).count()
    chunks = max(1, -(-n_queries // chunk_rows))
    queries = vectors.filter(is_query).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))

    # 1. a floor for every query from the block of the longest vectors
    top = blocks.filter(F.col("block") == F.lit(first_block))
    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    seeds = _search(queries.withColumn("block", F.lit(first_block)).withColumn("floor", F.lit(float("-inf"))),
                    top.withColumn("chunk", every_chunk), turn, k)
    seeds = written(seeds, "top-seeds")
    floors = (seeds.groupBy("query_id").agg(F.count("*").alias("found"), F.min("score").alias("least"))
              .select(F.col("query_id").alias("vec_id"),
                      F.when(F.col("found") >= k, F.col("least").cast("double")).alias("floor")))
    # 2. the blocks that can reach it (Cauchy-Schwarz on the longest vector of the block)
    aimed = (queries.join(floors, "vec_id", "left")
             .withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))))
    others = lengths.filter(F.col("block") != F.lit(first_block)).agg(
        F.sort_array(F.collect_list(F.struct("block", "longest"))).alias("blocks"))     # n / block_rows entries
    reach = F.filter("blocks", lambda b: b["longest"] * F.col("norm") * (1 + 1e-9) + 1e-6 >= F.col("floor"))
    aimed = aimed.crossJoin(F.broadcast(others)).withColumn("block", F.explode(F.transform(reach, lambda b: b["block"])))
    aimed = written(aimed.select("chunk", "block", "vec_id", "v", "floor"), "top-queries")
    wanted = aimed.select("chunk", "block").distinct()
    rest = _search(aimed, blocks.join(wanted, "block"), turn, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (seeds.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_products_sql(k: int = K, query_step: int = QUERY_STEP, scale: int = SCALE, table: str = "embeddings") -> str:
    return f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
           FROM {table}
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % {query_step} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
