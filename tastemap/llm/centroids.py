"""Centroid clustering in whole numbers over blocks with zone maps.

Vectors are laid along a Hilbert curve through their widest axes and cut into blocks of
``BLOCK`` neighbours; a block row carries its vectors, the box they lie in and their sum.
In a round a block bounds its distance to each centroid from the box alone: a centroid whose
least distance to the box exceeds another one's greatest cannot be the nearest of any vector
in it.  If one centroid is left, the whole block belongs to it and its sum is ready; else the
left ones are compared with every vector, in whole numbers.  Tasks return one partial sum per
centroid, so a round shuffles a few rows a task and the driver sees the centroids only.

The curve and the boxes decide how much is compared, never the result: components, distances
and means are exact integers.  Components under ``SMALL`` are handled in 64-bit arithmetic,
blocks with larger ones in Python integers.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
BLOCK = 512
AXES, BITS = 16, 4                 # of the curve: a 64-bit key
SMALL = 1 << 27                    # 64 squared differences of such numbers fit 64 bits
MOST = (1 << 63) - 1


# ------------------------------------------------------------------ the curve

def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve (unsigned) of integer cells (n, axes) with ``bits`` bits
    a coordinate; axes * bits is at most 64."""
    x = cells.astype(np.uint64).copy()
    axes = x.shape[1]
    one = np.uint64(1)
    q = 1 << (bits - 1)
    while q > 1:                                   # from cells to the curve's transposed index
        low = np.uint64(q - 1)
        for i in range(axes):
            hit = (x[:, i] & np.uint64(q)) != 0
            swap = np.where(hit, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, i] ^= swap
            x[:, 0] ^= np.where(hit, low, swap if i else np.uint64(0))
        q >>= 1
    for i in range(1, axes):                       # Gray code
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), dtype=np.uint64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[:, -1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << one) | ((x[:, i] >> np.uint64(b)) & one)
    return key


def _spread(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(axes, least, width): the widest axes of all vectors and the range their cells divide."""
    def partial(batches):
        n, s, q = 0, np.zeros(0), np.zeros(0)
        for b in batches:
            v = _matrix(b.column("v"))
            if len(v):
                with np.errstate(all="ignore"):
                    s, q = (s, q) if len(s) else (np.zeros(v.shape[1]), np.zeros(v.shape[1]))
                    n, s, q = n + len(v), s + v.sum(axis=0), q + (v * v).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": list(range(len(s))), "n": [n] * len(s), "s": s.tolist(), "q": q.tolist()},
                                         schema=pa.schema([("i", pa.int32()), ("n", pa.int64()), ("s", pa.float64()), ("q", pa.float64())]))
    parts = vectors.select("v").mapInArrow(partial, "i int, n long, s double, q double")
    got = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("i").collect()
    with np.errstate(all="ignore"):
        n = np.array([r["n"] for r in got], dtype=float)
        mean = np.nan_to_num(np.array([r["s"] for r in got]) / n)
        dev = np.sqrt(np.maximum(np.nan_to_num(np.array([r["q"] for r in got]) / n - mean * mean, posinf=1e300), 0))
    axes = np.argsort(-dev, kind="stable")[:AXES]
    return axes, mean[axes] - 2 * dev[axes], np.where(dev[axes] > 0, 4 * dev[axes], 1.0)


# ------------------------------------------------------------------ blocks

def _matrix(column) -> np.ndarray:
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(rows, len(flat) // rows) if rows else np.zeros((0, 0))


def _whole(row, scale: int) -> list[int]:
    """floor(scale * x) as Python integers, also where the product leaves the doubles."""
    return [math.floor(x * scale) if abs(x) < 2.0 ** 52 else int(x) * scale for x in row]


def _packed(v: np.ndarray, scale: int) -> list[tuple[bool, bytes]]:
    """Per row: is it wide, and its integers (32-bit, or as text when wide)."""
    with np.errstate(over="ignore"):
        f = np.floor(v * scale)
    small = (np.abs(f) < SMALL).all(axis=1)
    ints = np.where(small[:, None], f, 0).astype("<i4")
    return [(False, ints[i].tobytes()) if ok else (True, ",".join(map(str, _whole(v[i].tolist(), scale))).encode())
            for i, ok in enumerate(small.tolist())]


def _unpacked(wide: bool, rows: list[bytes]) -> np.ndarray:
    if wide:
        return np.array([[int(x) for x in r.split(b",")] for r in rows], dtype=object)
    return np.frombuffer(b"".join(rows), dtype="<i4").reshape(len(rows), -1).astype(np.int64)


def vector_blocks(vectors: DataFrame, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """Written blocks (ids, wide, rows, lo, hi, total) of ``vectors`` (id, v): neighbours on
    the curve; lo, hi and total are the box and the sum as text."""
    axes, least, width = _spread(vectors)
    kind = vectors.schema["id"].dataType
    shape = f"id {kind.simpleString()}, wide boolean, x binary, key long"

    def keyed(batches):
        for b in batches:
            v = _matrix(b.column("v"))
            if len(v) == 0:
                continue
            with np.errstate(all="ignore"):
                cells = np.clip(np.nan_to_num((v[:, axes] - least) / width) * 2 ** BITS, 0, 2 ** BITS - 1).astype(np.uint64)
            key = (hilbert_keys(cells, BITS) ^ np.uint64(1 << 63)).view(np.int64)
            wide, x = zip(*_packed(v, scale))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(wide), pa.array(x, pa.binary()), pa.array(key)],
                                             names=["id", "wide", "x", "key"])

    def cut(batches):
        held = {False: ([], []), True: ([], [])}

        def out(wide):
            ids, rows = held[wide]
            m = _unpacked(wide, rows)
            text = [",".join(map(str, a.tolist())) for a in (m.min(axis=0), m.max(axis=0), m.sum(axis=0))]
            held[wide] = ([], [])
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(kinds)), pa.array([wide]), pa.array([rows], pa.list_(pa.binary())),
                 *[pa.array([t]) for t in text]], names=["ids", "wide", "rows", "lo", "hi", "total"])

        for b in batches:
            kinds = b.column("id").type
            for i, wide, x in zip(b.column("id").to_pylist(), b.column("wide").to_pylist(), b.column("x").to_pylist()):
                held[wide][0].append(i)
                held[wide][1].append(x)
                if len(held[wide][0]) == block:
                    yield out(wide)
        for wide in (False, True):
            if held[wide][0]:
                yield out(wide)

    # the salt parts vectors of one cell, copies included, over several ranges
    laid = (vectors.mapInArrow(keyed, shape).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
            .repartitionByRange("key", "salt").sortWithinPartitions("key", "salt").select("id", "wide", "x"))
    ids = f"array<{kind.simpleString()}>"
    return written(laid.mapInArrow(cut, f"ids {ids}, wide boolean, rows array<binary>, lo string, hi string, total string"), "blocks")


# ------------------------------------------------------------------ rounds

def _ints(text: str) -> np.ndarray:
    v = [int(x) for x in text.split(",")]
    return np.array(v, dtype=np.int64 if max(map(abs, v)) < SMALL else object)


def candidates(lo: np.ndarray, hi: np.ndarray, centres: list[np.ndarray]) -> list[int]:
    """Centroids that may be the nearest of a vector in the box."""
    near, far = [], []
    for c in centres:
        gap = np.maximum(np.maximum(lo - c, c - hi), 0)
        reach = np.maximum(c - lo, hi - c)
        near.append((gap * gap).sum())
        far.append((reach * reach).sum())
    least = min(far)
    return [k for k, d in enumerate(near) if d <= least]


def nearest(m: np.ndarray, left: list[int], centres: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) of every row among ``left`` (ascending); ties: smaller."""
    best = which = None
    for k in left:
        diff = m - centres[k]
        d = (diff * diff).sum(axis=1)
        if best is None:
            best, which = d, np.full(len(m), k)
        else:
            closer = np.asarray(d < best, dtype=bool)
            best, which = np.where(closer, d, best), np.where(closer, k, which)
    return which, best


def _centres(centroids: list[list[int]]) -> list[np.ndarray]:
    return [np.array(c, dtype=np.int64 if max(map(abs, c)) < SMALL else object) for c in centroids]


def round_sums(blocks: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """{centroid: (vectors, their sum)} of one assignment; at most one row a centroid."""
    def partial(batches):
        centres = _centres(centroids)
        n, sums = [0] * len(centres), [None] * len(centres)

        def add(k, count, total):
            n[k] += count
            sums[k] = total if sums[k] is None else [a + b for a, b in zip(sums[k], total)]

        for b in batches:
            for r in b.to_pylist():
                left = candidates(_ints(r["lo"]), _ints(r["hi"]), centres)
                if len(left) == 1:
                    add(left[0], len(r["rows"]), [int(x) for x in r["total"].split(",")])
                    continue
                m = _unpacked(r["wide"], r["rows"])
                which, _ = nearest(m, left, centres)
                for k in np.unique(which).tolist():
                    own = m[which == k]
                    add(k, len(own), [int(x) for x in own.sum(axis=0)])
        found = [k for k in range(len(centres)) if n[k]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array([n[k] for k in found], pa.int64()),
             pa.array([",".join(map(str, sums[k])) for k in found], pa.string())], names=["k", "n", "total"])

    def merge(t: pa.Table) -> pa.Table:
        total = None
        for row in t.column("total").to_pylist():
            v = [int(x) for x in row.split(",")]
            total = v if total is None else [a + b for a, b in zip(total, v)]
        return pa.table({"k": t.column("k")[:1], "n": pa.array([sum(t.column("n").to_pylist())], pa.int64()),
                         "total": [",".join(map(str, total))]})

    parts = blocks.select("wide", "rows", "lo", "hi", "total").mapInArrow(partial, "k int, n long, total string")
    found = parts.groupBy("k").applyInArrow(merge, "k int, n long, total string").collect()
    return {r["k"]: (r["n"], [int(x) for x in r["total"].split(",")]) for r in found}


def assigned(blocks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(id, cluster, distance) of every vector; distances beyond 2^63 - 1 show as that."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def assign(batches):
        centres = _centres(centroids)
        for b in batches:
            kinds = b.column("ids").type.value_type
            for r in b.to_pylist():
                which, d = nearest(_unpacked(r["wide"], r["rows"]),
                                   candidates(_ints(r["lo"]), _ints(r["hi"]), centres), centres)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], kinds), pa.array(which, pa.int32()),
                     pa.array([min(int(x), MOST) for x in d.tolist()], pa.int64())], names=["id", "cluster", "distance"])

    return blocks.select("ids", "wide", "rows", "lo", "hi").mapInArrow(assign, f"id {kind}, cluster int, distance long")


def first_centroids(vectors: DataFrame, clusters: int, seed: int, scale: int) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed:id``; ties by the components."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(text, 256), "v").limit(clusters).collect()
    return [_whole(r["v"], scale) for r in rows]


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS,
                    clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE,
                    block: int = BLOCK) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector with
    ``dimensions`` finite components.

    Vectors that are null, of another length, or hold null or non-finite components have no
    row.  Repeated rows are vectors of their own; a null id is the empty text when the first
    centroids are chosen.  Fewer vectors than ``clusters`` are all first centroids; an empty
    table gives no rows.  Sums and distances beyond 2^63 - 1 show as that.  Extra columns,
    whatever their names, are not looked at."""
    fine = (F.size(vector_col) == dimensions) & F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = (df.filter(F.col(vector_col).isNotNull() & fine)
               .select(F.col(id_col).alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v")))
    kind = vectors.schema["id"].dataType.simpleString()
    centroids = first_centroids(vectors, clusters, seed, scale)
    spark = df.sparkSession
    if not centroids:
        return spark.createDataFrame([], f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    blocks = vector_blocks(vectors, scale, block)
    for _ in range(rounds):
        found = round_sums(blocks, centroids)
        moved = [[s // found[k][0] for s in found[k][1]] if k in found else c for k, c in enumerate(centroids)]
        if moved == centroids:
            break                                   # every further round repeats this one
        centroids = moved
    out = written(assigned(blocks, centroids), "assigned")
    most = F.lit(MOST).cast("decimal(38,0)")
    sums = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("decimal(38,0)").alias("s")).collect()
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    whole = min(int(sum(r["s"] for r in sums)), MOST)
    each = spark.createDataFrame([(r["cluster"], min(int(r["s"]), MOST), whole, digest[r["cluster"]]) for r in sums],
                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(each), "cluster").select(      # at most one row a centroid
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


# ------------------------------------------------------------------ the same in SQL

def clusters_sql(dimensions: int = DIMENSIONS, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
                 scale: int = SCALE, table: str = "embeddings") -> str:
    def assign(k):
        return f"""d{k} AS (SELECT e.n, c.c, sum((e.x - c.x) * (e.x - c.x)) AS d FROM e JOIN c{k} c USING (i) GROUP BY e.n, c.c),
a{k} AS MATERIALIZED (SELECT n, c, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, c) = 1)"""
    def move(k):
        return f"""m{k} AS (SELECT a.c, e.i, sum(e.x) AS s, count(*) AS m FROM a{k} a JOIN e USING (n) GROUP BY a.c, e.i),
c{k + 1} AS MATERIALIZED (SELECT o.c, o.i, CASE WHEN m.s IS NULL THEN o.x WHEN m.s >= 0 THEN CAST(m.s // m.m AS BIGINT)
  ELSE CAST(-((-m.s + m.m - 1) // m.m) AS BIGINT) END AS x FROM c{k} o LEFT JOIN m{k} m USING (c, i))"""
    steps = ",\n".join([f"{assign(k)},\n{move(k)}" for k in range(rounds)] + [assign(rounds)])
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM {table} WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS MATERIALIZED (SELECT n, unnest(range({dimensions})) AS i, unnest(x) AS x FROM v),
f AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS c, x FROM v
      QUALIFY c < {clusters}),
c0 AS MATERIALIZED (SELECT c, unnest(range({dimensions})) AS i, unnest(x) AS x FROM f),
{steps},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
FROM a{rounds} JOIN v USING (n) JOIN h USING (c)"""
