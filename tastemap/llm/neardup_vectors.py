"""Embedding near-duplicates by sorted projection passes.

Each pass hashes every distinct vector to the signs of ``BITS`` random projections,
concatenated into one key, sorts the vectors by it, and compares each with the next
``WINDOW`` in the order; the verified pairs of all passes are united into components.
Vectors that agree in the leading signs are compared whether or not they fit a window: a
run of equal leading signs that is longer is dealt out as pairs of blocks.  So the number
of passes follows from the table's size alone, and a pair at the threshold is missed by
all passes with a probability below ``MISS`` however dense its surroundings are.  Where
these blocks would cost more than comparing all vectors with one another once, that is
done instead.

A window does not see all pairs of a large group of near copies, and need not: it only
has to connect the group.  The links are then counted exactly, by comparing all vectors
of a component with one another in blocks (every link lies within one component).  A
component of any size is dealt out as pairs of blocks, and only counts leave the tasks.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_value, written
from .components import connected_components
from .topk import _matrix

COSINE = 0.9
BITS = 62
WINDOW = 256
MISS = 1e-3
BLOCK = 2048
SEED = 77


def leading_signs(n: int, window: int = WINDOW) -> int:
    """So many that evenly spread vectors with equal leading signs fit half a window."""
    return min(BITS, max(1, math.ceil(math.log2(max(2, n) / window) + 1)))


def passes_for(n: int, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Two vectors at the threshold agree in a projection's sign with probability
    1 - angle / pi; they are compared when they agree in ``leading_signs``."""
    agree = 1 - math.acos(cosine) / math.pi
    met = agree ** leading_signs(n, window)
    return max(4, math.ceil(math.log(miss) / math.log1p(-met)))


def projections(width: int, passes: int, seed: int = SEED) -> np.ndarray:
    """(width, passes * BITS) random directions, the same for the same arguments."""
    return np.random.default_rng([seed, width]).standard_normal((passes, BITS, width)).reshape(-1, width).T


def _column(rows: DataFrame, vector_col: str):
    """The vectors as they are if single precision, else as doubles; all arithmetic is in
    double precision either way, single ones are moved around at half the size."""
    single = rows.schema[vector_col].dataType.simpleString() == "array<float>"
    return F.col(vector_col).cast("array<float>" if single else "array<double>")


def distinct_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(node, x, copies, least): the distinct vectors that can link, with the number of
    rows that hold them and their smallest id."""
    x = F.col("x")
    base = rows.select(F.col(id_col).alias("id"), _column(rows, vector_col).alias("x"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    some = F.exists(x, lambda c: c != 0.0)
    return (base.filter(x.isNotNull() & fine & some).groupBy("x")
            .agg(F.count("*").alias("copies"), F.min("id").alias("least"))
            .withColumn("node", F.monotonically_increasing_id()))


def _unit(m: np.ndarray) -> np.ndarray:
    scale = np.abs(m).max(axis=1, keepdims=True)          # no overflow for huge components
    m = m / scale
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _keyed(vectors: DataFrame, width: int, passes: int, seed: int) -> DataFrame:
    """(pass, key, node, x) of every vector in every pass."""
    powers = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    directions = broadcast_value(vectors, projections(width, passes, seed))      # passes * BITS * width numbers

    def hashed(batches):
        import pyarrow as pa
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                unit = _unit(_matrix(part.column(1), width))
                for p in range(passes):
                    signs = unit @ directions.value[:, p * BITS:(p + 1) * BITS] > 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(part.num_rows, p, np.int32)), pa.array(signs @ powers), part.column(0),
                         part.column(1)], names=["pass", "key", "node", "x"])
    kind = vectors.schema["x"].dataType.simpleString()
    return vectors.select("node", "x").mapInArrow(hashed, f"pass int, key long, node long, x {kind}")


def band_forest(linked: np.ndarray):
    """Spanning forest (pairs of rows) of the graph with this upper-triangular matrix."""
    full = linked | linked.T
    left = full.any(axis=1)
    a, b = [], []
    for start in np.flatnonzero(left).tolist():
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            at = queue.pop()
            found = np.flatnonzero(full[at] & left)
            left[found] = False
            a.extend([at] * len(found))
            b.extend(found.tolist())
            queue.extend(found.tolist())
    return a, b


def _linked_pairs(order: np.ndarray, node: np.ndarray, unit: np.ndarray, old: int, window: int, cosine: float):
    """A forest of the links of rows within ``window`` places of one pass, with at least
    one row from place ``old`` on."""
    n = len(node)
    i, j = np.arange(n)[:, None], np.arange(n)[None, :]
    band = (j > i) & (j - i <= window) & (j >= old) & (order[:, None] == order[None, :])
    a, b = band_forest(band & (unit @ unit.T >= cosine))
    return node[a], node[b]


def window_links(vectors: DataFrame, width: int, passes: int, window: int = WINDOW, cosine: float = COSINE,
                 seed: int = SEED) -> DataFrame:
    """Verified links (a, b) among neighbours in the orders of all passes.

    A task compares the rows of its range of the order; its first and last ``window``
    rows are also given out, and a second small step compares across the seams."""
    spark = vectors.sparkSession
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                       vectors.count() * passes // (16 * window)))
    kind = vectors.schema["x"].dataType.simpleString()
    schema = f"a long, b long, seam int, side int, pass int, key long, node long, x {kind}"

    def compare(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        kept, kept_rows, seen = None, None, 0
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(),
                 pa.list_(pa.float32() if "float" in kind else pa.float64())]
        names = [f.split()[0] for f in schema.split(", ")]

        def links(a, b):
            cols = [pa.array(a), pa.array(b)] + [pa.nulls(len(a), t) for t in types[2:]]
            return pa.RecordBatch.from_arrays(cols, names=names)

        def ends(rows, seam, side):
            m = rows.num_rows
            return pa.RecordBatch.from_arrays(
                [pa.nulls(m, types[0]), pa.nulls(m, types[1]), pa.array([seam] * m, types[2]),
                 pa.array([side] * m, types[3]), *[rows.column(c).cast(t) for c, t in zip(range(4), types[4:])]],
                names=names)

        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                rows = batch.slice(s, 512)
                if seen < window:
                    yield ends(rows.slice(0, window - seen), part - 1, 1)
                seen += rows.num_rows
                now = (rows.column(0).to_numpy(), rows.column(2).to_numpy(), _unit(_matrix(rows.column(3), width)))
                old = 0
                if kept is not None:
                    old = len(kept[0])
                    now = tuple(np.concatenate(z) for z in zip(kept, now))
                a, b = _linked_pairs(*now, old, window, cosine)
                if len(a):
                    yield links(a, b)
                kept = tuple(z[-window:] for z in now)
                both = rows if kept_rows is None else pa.concat_batches([kept_rows, rows])
                kept_rows = both.slice(max(0, both.num_rows - window))
        if kept_rows is not None:
            yield ends(kept_rows, part, 0)

    def across(table):
        import pyarrow as pa
        order, key, node, side = (table[c].to_numpy() for c in ("pass", "key", "node", "side"))
        at = np.lexsort((node, key, order))
        a, b = _linked_pairs(order[at], node[at], _unit(_matrix(table["x"], width))[at], 0, window, cosine)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    found = written(_keyed(vectors, width, passes, seed).repartitionByRange(parts, "pass", "key", "node")
                    .sortWithinPartitions("pass", "key", "node").mapInArrow(compare, schema), "window-links")
    seams = found.filter("seam is not null").groupBy("seam").applyInArrow(across, "a long, b long")
    return found.filter("a is not null").select("a", "b").unionByName(seams).distinct()


# ------------------------------------------------------------------ runs longer than a window

def _block_links(width: int, cosine: float):
    """Rows (chunk, i, j, node, x) of some runs -> a forest of the links within chunk i, or
    between the chunks i and j, of each run."""
    def link(table):
        import pyarrow as pa
        root, chunk, node, i, j = (table[c].to_numpy() for c in ("root", "chunk", "node", "i", "j"))
        order = np.lexsort((node, chunk, root))
        root, chunk, node, i, j = (z[order] for z in (root, chunk, node, i, j))
        unit = _unit(_matrix(table["x"], width)[order])
        cuts = np.flatnonzero(np.concatenate(([True], root[1:] != root[:-1], [True])))
        a, b = [], []
        for s, e in zip(cuts.tolist(), cuts[1:].tolist()):
            if i[s] == j[s]:
                near = np.triu(unit[s:e] @ unit[s:e].T >= cosine, 1)
            else:
                m = int(np.searchsorted(chunk[s:e], j[s]))
                near = np.zeros((e - s, e - s), dtype=bool)
                near[:m, m:] = unit[s:s + m] @ unit[s + m:e].T >= cosine
            if near.any():
                p, q = band_forest(near)
                a.append(node[s:e][p])
                b.append(node[s:e][q])
        none = np.empty(0, np.int64)
        return pa.table({"a": pa.array(np.concatenate([none, *a])), "b": pa.array(np.concatenate([none, *b]))})
    return link


def _links_within(members: DataFrame, width: int, cosine: float, block: int) -> DataFrame:
    """Links (a, b) that connect what links within each root of ``members`` (root, size,
    node, x), as pairs of blocks; small roots share a task."""
    n_small = members.filter(F.col("size") <= block).count()
    buckets = max(1, -(-n_small // block))
    zero = F.lit(0)
    small = (members.filter(F.col("size") <= block)
             .select(F.pmod(F.xxhash64("root"), F.lit(buckets)).alias("g"), zero.alias("i"), zero.alias("j"),
                     zero.alias("chunk"), "root", "node", "x"))
    chunks = F.ceil(F.col("size") / block).cast("int")
    large = (members.filter(F.col("size") > block).withColumn("chunks", chunks)
             .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(zero, F.col("chunks") - 1)))
             .select(F.col("root").alias("g"), F.least("chunk", "other").alias("i"),
                     F.greatest("chunk", "other").alias("j"), "chunk", "root", "node", "x"))
    link = _block_links(width, cosine)
    parts = [z.groupBy("g", "i", "j").applyInArrow(link, "a long, b long") for z in (small, large)]
    return parts[0].unionByName(parts[1])


def all_links(vectors: DataFrame, n: int, width: int, passes: int, window: int = WINDOW, cosine: float = COSINE,
              block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Links (a, b) among the vectors that agree in the leading signs of some pass."""
    lead = F.shiftright("key", BITS - leading_signs(n, window)).alias("lead")
    keyed = _keyed(vectors, width, passes, seed)
    runs = written(keyed.groupBy("pass", lead).agg(F.count("*").alias("size")).filter(F.col("size") > window + 1)
                   .withColumn("root", F.monotonically_increasing_id()), "long-runs")
    work = runs.agg(F.sum(F.col("size").cast("double") * F.col("size"))).first()[0]
    if work is None:
        return window_links(vectors, width, passes, window, cosine, seed)
    if work >= float(n) * n:
        every = vectors.select(F.lit(0).cast("long").alias("root"), F.lit(n).cast("long").alias("size"), "node", "x")
        return _links_within(every, width, cosine, block).distinct()
    members = keyed.withColumn("lead", lead).join(runs, ["pass", "lead"]).select("root", "size", "node", "x")
    return (window_links(vectors, width, passes, window, cosine, seed)
            .unionByName(_links_within(written(members, "run-members"), width, cosine, block)).distinct())


# ------------------------------------------------------------------ exact counts

def _count_within(width: int, cosine: float):
    """Rows (root, chunk, i, j, node, x, copies) of one group -> (node, links): partners'
    copies at the threshold, within chunk i, or between the chunks i and j, of each root."""
    def count(table):
        import pyarrow as pa
        root, chunk, node, copies = (table[c].to_numpy() for c in ("root", "chunk", "node", "copies"))
        i, j = table["i"].to_numpy(), table["j"].to_numpy()
        order = np.lexsort((node, chunk, root))
        root, chunk, node, copies, i, j = (z[order] for z in (root, chunk, node, copies, i, j))
        unit = _unit(_matrix(table["x"], width)[order])
        links = np.zeros(len(node), dtype=np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], root[1:] != root[:-1], [True])))
        for s, e in zip(cuts.tolist(), cuts[1:].tolist()):
            if i[s] == j[s]:
                near = unit[s:e] @ unit[s:e].T >= cosine
                np.fill_diagonal(near, False)
                links[s:e] = near @ copies[s:e]
            else:
                m = s + int(np.searchsorted(chunk[s:e], j[s]))
                near = unit[s:m] @ unit[m:e].T >= cosine
                links[s:m] = near @ copies[m:e]
                links[m:e] = near.T @ copies[s:m]
        return pa.table({"node": pa.array(node), "links": pa.array(links)})
    return count


def link_counts(members: DataFrame, width: int, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(node, links) for ``members`` (root, node, x, copies)."""
    sizes = members.groupBy("root").agg(F.count("*").alias("size"))
    sized = members.join(sizes, "root")
    n_small = sizes.filter(F.col("size") <= block).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = max(1, -(-n_small // block))
    small = (sized.filter(F.col("size") <= block)
             .select(F.pmod(F.xxhash64("root"), F.lit(buckets)).alias("g"), F.lit(0).alias("i"), F.lit(0).alias("j"),
                     F.lit(0).alias("chunk"), "root", "node", "x", "copies"))
    chunks = F.ceil(F.col("size") / block).cast("int")
    large = (sized.filter(F.col("size") > block).withColumn("chunks", chunks)
             .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select(F.col("root").alias("g"), F.least("chunk", "other").alias("i"),
                     F.greatest("chunk", "other").alias("j"), "chunk", "root", "node", "x", "copies"))
    count = _count_within(width, cosine)
    schema = "node long, links long"
    parts = [small.groupBy("g", "i", "j").applyInArrow(count, schema),
             large.groupBy("g", "i", "j").applyInArrow(count, schema)]
    return parts[0].unionByName(parts[1]).groupBy("node").agg(F.sum("links").alias("links"))


# ------------------------------------------------------------------ operator

def near_duplicate_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           cosine: float = COSINE, window: int = WINDOW, passes: int | None = None,
                           block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(id, n_links, component_id, kept) per row.

    Rows whose vector is null, zero or holds null or non-finite components link with
    nothing and are their own component.  Equal vectors and repeated rows are linked with
    one another (each other row counts); null ids are ignored when the smallest id of a
    component is taken, and are not kept.  A shorter vector counts as padded with zeros.
    An empty table gives no rows; extra columns play no part."""
    vectors = written(distinct_vectors(rows, id_col, vector_col), "distinct-vectors")
    totals = vectors.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    width = max(1, totals["width"] or 1)
    passes = passes or passes_for(totals["n"], cosine, window)
    labels = written(connected_components(all_links(vectors, totals["n"], width, passes, window, cosine, block,
                                                            seed)), "vector-roots")
    members = vectors.join(labels, "node").select("root", "node", "x", "copies", "least")
    members = written(members, "vector-members")
    links = link_counts(members, width, cosine, block)
    smallest = members.groupBy("root").agg(F.min("least").alias("smallest"))
    of_node = (members.select("node", "root").join(links, "node").join(smallest, "root")
               .select("node", "links", "smallest"))
    found = (vectors.join(of_node, "node", "left")
             .select("x", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
                     F.when(F.col("links").isNull(), F.col("least")).otherwise(F.col("smallest")).alias("component")))
    found = found.withColumnRenamed("x", "fx")
    base = rows.select(F.col(id_col).alias("id"), _column(rows, vector_col).alias("x"))
    joined = base.join(found, base["x"] == found["fx"], "left")
    component = F.when(F.col("fx").isNull(), F.col("id")).otherwise(F.col("component"))
    return joined.select("id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
