"""Sparse self-product S = Xᵀ X of a long table, by blocks (used by C1-C5).

X is given as rows (group g, member m, value x).  S[a, b] sums over the groups
holding both members.  A plain self-join on g would emit every pair of members
inside a group before aggregating, and shuffle them.  Here members are dealt to
blocks, and the rows of a group are kept together in the order of their blocks: block p
gets, from every group that has members in p, those members and the ones of later blocks.
Every pair of members has one task that meets it, the one of the earlier block, so the sums
are final there: thresholds apply at once and no pair is ever shuffled.  A group of k rows is
sent at most min(k, blocks) times, half of it on average, in 12 bytes a row.  Members of very
many groups come last, each in a block of its own: they own only pairs with even more frequent
ones.

A product of very many pairs is made in passes over the groups, each for some of the blocks:
its sums (after the threshold) are written and the shuffle files of the pass removed, so that
the disks hold one pass at a time.  Where only some pairs are asked for (``wanted``), these go to
the tasks of their pairs and come back with their sums; no other pair leaves its task.

A group too heavy for one row (a user with a large share of all rows) is computed apart:
its rows are sent to the tasks (p, q), p <= q, of their member blocks and the partial sums are
added by one more aggregation.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import block_of
from ..session import cut_lineage, delete_path, scratch_path, ship_package, shuffles_removed

BLOCK_PAIRS = 2_000_000        # pairs a block meets on average
PASS_PAIRS = 300_000_000       # pairs met in one pass (12 bytes sent for each, at most)
HOT_SHARE = 1000               # members with more than 1/HOT_SHARE of all rows come last
HOT_ROWS = 10_000              # unless they have fewer rows than this
SENT_ROWS = 1_000_000          # rows of groups written at once by a mapping task
DENSE_MAX = 16_000_000         # dense accumulators up to 4000² cells (128 MB each), sparse beyond
ROWS_PER_TASK = 2_000_000      # rows of X that one task may hold
PAIR_CHUNK = 4_000_000         # pairs materialised at once inside a task
MERGE_CODES = 16_000_000       # partial sums that may wait to be merged

_OUT = "a long, b long, xy double, xx double, yy double, n long"


def _accumulate(gl, ml, xl, gr, mr, xr, n_right):
    """Yield (codes, xy, xx, yy) for all pairs (l, r) with equal group, chunked."""
    start = np.searchsorted(gr, gl, "left")
    cnt = np.searchsorted(gr, gl, "right") - start
    csum = np.cumsum(cnt)
    total = int(csum[-1]) if len(csum) else 0
    done = 0
    lo = 0
    while done < total:
        hi = int(np.searchsorted(csum, done + PAIR_CHUNK, "right"))
        hi = max(hi, lo + 1)
        c = cnt[lo:hi]
        n_pairs = int(c.sum())
        li = np.repeat(np.arange(lo, hi), c)
        first = np.repeat(np.cumsum(c) - c, c)
        ri = start[li] + (np.arange(n_pairs) - first)
        a, b = xl[li], xr[ri]
        yield ml[li] * n_right + mr[ri], a * b, a * a, b * b
        done += n_pairs
        lo = hi


def _merged(parts):
    codes, inv = np.unique(np.concatenate([t[0] for t in parts]), return_inverse=True)
    return (codes, *[np.bincount(inv, np.concatenate([t[k] for t in parts])) for k in range(1, 5)])


def _block_task(pdf: pd.DataFrame, min_xy: float | None, min_n: int | None, squares: bool) -> pd.DataFrame:
    p, q = int(pdf["p"].iat[0]), int(pdf["q"].iat[0])
    left = pdf[pdf["mb"] == p].sort_values("g", kind="stable")
    right = left if p == q else pdf[pdf["mb"] == q].sort_values("g", kind="stable")
    ua, ia = np.unique(left["m"].to_numpy(), return_inverse=True)
    ub, ib = np.unique(right["m"].to_numpy(), return_inverse=True)
    nl, nr = len(ua), len(ub)
    gl, xl = left["g"].to_numpy(), left["x"].to_numpy(dtype=np.float64)
    gr, xr = right["g"].to_numpy(), right["x"].to_numpy(dtype=np.float64)
    size = nl * nr
    dense = size <= DENSE_MAX
    if dense:
        zero = np.zeros(0)
        acc = [np.zeros(size), np.zeros(size) if squares else zero,
               np.zeros(size) if squares else zero, np.zeros(size)]
    parts, pending = [], 0
    for codes, xy, xx, yy in _accumulate(gl, ia, xl, gr, ib, xr, nr):
        if dense:
            acc[0] += np.bincount(codes, xy, size)
            if squares:
                acc[1] += np.bincount(codes, xx, size)
                acc[2] += np.bincount(codes, yy, size)
            acc[3] += np.bincount(codes, None, size)
        else:
            u, inv = np.unique(codes, return_inverse=True)
            parts.append((u, np.bincount(inv, xy), np.bincount(inv, xx), np.bincount(inv, yy),
                          np.bincount(inv).astype(np.float64)))
            pending += len(u)
            if pending > MERGE_CODES and len(parts) > 1:        # merged as they come, not at the end
                parts = [_merged(parts)]
                pending = 0
    if dense:
        codes = np.nonzero(acc[3])[0]
        vals = [v[codes] if len(v) else np.zeros(len(codes)) for v in acc]
    elif parts:
        codes, *vals = _merged(parts)
    else:
        codes, vals = np.zeros(0, dtype=np.int64), [np.zeros(0)] * 4
    keep = np.ones(len(codes), dtype=bool)
    if min_xy is not None:
        keep &= vals[0] > min_xy
    if min_n is not None:
        keep &= vals[3] >= min_n
    codes, vals = codes[keep], [v[keep] for v in vals]
    a, b = ua[codes // nr], ub[codes % nr]
    out = pd.DataFrame({"a": a, "b": b, "xy": vals[0], "xx": vals[1], "yy": vals[2],
                        "n": vals[3].astype(np.int64)})
    if p != q:
        mirror = pd.DataFrame({"a": b, "b": a, "xy": vals[0], "xx": vals[2], "yy": vals[1],
                               "n": vals[3].astype(np.int64)})
        out = pd.concat([out, mirror], ignore_index=True)
    return out


_SENT = "p int, own int, members binary, x binary"
_NONE = np.iinfo(np.int64).min  # a null member


def _block_numbers(m: np.ndarray, blocks: int, hot: np.ndarray) -> np.ndarray:
    """Block of each member: by hash; the frequent ones behind the others, in their order."""
    mixed = (m.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    p = (mixed % np.uint64(blocks)).astype(np.int64)
    if len(hot):
        order = np.argsort(hot, kind="stable")
        at = np.minimum(np.searchsorted(hot[order], m), len(hot) - 1)
        p = np.where(hot[order][at] == m, blocks + order[at], p)
    return p


def _ranges(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The integers of all ranges, one after the other."""
    n = stops - starts
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _slices(sizes: np.ndarray, most: int):
    """(lo, hi) cuts of ``sizes`` into runs of a sum of at most ``most`` (one larger: alone)."""
    csum = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        done = int(csum[lo - 1]) if lo else 0
        hi = max(int(np.searchsorted(csum, done + most, "right")), lo + 1)
        yield lo, hi
        lo = hi


def _send(blocks: int, hot: np.ndarray, at_pass: int = 0, passes: int = 1):
    """Groups (member and value lists) -> one row per group and block of the pass it has members in."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            lists = batch.column(0)
            offsets = lists.offsets.to_numpy()
            cells = lists.flatten()
            m = cells.field(0).fill_null(int(_NONE)).to_numpy(zero_copy_only=False)
            x = cells.field(1).fill_null(float("nan")).to_numpy(zero_copy_only=False)
            offsets = offsets - offsets[0]
            group = np.repeat(np.arange(len(lists)), np.diff(offsets))
            p = _block_numbers(m, blocks, hot)
            order = np.lexsort((m, p, group))
            m, x, p = m[order], x[order], p[order]
            first = np.flatnonzero(np.diff(group * np.int64(blocks + len(hot)) + p, prepend=-1))
            own = np.diff(first, append=len(m))
            stop = offsets[1:][group[first]]
            if passes > 1:
                mine = p[first] % passes == at_pass
                first, own, stop = first[mine], own[mine], stop[mine]
            narrow = len(m) and m.min() >= -2 ** 31 and m.max() < 2 ** 31
            m = m.astype("<i4" if narrow else "<i8")
            for lo, hi in _slices(stop - first, SENT_ROWS):
                at = list(zip(first[lo:hi].tolist(), stop[lo:hi].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p[first[lo:hi]].astype(np.int32)), pa.array(own[lo:hi].astype(np.int32)),
                     pa.array([m[i:j].tobytes() for i, j in at], pa.binary()),
                     pa.array([x[i:j].tobytes() for i, j in at], pa.binary())], names=["p", "own", "members", "x"])
    return run


def _summed(codes, columns):
    """Distinct codes and their sums; a column that is None counts."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], [np.diff(first, append=len(codes)).astype(np.float64) if c is None
                          else np.add.reduceat(c[order], first) if len(first) else c[:0] for c in columns]


def _pair_sums(table, min_xy: float | None, min_n: int | None, squares: bool):
    """(ids, codes, sums) of all pairs that a block owns: a pair's code is that of its first and
    second member in the order of the blocks, places in ``ids``; the sums are final."""
    members, values = table["members"].to_pylist(), table["x"].to_pylist()
    x = np.frombuffer(b"".join(values), np.float64)
    sizes = np.array([len(v) // 8 for v in values])
    m = np.concatenate([np.frombuffer(b, "<i4" if 2 * len(b) == len(v) else "<i8") for b, v in zip(members, values)])
    ends = np.cumsum(sizes)
    own = table["own"].to_numpy()
    left = _ranges(ends - sizes, ends - sizes + own)
    stop = np.repeat(ends, own)
    ids, at = np.unique(m, return_inverse=True)
    n_ids = np.int64(len(ids))
    parts, pending = [], 0
    for lo, hi in _slices(stop - left, PAIR_CHUNK):
        li = np.repeat(left[lo:hi], stop[lo:hi] - left[lo:hi])
        ri = _ranges(left[lo:hi], stop[lo:hi])
        a, b = x[li], x[ri]
        codes, sums = _summed(at[li] * n_ids + at[ri], [a * b, *((a * a, b * b) if squares else ()), None])
        parts.append((codes, sums))
        pending += len(codes)
        if pending > MERGE_CODES and len(parts) > 1:
            parts, pending = [_joined(parts)], 0
    codes, sums = _joined(parts)
    keep = np.ones(len(codes), dtype=bool)
    if min_xy is not None:
        keep &= sums[0] > min_xy
    if min_n is not None:
        keep &= sums[-1] >= min_n
    return ids, codes[keep], [v[keep] for v in sums]


def _own_pairs(min_xy: float | None, min_n: int | None, squares: bool):
    """All pairs that a block owns, with their final sums."""
    def run(table):
        import pyarrow as pa
        ids, codes, sums = _pair_sums(table, min_xy, min_n, squares)
        n_ids = np.int64(len(ids))
        a, b = ids[codes // n_ids].astype(np.int64), ids[codes % n_ids].astype(np.int64)
        xy, n = sums[0], sums[-1].astype(np.int64)
        xx, yy = sums[1:3] if squares else (np.zeros(len(xy)), np.zeros(len(xy)))
        off = a != b

        def both(one, other):
            return np.concatenate([one, other[off]])

        def ids_of(v):
            return pa.array(v, mask=v == _NONE)
        return pa.table({"a": ids_of(both(a, b)), "b": ids_of(both(b, a)),
                         **{k: pa.array(v, from_pandas=True) for k, v in
                            (("xy", both(xy, xy)), ("xx", both(xx, yy)), ("yy", both(yy, xx)))}, "n": both(n, n)})
    return run


def _owners(blocks: int, hot: np.ndarray, passes: int):
    """Rows (a, b, ...) -> the same with the block ``p`` that owns the pair, its pass, and whether
    b comes first in the order of the blocks."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            pa_, pb = _block_numbers(a, blocks, hot), _block_numbers(b, blocks, hot)
            p = np.minimum(pa_, pb)
            turned = (pb < pa_) | ((pb == pa_) & (b < a))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p.astype(np.int32)), pa.array((p % passes).astype(np.int32)), pa.array(turned)],
                names=[*batch.schema.names, "p", "_pass", "_turned"])
    return run


def _wanted_sums(names: list[str], min_xy: float | None):
    """The wanted rows of a block whose pair it has met (and kept), with the pair's xy."""
    def run(table, wanted):
        import pyarrow as pa
        none = wanted.select(names).slice(0, 0).append_column("xy", pa.array([], pa.float64()))
        if not table.num_rows or not wanted.num_rows:
            return none
        ids, codes, sums = _pair_sums(table, min_xy, None, False)
        if not len(codes):
            return none
        a, b, turned = (wanted[c].to_numpy() for c in ("a", "b", "_turned"))
        one, two = np.where(turned, b, a), np.where(turned, a, b)
        at = [np.minimum(np.searchsorted(ids, v), len(ids) - 1) for v in (one, two)]
        code = at[0] * np.int64(len(ids)) + at[1]
        pos = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        hit = np.flatnonzero((ids[at[0]] == one) & (ids[at[1]] == two) & (codes[pos] == code))
        return wanted.select(names).take(pa.array(hit)).append_column("xy", pa.array(sums[0][pos[hit]], from_pandas=True))
    return run


def _joined(parts):
    """Parts of (codes, sums) added up."""
    if len(parts) == 1:
        return parts[0]
    return _summed(np.concatenate([c for c, _ in parts]), [np.concatenate(v) for v in zip(*[s for _, s in parts])])


def _by_owner(rows: DataFrame, blocks: int, hot: np.ndarray, passes: int, min_xy, min_n, squares: bool,
              wanted: DataFrame | None = None) -> DataFrame:
    """The product of groups that each fit a row: every sum is final in the task of its pair."""
    spark = rows.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, math.ceil(blocks / passes / 2))
    groups = rows.groupBy("g").agg(F.collect_list(F.struct("m", "x")).alias("cells")).select("cells")
    schema = _OUT
    if wanted is not None:
        names, types = wanted.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields)
        schema = f"{types}, xy double"
        wanted = (wanted.where(F.col("a").isNotNull() & F.col("b").isNotNull())
                  .mapInArrow(_owners(blocks, hot, passes), f"{types}, p int, _pass int, _turned boolean"))

    def product(at_pass: int) -> DataFrame:
        sent = groups.mapInArrow(_send(blocks, hot, at_pass, passes), _SENT).repartition(parts, "p")
        if wanted is None:
            return sent.groupBy("p").applyInArrow(_own_pairs(min_xy, min_n, squares), _OUT)
        asked = wanted.where(F.col("_pass") == at_pass).drop("_pass").repartition(parts, "p")
        return sent.groupBy("p").cogroup(asked.groupBy("p")).applyInArrow(_wanted_sums(names, min_xy), schema)

    inputs = []
    with shuffles_removed(spark):
        if wanted is not None:            # written, so that the shuffles of its join go
            inputs.append(scratch_path(spark, "wanted"))
            wanted.write.partitionBy("_pass").parquet(inputs[0])
            wanted = spark.read.schema(wanted.schema).parquet(inputs[0])
        if passes == 1:
            return product(0)
        inputs.append(scratch_path(spark, "groups"))
        groups.write.parquet(inputs[-1])
        groups = spark.read.schema(groups.schema).parquet(inputs[-1])
        path = scratch_path(spark, "pairs")
        for at_pass in range(passes):
            product(at_pass).write.mode("append").parquet(path)
    for each in inputs:
        delete_path(spark, each)
    return spark.read.schema(schema).parquet(path)


def _blocked(rows: DataFrame, B: int, C: int, min_xy, min_n, squares: bool, final_in_task: bool) -> DataFrame:
    rows = rows.withColumn("mb", block_of("m", B)).withColumn("gb", block_of("g", C) if C > 1 else F.lit(0))
    rep = rows.select("g", "m", "x", "mb", "gb", F.explode(F.sequence(F.lit(0), F.lit(B - 1))).alias("o"))
    rep = rep.select("g", "m", "x", "mb", "gb", F.least("mb", "o").alias("p"), F.greatest("mb", "o").alias("q"))

    def task(pdf: pd.DataFrame) -> pd.DataFrame:
        return _block_task(pdf, *((min_xy, min_n) if final_in_task else (None, None)), squares)

    return rep.groupBy("gb", "p", "q").applyInPandas(task, _OUT)


def self_product(x: DataFrame, group: str, member: str, value: str,
                 min_xy: float | None = None, squares: bool = False, min_n: int | None = None,
                 member_blocks: int | None = None, group_blocks: int | None = None,
                 wanted: DataFrame | None = None, n_wanted: int = 0) -> DataFrame:
    """All member pairs (a, b) co-occurring in some group, both orders and the
    diagonal, with xy = Σ x_a x_b, xx = Σ x_a², yy = Σ x_b² (over common groups)
    and n = number of common groups (xx, yy only with ``squares``).  ``min_xy``
    drops pairs with xy <= min_xy and ``min_n`` those with fewer common groups (inside the
    tasks when the sums are final there).  ``wanted`` (a, b, ..., about ``n_wanted``
    rows) asks for some pairs only: its rows come back with xy, those whose pair is missing or
    dropped do not.

    Sizing: as many member blocks as give each BLOCK_PAIRS pairs.  Groups above a quarter of
    ROWS_PER_TASK rows (one user with a large share of all rows) are computed apart by pairs of
    member blocks; the two partial results are added by one aggregation.  ``member_blocks`` and
    ``group_blocks`` compute everything by pairs of that many blocks."""
    spark = x.sparkSession
    ship_package(spark)
    rows = x.select(F.col(group).alias("g"), F.col(member).cast("long").alias("m"),
                    F.col(value).cast("double").alias("x"))
    par = spark.sparkContext.defaultParallelism
    if member_blocks is not None and group_blocks is not None:
        return _finish(_blocked(rows, member_blocks, group_blocks, min_xy, min_n, squares, group_blocks == 1),
                       group_blocks == 1, min_xy, min_n)
    rows = cut_lineage(rows)          # sized by two small actions, then read once more
    per_group = rows.groupBy("g").agg(F.count(F.lit(1)).alias("c"))
    heavy = F.col("c") > ROWS_PER_TASK // 4
    st = per_group.agg(F.sum("c").alias("n"), F.max("c").alias("big"), F.count(F.when(heavy, 1)).alias("heavy"),
                       F.sum(F.when(~heavy, F.col("c") * (F.col("c") + 1) / 2)).alias("pairs")).first()
    frequent = max(HOT_ROWS, (st["n"] or 0) // HOT_SHARE)
    hot = np.array([r["m"] for r in rows.groupBy("m").agg(F.count(F.lit(1)).alias("c"))       # at most HOT_SHARE members
                    .where((F.col("c") > frequent) & F.col("m").isNotNull()).orderBy("c", "m").collect()], dtype=np.int64)
    met = max(st["pairs"] or 0, n_wanted)
    blocks = max(2 * par, math.ceil(met / BLOCK_PAIRS))
    passes = max(1, math.ceil(met / PASS_PAIRS))
    if not st["heavy"]:
        return _by_owner(rows, blocks, hot, passes, min_xy, min_n, squares, wanted)
    marked = rows.join(per_group.where(heavy).select("g", F.lit(True).alias("_h")), "g", "left")
    bh = max(2, math.ceil(2 * st["big"] / ROWS_PER_TASK))     # a heavy group's rows split by member blocks
    parts = _by_owner(marked.where(F.col("_h").isNull()).drop("_h"), blocks, hot, passes, None, None, squares).unionByName(
        _blocked(marked.where(F.col("_h")).drop("_h"), bh, st["heavy"], None, None, squares, False))
    out = _finish(parts, False, min_xy, min_n)
    return out if wanted is None else wanted.join(out.select("a", "b", "xy"), ["a", "b"])


def _finish(out: DataFrame, final_in_task: bool, min_xy, min_n) -> DataFrame:
    if final_in_task:
        return out
    out = out.groupBy("a", "b").agg(F.sum("xy").alias("xy"), F.sum("xx").alias("xx"),
                                    F.sum("yy").alias("yy"), F.sum("n").alias("n"))
    if min_n is not None:
        out = out.where(F.col("n") >= min_n)
    return out.where(F.col("xy") > min_xy) if min_xy is not None else out
