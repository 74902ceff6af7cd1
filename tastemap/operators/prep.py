"""Table preparation: indexing, demeaning, normalising, splits, samples."""

from __future__ import annotations

import hashlib
import math
from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import md5_draw
from ..session import cut_lineage, ship_package


# ---------------------------------------------------------------- ingest / T1

def normalize_ratings(df: DataFrame, user: str = "user", item: str = "item",
                      rating: str | None = "rating", zero_is_missing: bool = True) -> DataFrame:
    """Rename/cast to (user long, item long, rating double).  No rating column =
    implicit data (rating 1.0).  A rating of 0 means "not rated" (dropped)."""
    r = F.col(rating).cast("double") if rating else F.lit(1.0)
    out = df.select(F.col(user).cast("long").alias("user"), F.col(item).cast("long").alias("item"),
                    r.alias("rating"))
    if zero_is_missing:
        out = out.where(F.col("rating") != 0)
    return out


def sum_duplicates(ratings: DataFrame) -> DataFrame:
    """Duplicate (user, item) rows are summed, as a sparse COO->CSR build does."""
    return ratings.groupBy("user", "item").agg(F.sum("rating").alias("rating"))


def row_positions(df: DataFrame, order_cols: list[str], pos_col: str = "pos") -> DataFrame:
    """0-based position of every row in the total order ``order_cols`` (must be a key).

    Range-partition + sort within partitions, then add per-partition offsets from a
    table with one row per partition (bounded by the partition count).  The tagged
    table is checkpointed so that counts and offsets see the same layout."""
    ordered = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    tagged = ordered.select("*", F.spark_partition_id().alias("_pid"),
                            F.monotonically_increasing_id().alias("_mid"))
    tagged = cut_lineage(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(pos_col, (F.col("_off") + local).cast("long"))
            .drop("_pid", "_mid", "_off"))


def dense_index(df: DataFrame, col: str, pos_col: str | None = None) -> DataFrame:
    """Sorted distinct ids with contiguous 0-based positions: (col, pos_col)."""
    return row_positions(df.select(col).distinct(), [col], pos_col or f"{col}_pos")


def index_ratings(ratings: DataFrame, users: DataFrame | None = None,
                  items: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Summed ratings with user/item positions; supplied indexes must cover the data."""
    summed = sum_duplicates(ratings)
    if users is None:
        users = dense_index(summed, "user")
    else:
        assert_covers(summed, users, "user")
    if items is None:
        items = dense_index(summed, "item")
    else:
        assert_covers(summed, items, "item")
    return summed.join(users, "user").join(items, "item"), users, items


# ---------------------------------------------------------------- T2, T3

def uncovered_ids(data: DataFrame, index: DataFrame, col: str) -> DataFrame:
    """Ids present in the data but absent from the supplied index."""
    return data.select(col).distinct().join(index.select(col), col, "left_anti")


def assert_covers(data: DataFrame, index: DataFrame, col: str) -> None:
    if uncovered_ids(data, index, col).limit(1).count() > 0:
        raise ValueError(f"some {col} ids of the data are not in the given index")


def sparsity(ratings: DataFrame) -> DataFrame:
    """1 - nnz / (m * n) on distinct cells."""
    cells = ratings.select("user", "item").distinct()
    return cells.agg(
        F.count(F.lit(1)).alias("nnz"),
        F.countDistinct("user").alias("n_users"),
        F.countDistinct("item").alias("n_items"),
    ).select("nnz", "n_users", "n_items",
             (F.lit(1.0) - F.col("nnz") / (F.col("n_users") * F.col("n_items"))).alias("sparsity"))


# ---------------------------------------------------------------- T4, T5

def demean(df: DataFrame, by: str, value: str = "rating", damping: float = 0.0,
           mean_col: str = "mean") -> DataFrame:
    """Per-group damped mean sum/(damping+n), subtracted from present cells."""
    means = df.groupBy(by).agg((F.sum(value) / (F.lit(float(damping)) + F.count(F.lit(1)))).alias(mean_col))
    return df.join(means, by).withColumn(value, F.col(value) - F.col(mean_col))


def l2_normalize(df: DataFrame, by: str, value: str = "rating", norm_col: str = "norm") -> DataFrame:
    """Per-group L2 normalisation; zero-norm groups keep their values and norm 1."""
    norms = df.groupBy(by).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("_n"))
    norms = norms.select(by, F.when(F.col("_n") > 0, F.col("_n")).otherwise(F.lit(1.0)).alias(norm_col))
    return df.join(norms, by).withColumn(value, F.col(value) / F.col(norm_col))


# ---------------------------------------------------------------- T6, T7

def _draw(seed: int) -> Column:
    return md5_draw(F.col("user"), F.col("item"), F.lit(seed))


BROADCAST_ITEMS = 200_000      # an index of at most so many items is broadcast, a larger one shuffled
GROUP_ROWS = 1_000_000   # groups above this size are selected by histograms, not one window


def smallest_k_per_group(df: DataFrame, group: list[str], key: str, k_of, tie: list[str],
                         row_key: list[str], key_bits: int = 32, limit: int = GROUP_ROWS,
                         flag: str = "is_selected", max_group_rows: int | None = None) -> DataFrame:
    """Mark the k smallest rows of every group in the order (key, *tie); ``key`` is a
    non-negative integer below 2**key_bits, ``k_of(n)`` gives k from the group
    size column n, ``row_key`` identifies a row.  When no group exceeds ``limit``
    rows (``max_group_rows`` if the caller knows a bound, else one aggregation)
    a window per group does it.  Otherwise light groups keep the window and hot
    groups never meet in one task: 16-bit histograms of the key, one level after
    another, find each group's boundary bucket with a window over at most 65,536
    histogram rows, and only rows tied on the exact boundary key are ranked
    together."""
    w = Window.partitionBy(*group).orderBy(key, *tie)
    if max_group_rows is None:
        max_group_rows = df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    if max_group_rows <= limit:
        n = F.count(F.lit(1)).over(Window.partitionBy(*group))
        return df.withColumn(flag, F.row_number().over(w) <= k_of(n))
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_gn"))
    d = df.join(counts, group).withColumn("_k", F.least(k_of(F.col("_gn")).cast("long"), F.col("_gn")))
    light = d.where(F.col("_gn") <= limit).withColumn(flag, F.row_number().over(w) <= F.col("_k"))
    heavy = d.where((F.col("_gn") > limit) & (F.col("_k") > 0))
    levels = max(1, -(-key_bits // 16))
    cur = heavy.withColumn("_need", F.col("_k"))
    picked = []
    for lvl in range(levels):
        shift = 16 * (levels - 1 - lvl)
        cur = cur.withColumn("_b", F.shiftright(F.col(key), shift).bitwiseAND(F.lit(0xFFFF)))
        hist = cur.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_c"), F.first("_need").alias("_need"))
        wc = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("_cum", F.sum("_c").over(wc))
        bound = (hist.where(F.col("_cum") >= F.col("_need"))
                 .groupBy(*group).agg(F.min(F.struct("_b", "_cum", "_c")).alias("_m"))
                 .select(*group, F.col("_m._b").alias("_bs"), (F.col("_m._cum") - F.col("_m._c")).alias("_before")))
        cur = cur.join(bound, group)
        picked.append(cur.where(F.col("_b") < F.col("_bs")).select(*row_key))
        cur = (cur.where(F.col("_b") == F.col("_bs"))
               .withColumn("_need", F.col("_need") - F.col("_before")).drop("_b", "_bs", "_before"))
    wt = Window.partitionBy(*group, key).orderBy(*tie)
    picked.append(cur.withColumn("_rt", F.row_number().over(wt)).where(F.col("_rt") <= F.col("_need"))
                  .select(*row_key))
    sel = picked[0]
    for p_ in picked[1:]:
        sel = sel.unionByName(p_)
    heavy_all = d.where(F.col("_gn") > limit)
    heavy_all = heavy_all.join(sel.withColumn("_hit", F.lit(True)), row_key, "left").withColumn(
        flag, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")
    return light.unionByName(heavy_all).drop("_gn", "_k")


def split_per_group(ratings: DataFrame, frac: float = 0.1, group: str = "user",
                    seed: int = 1, limit: int = GROUP_ROWS) -> DataFrame:
    """Per group, the round-half-even(frac * n) rows with the smallest md5 draw
    (ties by user, item) are test.  Returns the input with an ``is_test`` column.
    Hot groups are split (see ``smallest_k_per_group``)."""
    d = ratings.withColumn("_h", _draw(seed))
    out = smallest_k_per_group(d, [group], "_h", lambda n: F.bround(F.lit(frac) * n, 0),
                               ["user", "item"], ["user", "item"], 32, limit, "is_test")
    return out.drop("_h")


def train_test(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (split.where(~F.col("is_test")).drop("is_test"),
            split.where(F.col("is_test")).drop("is_test"))


def split_global(ratings: DataFrame, frac: float = 0.1, seed: int = 1) -> DataFrame:
    """T7 exact: the round-half-even(frac * N) rows with the smallest (draw, user, item).

    No global sort: a 16-bit histogram of the draw finds the boundary bucket, a
    histogram of the exact draw inside it finds the boundary value; both collected
    tables have at most 65,536 rows.  Returns the input with ``is_test``."""
    h = _draw(seed)
    d = ratings.withColumn("_h", h)
    n = d.count()
    k = int(round(frac * n))  # Python round = half to even, as pandas sample
    if k <= 0:
        return d.withColumn("is_test", F.lit(False)).drop("_h")
    if k >= n:
        return d.withColumn("is_test", F.lit(True)).drop("_h")
    hist = sorted(d.groupBy(F.shiftright("_h", 16).alias("b")).count().collect())
    cum = 0
    for b, c in hist:
        if cum + c >= k:
            bstar, need = b, k - cum
            break
        cum += c
    inner = sorted(d.where(F.shiftright("_h", 16) == bstar).groupBy("_h").count().collect())
    cum = 0
    for hv, c in inner:
        if cum + c >= need:
            hstar, need2 = hv, need - cum
            break
        cum += c
    # only the rows with the boundary draw (about one in 2^32) are ranked
    w = Window.partitionBy("_h").orderBy("user", "item")
    ties = (d.where(F.col("_h") == hstar).withColumn("_tr", F.row_number().over(w))
            .withColumn("is_test", F.col("_tr") <= need2).drop("_tr"))
    rest = d.where(F.col("_h") != hstar).withColumn("is_test", F.col("_h") < hstar)
    return rest.unionByName(ties).drop("_h")


def split_bernoulli(ratings: DataFrame, pivot: float = 0.8, seed: int = 1) -> DataFrame:
    """T7 Bernoulli: a row is train when its draw in [0,1) is below ``pivot``."""
    from ..functions.expr import unit_draw
    return ratings.withColumn("is_test", ~(unit_draw(F.col("user"), F.col("item"), F.lit(seed)) < F.lit(pivot)))


# ---------------------------------------------------------------- T8, T9

def slice_rows(ratings: DataFrame, col: str, value) -> DataFrame:
    """One user's row or one item's column (predicate pushed to the scan)."""
    return ratings.where(F.col(col) == F.lit(value))


def align_scores(pairs: DataFrame, scores: DataFrame, score_col: str = "score") -> DataFrame:
    """Every requested (user, item) keeps its row; unknown ones get NULL."""
    return pairs.select("user", "item").join(scores.select("user", "item", score_col), ["user", "item"], "left")


# ---------------------------------------------------------------- T12

def minibatch_ids(df: DataFrame, order_cols: list[str], batch_size: int = -1,
                  pos_col: str | None = None) -> DataFrame:
    """Consecutive chunks of ``batch_size`` rows in a stable order; -1 = one batch.
    ``pos_col`` keeps the row's position in the order."""
    if batch_size != -1 and batch_size < 1:
        raise ValueError(f"cannot cut batches of {batch_size} rows: give a size from 1, or -1 for one batch")
    if batch_size == -1 and pos_col is None:
        return df.withColumn("batch_id", F.lit(0).cast("long"))
    pos = row_positions(df, order_cols, pos_col or "_pos")
    batch = F.lit(0) if batch_size == -1 else F.floor(F.col(pos_col or "_pos") / batch_size)
    out = pos.withColumn("batch_id", batch.cast("long"))
    return out if pos_col else out.drop("_pos")


# ---------------------------------------------------------------- T13

@dataclass
class SamplingTables:
    index: DataFrame        # (item, item_pos)
    n_items: int
    per_user: DataFrame     # (user, n)
    most: int               # largest n
    total: int = 0          # sum of all n


def sampling_tables(pos: DataFrame, items: DataFrame | None = None) -> SamplingTables:
    """What negative sampling needs beside the positives; make it once for many draws."""
    if items is None:
        items = pos.select("item").distinct()
    idx = dense_index(items.select("item"), "item", "item_pos")
    per_user = cut_lineage(pos.groupBy("user").agg(F.count(F.lit(1)).alias("n")))
    n = per_user.agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    return SamplingTables(idx, (idx.agg(F.max("item_pos")).first()[0] or 0) + 1, per_user, n["most"] or 0, n["total"] or 0)


def negative_samples(ratings: DataFrame, items: DataFrame | None = None, seed: int = 1,
                     draws_per_positive: int = 5, ratio: float = 1.0, limit: int = GROUP_ROWS,
                     tables: SamplingTables | None = None, seeds: dict[int, int] | None = None) -> DataFrame:
    """Per user, 5·n uniform item draws (md5 of user:draw:seed modulo the item
    count), known items skipped, first occurrence kept, at most ratio·n negatives.
    Returns positives (label 1) and negatives (label 0).  ``seeds`` (epoch -> seed) draws the
    samples of several epochs in one pass, told apart by a column ``epoch``."""
    pos = ratings.select("user", "item").distinct()
    t = tables or sampling_tables(pos, items)
    every = seeds or {0: seed}
    epochs = F.explode(F.array(*[F.lit(int(e)) for e in every]))
    # the side to send is named: the optimizer knows the size of the ranges before they are generated, not after
    index = F.broadcast(t.index) if t.n_items <= BROADCAST_ITEMS else t.index.hint("merge")
    own, drawn = pos, None
    if t.most > limit:
        hot = t.per_user.where((F.col("n") > limit) & F.col("user").isNotNull())
        own = pos.join(F.broadcast(hot.select("user")), "user", "left_anti")
        drawn = _drawn_apart(pos, hot, index, t, every, epochs, draws_per_positive, ratio, limit)
    chosen = _first_draws(own, index, t, every, draws_per_positive, ratio)
    neg = chosen.join(index, "item_pos").select("epoch", "user", "item")
    neg = (neg if drawn is None else neg.unionByName(drawn)).withColumn("label", F.lit(0))
    out = pos.select(epochs.alias("epoch"), "user", "item", F.lit(1).alias("label")).unionByName(neg)
    return out if seeds else out.drop("epoch")


def _first_draws(pos: DataFrame, index: DataFrame, t: SamplingTables, every: dict[int, int], draws_per_positive: int,
                 ratio: float) -> DataFrame:
    """(epoch, user, item_pos) of the negatives of users that fit a task: the draws of a user are
    made one after the other until there are enough, most are never made."""
    spark = pos.sparkSession
    ship_package(spark)
    n_items = t.n_items
    rows = pos.join(index, "item", "left").select("user", F.col("user").cast("string").alias("id"), "item_pos")
    parts = max(4 * spark.sparkContext.defaultParallelism, -(-len(every) * t.total // ROWS_PER_PARTITION))

    def draw(table):
        import pyarrow as pa
        table = table.sort_by("id")
        ids, at = table["id"].to_pylist(), table["item_pos"].fill_null(-1).to_numpy()
        first = [n for n in range(len(ids)) if not n or ids[n] != ids[n - 1]]
        outs = array("i"), array("q"), array("q")              # epoch, row of the user, item_pos
        for lo, hi in zip(first, [*first[1:], len(ids)]):
            known = set(at[lo:hi].tolist()) if ids[lo] is not None else set()      # as the draws and joins take a null user
            n, start = hi - lo, b"" if ids[lo] is None else f"{ids[lo]}:".encode()
            for epoch, seed in every.items():
                got = _distinct_draws(start, f":{seed}".encode(), n * draws_per_positive, math.floor(n * ratio), n_items, known)
                outs[0].extend([epoch] * len(got))
                outs[1].extend([lo] * len(got))
                outs[2].extend(got)
        epoch, at, drawn = (np.frombuffer(v, t) for v, t in zip(outs, (np.int32, np.int64, np.int64)))
        return pa.table({"epoch": epoch, "user": table["user"].take(pa.array(at)), "item_pos": drawn})

    user = pos.schema["user"].dataType.simpleString()
    return (rows.withColumn("_part", F.pmod(F.xxhash64("user"), F.lit(parts))).repartition(parts, "_part").groupBy("_part")
            .applyInArrow(lambda table: draw(table.drop_columns(["_part"])), f"epoch int, user {user}, item_pos long"))


def _distinct_draws(start: bytes, end: bytes, draws: int, k: int, n_items: int, known: set) -> list[int]:
    """The first k distinct positions outside ``known`` among the draws 1, 2, ... ``draws``: draw
    d is ``md5_draw`` of (user, d, seed), modulo ``n_items``."""
    got: dict[int, None] = {}
    md5 = hashlib.md5
    for d in range(1, draws + 1):
        if len(got) >= k:
            break
        at = int.from_bytes(md5(b"%b%d%b" % (start, d, end)).digest()[:4], "big") % n_items
        if at not in known:
            got[at] = None
    return list(got)


def _drawn_apart(pos: DataFrame, hot: DataFrame, index: DataFrame, t: SamplingTables, every: dict[int, int], epochs: Column,
                 draws_per_positive: int, ratio: float, limit: int) -> DataFrame:
    """(epoch, user, item) of the negatives of users with more rows than a task shall hold: all
    draws are rows, dealt over the tasks."""
    own = F.create_map(*[F.lit(int(x)) for e in every.items() for x in e])
    users = hot.select("user", "n", epochs.alias("epoch"))
    draws = explode_range(users, ["user", "epoch"], F.lit(1), F.col("n") * draws_per_positive, "d")
    draw = md5_draw(F.col("user"), F.col("d"), F.element_at(own, F.col("epoch")))
    cand = (draws.withColumn("item_pos", F.pmod(draw, F.lit(t.n_items))).join(index, "item_pos")
            .join(pos, ["user", "item"], "left_anti"))
    first = cand.groupBy("epoch", "user", "item").agg(F.min("d").alias("d"), F.first("n").alias("n"))
    first = first.withColumn("d", F.col("d").cast("long"))
    sel = smallest_k_per_group(first, ["epoch", "user"], "d", lambda _n: F.floor(F.col("n") * F.lit(ratio)),
                               ["item"], ["epoch", "user", "item"], 48, limit, "_keep",
                               max_group_rows=draws_per_positive * t.most)          # group size <= 5 n_u
    return sel.where(F.col("_keep")).select("epoch", "user", "item")


# ---------------------------------------------------------------- generated ranges

RANGE_CHUNK = 100_000          # integers generated from one row in one task
ROWS_PER_PARTITION = 2_000_000


def explode_range(df: DataFrame, keys: list[str], start: Column, stop: Column, out: str,
                  chunk: int = RANGE_CHUNK) -> DataFrame:
    """Every row of ``df`` times the integers start..stop (inclusive) in ``out``.
    A row-multiplying generate straight after a small aggregate would run in the
    few partitions the aggregate needed (a hot key's whole range in one task);
    here each range is cut into chunks of at most ``chunk`` values, the chunk rows
    are hash-partitioned on (keys, chunk) into enough partitions for the total
    number of generated rows, and only then exploded."""
    spark = df.sparkSession
    d = df.withColumn("_s", start.cast("long")).withColumn("_e", stop.cast("long")).where(F.col("_e") >= F.col("_s"))
    total = d.agg(F.sum(F.col("_e") - F.col("_s") + 1)).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-int(total) // ROWS_PER_PARTITION))
    c = d.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_e") - F.col("_s")) / chunk))))
    c = (c.withColumn("_lo", F.col("_s") + F.col("_c") * chunk)
         .withColumn("_hi", F.least(F.col("_e"), F.col("_s") + (F.col("_c") + 1) * chunk - 1))
         .repartition(parts, *keys, "_c"))
    return c.withColumn(out, F.explode(F.sequence("_lo", "_hi"))).drop("_s", "_e", "_c", "_lo", "_hi")
