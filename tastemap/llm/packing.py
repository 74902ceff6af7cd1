"""Best-fit packing of tokenised documents into sequences of a fixed length.

The plan is made on the histogram of piece lengths, which has at most ``capacity`` rows
whatever the corpus size:

1. lengths are grouped into at most ``CLASSES`` classes of like mass; a configuration is
   a multiset of classes whose upper lengths fit one sequence;
2. the configuration linear program (fewest sequences that cover every class) is solved
   by multiplicative weights: each round prices the classes by how little they are
   covered so far, and a knapsack dynamic program finds the best configuration;
3. rounding: a share of the solution is rounded down; its configurations are filled with
   actual lengths, largest first, the gap is closed best-fit with the largest lengths that
   fit, and a pattern without room left is repeated until a length runs out.  What is left,
   pieces of every size, is packed best-fit decreasing.  Of the shares in ``SHARES`` the one with the fewest
   sequences counts.

The result is a table of patterns (which lengths, how often, how many sequences).  The
pieces get their places on the executors: a piece is numbered among the pieces of its
length (numbers are dealt per hash bucket, so that a very common length is no hot group)
and its number selects the interval of the pattern it belongs to.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_value, written
from .tokens import encoder, vocabulary_path

CAPACITY = 4096
END_ID = 1
CLASSES = 64
ROUNDS = 2000
GRID = 512                        # capacity units of the knapsack
SHARES = (1.0, 0.9, 0.5, 0.25, 0.1)   # of the linear program's solution that is rounded
STEP = 40.0                       # weight step: exp(-STEP * covered share)
BUCKET_ROWS = 1000                # pieces of one length numbered by one window group

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ------------------------------------------------------------------ pieces

def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 end_id: int = END_ID, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row: its ids and the end
    id, cut every ``capacity`` ids.  Null and empty texts have the end id alone."""
    path = vocabulary or vocabulary_path()
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        from zlib import crc32

        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder(path)(part.column(1).to_pylist())):
                    ids += end
                    for k, s in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[s:s + 4 * capacity]
                        rows.append((doc_id, k, s // 4, len(piece) // 4, crc32(piece), *((piece,) if with_ids else ())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types(pa))],
                                                 names=[f"c{i}" for i in range(5 + with_ids)])

    def types(pa):
        return [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    schema = PIECES + (", ids binary" if with_ids else "")
    out = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        cut, ", ".join(f"c{i} {f.split()[1]}" for i, f in enumerate(schema.split(", "))))
    return out.toDF(*[f.split()[0] for f in schema.split(", ")])


# ------------------------------------------------------------------ plan on the histogram

def length_classes(lengths: np.ndarray, counts: np.ndarray, most: int = CLASSES) -> np.ndarray:
    """Class number of each length (ascending lengths): runs of about equal mass."""
    mass = np.cumsum(counts * lengths) - counts * lengths / 2
    return np.unique((mass * most / max(1, (counts * lengths).sum())).astype(int), return_inverse=True)[1]


def best_configuration(upper: np.ndarray, profit: np.ndarray, capacity: int) -> np.ndarray:
    """Counts of each class with the largest total profit that fit (unbounded knapsack).

    Per class, best[c] = max over j of before[c - j*u] + j*p is a running maximum over
    the columns of the table folded at width u."""
    tables = [np.zeros(capacity + 1)]
    for u, p in zip(upper.tolist(), profit.tolist()):
        rows = -(-(capacity + 1) // u)
        folded = np.full(rows * u, -np.inf)
        folded[:capacity + 1] = tables[-1]
        steps = np.arange(rows)[:, None] * p
        folded = np.maximum.accumulate(folded.reshape(rows, u) - steps, axis=0) + steps
        tables.append(folded.ravel()[:capacity + 1])
    counts = np.zeros(len(upper), dtype=np.int64)
    c = capacity
    for k in range(len(upper) - 1, -1, -1):
        u, p = int(upper[k]), profit[k]
        j = np.arange(c // u + 1)
        counts[k] = int(np.argmax(tables[k][c - j * u] + j * p))
        c -= counts[k] * u
    return counts


def configuration_lp(size: np.ndarray, demand: np.ndarray, capacity: int, rounds: int, total: float):
    """[(counts per class, number of sequences)]: an approximate solution of the covering
    program by multiplicative weights; every round adds ``total / rounds`` sequences."""
    share = total / rounds
    covered = np.zeros(len(size))
    found: dict[tuple, float] = {}
    for _ in range(rounds):
        weight = np.exp(-STEP * (covered - covered.min()))
        config = best_configuration(size, weight / demand, capacity)
        key = tuple(config.tolist())
        found[key] = found.get(key, 0.0) + share
        covered += share * config / demand
    return [(np.array(k), x) for k, x in found.items()]


class _Stock:
    """Remaining pieces by length; the largest remaining length up to a limit is found
    through links to the next smaller one that is left."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.left = [0] * (capacity + 1)
        for n, c in histogram.items():
            self.left[n] = c
        self.down = list(range(capacity + 1))

    def largest(self, limit: int) -> int:
        path = []
        while limit > 0 and not self.left[limit]:
            path.append(limit)
            self.down[limit] = min(self.down[limit], limit - 1)
            limit = self.down[limit]
        for p in path:
            self.down[p] = limit
        return limit


def _fill(stock: _Stock, wanted: list[int], capacity: int) -> dict[int, int]:
    """One sequence: for each wanted upper length (descending) the largest length left that
    leaves room for the smaller ones wanted, then best fit into the gap."""
    gap, pattern = capacity, {}

    def take(limit: int) -> int:
        while limit > 0:
            n = stock.largest(limit)
            if not n or stock.left[n] > pattern.get(n, 0):
                return n
            limit = n - 1
        return 0

    after = sum(wanted)
    for upper in wanted:
        after -= upper
        # the last one closes the gap: slack of the others is not lost
        if n := take(min(upper, gap) if after else gap):
            pattern[n] = pattern.get(n, 0) + 1
            gap -= n
    while gap > 0 and (n := take(gap)):
        fit = min(gap // n, stock.left[n] - pattern.get(n, 0))
        pattern[n] = pattern.get(n, 0) + fit
        gap -= n * fit
    return pattern


def best_fit_decreasing(left: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns for ``left[n]`` pieces of each length n, longest first, each into the fullest
    sequence that has room.  Sequences that look alike are handled together."""
    alike: list[list] = [[] for _ in range(capacity + 1)]        # by room: [pattern, sequences]
    room = np.zeros(capacity + 1, dtype=bool)
    for n in range(capacity, 0, -1):
        todo = left[n]
        while todo:
            g = n + int(np.argmax(room[n:])) if room[n:].any() else capacity
            if not room[g]:
                alike[g].append(((), -(-todo // (g // n))))
                room[g] = True
            pattern, times = alike[g].pop()
            room[g] = bool(alike[g])
            each = g // n
            full = min(times, todo // each)
            taken = [(full, each)] if full else []
            todo -= full * each
            if todo and times > full:                            # the last one takes what is left
                taken.append((1, todo))
                todo = 0
            for k, c in taken:
                alike[g - c * n].append(((*pattern, (n, c)), k))
                room[g - c * n] = True
                times -= k
            if times and pattern:
                alike[g].append((pattern, times))
                room[g] = True
    return [(dict(p), k) for row in alike for p, k in row if p]


def packing_patterns(histogram: dict[int, int], capacity: int = CAPACITY, classes: int = CLASSES,
                     rounds: int = ROUNDS, grid: int = GRID) -> list[tuple[dict[int, int], int]]:
    """[({length: pieces per sequence}, number of sequences)] that use the histogram up."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[n] for n in lengths.tolist()], dtype=np.float64)
    cls = length_classes(lengths, counts, classes)
    n_classes = cls.max() + 1
    demand = np.bincount(cls, counts, n_classes)
    upper = np.array([lengths[cls == k].max() for k in range(n_classes)])
    mean = np.bincount(cls, counts * lengths, n_classes) / demand
    unit = capacity / min(grid, capacity)
    size = np.maximum(1, np.round(mean / unit)).astype(int)
    configs = configuration_lp(size, demand, min(grid, capacity), rounds, float((counts * lengths).sum()) / capacity)
    # configurations of large classes first: small pieces are kept to close gaps
    configs.sort(key=lambda c: (-max(upper[c[0] > 0], default=0), -c[1]))
    bound = -(-sum(n * c for n, c in histogram.items()) // capacity)
    best = None
    for share in SHARES:
        found = _rounded(histogram, configs, upper, share, capacity)
        if best is None or sum(k for _, k in found) < sum(k for _, k in best):
            best = found
        if sum(k for _, k in best) == bound:             # no packing has fewer
            break
    return best


def _rounded(histogram: dict[int, int], configs, upper: np.ndarray, share: float, capacity: int):
    """``share`` of the configurations with actual lengths, the rest best-fit decreasing."""
    stock, patterns = _Stock(histogram, capacity), []
    for config, x in configs:
        wanted = np.repeat(upper, config)[::-1].tolist()
        todo = math.floor(share * x)
        while todo > 0 and wanted and stock.largest(capacity):
            pattern = _fill(stock, wanted, capacity)
            if sum(n * c for n, c in pattern.items()) < capacity:
                break                                    # room lost here is lost for good; the rest may do without
            times = min(todo, min(stock.left[n] // c for n, c in pattern.items()))
            for n, c in pattern.items():
                stock.left[n] -= c * times
            patterns.append((pattern, times))
            todo -= times
    return patterns + best_fit_decreasing(stock.left, capacity)


def pattern_intervals(patterns) -> dict[str, np.ndarray]:
    """For every (length, pattern): the numbers of the pieces it takes (from ``start``),
    pieces per sequence, first sequence, place of the first piece."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for n in sorted(pattern, reverse=True):
            c = pattern[n]
            start = taken.get(n, 0)
            rows.append((n, start, c, sequence, offset))
            taken[n] = start + c * times
            offset += n * c
        sequence += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "start", "each", "sequence", "offset"), cols))


# ------------------------------------------------------------------ places

def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, classes: int = CLASSES,
                 rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (a written table with a ``length`` column) with sequence_id and offset."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}      # at most capacity rows
    if any(n > capacity or n < 1 for n in histogram):
        raise ValueError("a piece is longer than a sequence")
    table = pattern_intervals(packing_patterns(histogram, capacity, classes, rounds))
    shared = broadcast_value(pieces, table)
    # a length's pieces are numbered in groups of about BUCKET_ROWS, one after the other
    groups = spark.createDataFrame([(n, math.ceil(c / BUCKET_ROWS)) for n, c in histogram.items()],
                                   "length long, __groups long")
    numbered = (pieces.join(F.broadcast(groups), "length")                              # at most capacity rows
                .withColumn("__bucket", F.pmod(F.xxhash64("__uid"), F.col("__groups"))).drop("__groups"))
    sizes = numbered.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    numbered = numbered.join(before, ["length", "__bucket"])
    order = Window.partitionBy("length", "__bucket").orderBy("__uid")
    numbered = numbered.withColumn("__number", F.col("__before") + F.row_number().over(order) - 1)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        t = shared.value
        n, r = length.to_numpy(np.int64), number.to_numpy(np.int64)
        span = np.int64(1) << np.int64(48)
        at = np.searchsorted(t["length"] * span + t["start"], n * span + r, side="right") - 1
        k = r - t["start"][at]
        return pd.DataFrame({"sequence_id": t["sequence"][at] + k // t["each"][at],
                             "offset": t["offset"][at] + (k % t["each"][at]) * n})

    kept = [c for c in pieces.columns if not c.startswith("__")]
    placed = numbered.withColumn("__place", place("length", "__number"))
    return placed.select(*kept, F.col("__place.sequence_id"), F.col("__place.offset"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, vocabulary: str | None = None, classes: int = CLASSES,
                   rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are pieces of the end id alone; repeated rows are packed as often
    as they occur; null ids stay null; an empty table gives no rows; extra columns are
    not carried (pieces are joined to documents by id)."""
    pieces = written(token_pieces(docs, id_col, text_col, capacity, end_id, vocabulary)
                     .withColumn("__uid", F.monotonically_increasing_id()), "pieces")
    return place_pieces(pieces, capacity, classes, rounds)


def packed_sequences(docs: DataFrame, places: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """(sequence_id, token_ids, doc_ids) from the places of ``pack_documents`` (ids must be
    unique): the ids of every sequence in order."""
    ids = token_pieces(docs, id_col, text_col, capacity, end_id, vocabulary, with_ids=True)
    rows = places.select("doc_id", "piece", "sequence_id", "offset").join(
        ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))       # one sequence: bounded
    bytes_of = rows.groupBy("sequence_id").agg(parts.alias("parts"))

    @F.pandas_udf("array<int>")
    def decode(parts: pd.Series) -> pd.Series:
        return parts.map(lambda ps: np.frombuffer(b"".join(p["ids"] for p in ps), dtype="<u4").astype(np.int32))

    return bytes_of.select("sequence_id", decode("parts").alias("token_ids"),
                           F.col("parts.doc_id").alias("doc_ids"))
