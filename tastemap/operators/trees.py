"""Boosted classification trees grown leaf by leaf, on histograms.

Features are cut into at most ``max_bins`` bins, once: at the midpoints between neighbouring
values where a feature has few, at quantiles otherwise.  A pass over the rows sums residuals
by (tree, node, feature, bin), with partial sums in every task; windows over these sums give
the best split of every node, one row each.  The leaf with the largest gain is split first,
until a tree has ``max_leaf_nodes`` leaves.  A pass serves the children of all leaves that
may be split next, and the trees of all classes, so that a tree takes about as many passes as
it has levels; the splits alone are on the driver.

A row goes left where value < threshold; null and NaN go right.  One tree a round for two
classes (log-odds), one per class for more (softmax).
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

MAX_CLASSES = 1000
GAIN_DIGITS = 9                 # gains are compared after rounding; ties: node, feature, bin


@dataclass
class Node:
    n: int
    value: float                 # what the leaf adds to the score, before the learning rate
    feature: int | None = None
    threshold: float | None = None
    gain: float | None = None
    left: int | None = None
    right: int | None = None
    leaf: int | None = None      # number among the leaves, from left to right


@dataclass
class Tree:
    nodes: list[Node]

    def number_leaves(self) -> "Tree":
        stack, n = [0], 0
        while stack:
            node = self.nodes[stack.pop()]
            if node.left is None:
                node.leaf, n = n, n + 1
            else:
                stack += [node.right, node.left]
        return self

    def choose(self, features: list[str], leaf_value) -> Column:
        """``leaf_value(node)`` of the leaf that a row falls into."""
        def down(i: int) -> Column:
            node = self.nodes[i]
            if node.left is None:
                return F.lit(leaf_value(node))
            x = F.col(f"`{features[node.feature]}`").cast("double")
            # infinity parts all known values from the missing ones
            left = x <= F.lit(math.inf) if node.threshold == math.inf else x < F.lit(node.threshold)
            return F.when(left, down(node.left)).otherwise(down(node.right))
        return down(0)


@dataclass
class BoostedTrees:
    """``rounds[t][c]``: the tree of round t for class c (one column of trees for two classes)."""
    features: list[str]
    classes: list
    start: list[float]
    learning_rate: float
    max_leaf_nodes: int
    rounds: list[list[Tree]] = field(default_factory=list)

    def trees(self) -> list[Tree]:
        return [tree for row in self.rounds for tree in row]

    def leaves(self) -> Column:
        """array<int>: the leaf of every tree that a row falls into."""
        return F.array(*[t.choose(self.features, lambda n: n.leaf).cast("int") for t in self.trees()])

    def scores(self) -> Column:
        """array<double>: the raw score of every class (of the second one alone if two)."""
        return F.array(*[sum((F.lit(self.learning_rate) * row[c].choose(self.features, lambda n: float(n.value))
                              for row in self.rounds), F.lit(float(s))) for c, s in enumerate(self.start)])

    def to_dict(self) -> dict:
        return {**{k: v for k, v in self.__dict__.items() if k != "rounds"},
                "rounds": [[[asdict(n) for n in t.nodes] for t in row] for row in self.rounds]}

    @classmethod
    def from_dict(cls, d: dict) -> "BoostedTrees":
        rounds = [[Tree([Node(**n) for n in t]) for t in row] for row in d["rounds"]]
        return cls(**{**d, "rounds": rounds})


# ------------------------------------------------------------------ bins

def bin_edges(df: DataFrame, features: list[str], max_bins: int) -> list[list[float]]:
    """Per feature its ascending thresholds (at most ``max_bins`` - 1); a feature with one
    value has none."""
    cols = {f: F.col(f"`{f}`").cast("double") for f in features}
    few = df.agg(*[F.approx_count_distinct(c).alias(f"_{i}") for i, c in enumerate(cols.values())]).first()
    out = []
    for i, c in enumerate(cols.values()):
        known = df.select(c.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
        if few[i] <= 2 * max_bins:
            values = sorted(r["x"] for r in known.distinct().limit(max_bins + 1).collect())
            if len(values) <= max_bins:
                out.append([(a + b) / 2 for a, b in zip(values, values[1:])])
                continue
        cuts = known.agg(F.percentile_approx("x", [j / max_bins for j in range(1, max_bins)], 100 * max_bins)).first()[0]
        least = known.agg(F.min("x")).first()[0]
        out.append(sorted({x for x in cuts if x > least}))
    return out


def binned(df: DataFrame, features: list[str], edges: list[list[float]]) -> DataFrame:
    """``df`` with b0, b1, ...: the number of thresholds <= value; missing values come last."""
    out = df
    for i, (f, e) in enumerate(zip(features, edges)):
        x = F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan")))
        if not e:
            out = out.withColumn(f"b{i}", F.when(F.isnan(x), 1).otherwise(0))
            continue
        out = Bucketizer(splits=[-math.inf, *e, math.inf], inputCol="_x", outputCol="_b", handleInvalid="keep").transform(
            out.withColumn("_x", x)).withColumn(f"b{i}", F.col("_b").cast("int")).drop("_x", "_b")
    return out


# ------------------------------------------------------------------ growing

@dataclass
class _Split:
    n: int
    r: float
    h: float
    feature: int | None
    bin: int | None
    gain: float


def _best_splits(rows: DataFrame, assigned: list[Column], n_features: int, min_leaf: int) -> dict[tuple[int, int], _Split]:
    """{(tree, node): totals and best split} of the nodes that ``assigned`` (one column a tree,
    null: none) names.  ``rows`` has b0.., and arrays r and h by tree."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), a.cast("int").alias("node"), F.lit(f).alias("f"), F.col(f"b{f}").alias("b"),
                               F.col("r")[c].alias("r"), F.col("h")[c].alias("h"))
                      for c, a in enumerate(assigned) for f in range(n_features)])
    long = rows.select(F.explode(cells).alias("x")).select("x.*").where("node is not null")
    hist = long.groupBy("c", "node", "f", "b").agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("r"), F.sum("h").alias("h"))
    own = Window.partitionBy("c", "node", "f")
    left = own.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.select("c", "node", "f", "b", *[F.sum(x).over(left).alias(f"{x}l") for x in ("n", "r")],
                      *[F.sum(x).over(own).alias(x) for x in ("n", "r", "h")])
    right_n, right_r = F.col("n") - F.col("nl"), F.col("r") - F.col("rl")
    step = F.col("rl") / F.col("nl") - right_r / right_n
    gain = F.when((F.col("nl") >= min_leaf) & (right_n >= min_leaf) & (right_n > 0),
                  F.round(F.col("nl") * right_n / F.col("n") * step * step, GAIN_DIGITS))
    gain = F.coalesce(F.when(gain > 0, gain), F.lit(0.0))
    best = (cum.groupBy("c", "node").agg(
        F.max(F.struct(gain.alias("gain"), (-F.col("f")).alias("f"), (-F.col("b")).alias("b"))).alias("m"),
        F.max_by(F.struct("n", "r", "h"), F.struct((-F.col("f")), "b")).alias("t")))
    return {(r["c"], r["node"]): _Split(r["t"]["n"], r["t"]["r"], r["t"]["h"], *((-r["m"]["f"], -r["m"]["b"]) if r["m"]["gain"] > 0
                                        else (None, None)), r["m"]["gain"]) for r in best.collect()}


class _Growing:
    """A tree in the making: nodes, the splits known so far, and the rows' way down by bins."""

    def __init__(self):
        self.nodes: list[_Split | None] = [None]
        self.kids: dict[int, tuple[int, int]] = {}       # of the nodes that are split
        self.ahead: dict[int, tuple[_Split, _Split]] = {}  # children known, split or not
        self.depth = {0: 0}

    def open(self, max_depth: int | None) -> list[int]:
        return [i for i, s in enumerate(self.nodes) if i not in self.kids and s.feature is not None
                and (max_depth is None or self.depth[i] < max_depth)]

    def unseen(self, wanted: list[int]) -> Column:
        """2·i + side for the rows in a leaf i of ``wanted`` whose children are not known."""
        def down(i):
            s = self.nodes[i]
            side = F.when(F.col(f"b{s.feature}") <= s.bin, 0).otherwise(1) if s and s.feature is not None else None
            if i in self.kids:
                return F.when(side == 0, down(self.kids[i][0])).otherwise(down(self.kids[i][1]))
            return F.lit(2 * i) + side if i in wanted else F.lit(None).cast("int")
        return down(0)

    def split(self, i: int) -> None:
        a = len(self.nodes)
        self.nodes += self.ahead[i]
        self.kids[i] = (a, a + 1)
        self.depth[a] = self.depth[a + 1] = self.depth[i] + 1

    def finished(self, edges: list[list[float]], scale: float) -> Tree:
        out = []
        for i, s in enumerate(self.nodes):
            node = Node(s.n, scale * s.r / s.h if abs(s.h) > 1e-150 else 0.0)
            if i in self.kids:
                e = edges[s.feature]
                # the split after the last threshold parts the missing values from the others
                node.feature, node.gain = s.feature, s.gain
                node.threshold = e[s.bin] if s.bin < len(e) else math.inf
                node.left, node.right = self.kids[i]
            out.append(node)
        return Tree(out).number_leaves()


def grow(rows: DataFrame, n_trees: int, n_features: int, edges: list[list[float]], max_leaf_nodes: int, min_leaf: int,
         max_depth: int | None, scale: float) -> list[Tree]:
    """One tree for each entry of the rows' arrays r (residuals) and h (curvatures), all
    grown in the same passes."""
    trees = [_Growing() for _ in range(n_trees)]
    root = _best_splits(rows, [F.lit(0)] * n_trees, n_features, min_leaf)
    for c, t in enumerate(trees):
        t.nodes[0] = root[(c, 0)]
    while True:
        wanted: list[list[int]] = []
        for t in trees:
            need = []
            while len(t.kids) + 1 < max_leaf_nodes and (open_ := t.open(max_depth)):
                i = min(open_, key=lambda i: (-t.nodes[i].gain, i))
                if i not in t.ahead:
                    need = [j for j in open_ if j not in t.ahead]
                    break
                t.split(i)
            wanted.append(need)
        if not any(wanted):
            break
        found = _best_splits(rows, [t.unseen(w) for t, w in zip(trees, wanted)], n_features, min_leaf)
        for c, (t, w) in enumerate(zip(trees, wanted)):
            t.ahead.update({i: (found[(c, 2 * i)], found[(c, 2 * i + 1)]) for i in w})
    return [t.finished(edges, scale) for t in trees]


# ------------------------------------------------------------------ boosting

def boosted_trees_fit(df: DataFrame, features: list[str], label_col: str, n_estimators: int = 5, max_leaf_nodes: int = 10,
                      learning_rate: float = 0.1, min_leaf: int = 1, max_depth: int | None = None,
                      max_bins: int = 256) -> BoostedTrees:
    """Gradient boosting with the logistic (two classes) or softmax loss: a leaf's value is
    the Newton step Σr / Σp(1 - p) of its rows (times (K - 1) / K for K > 2 classes).  Rows
    without a label take no part."""
    if max_leaf_nodes < 2:
        raise ValueError("a tree needs two leaves or more")
    data = df.where(F.col(label_col).isNotNull())
    counts = data.groupBy(label_col).count().limit(MAX_CLASSES + 1).collect()
    if not 2 <= len(counts) <= MAX_CLASSES:
        raise ValueError(f"{len(counts)} classes: between 2 and {MAX_CLASSES} are possible")
    counts = sorted((r[0], r[1]) for r in counts)
    classes, n = [c for c, _ in counts], sum(m for _, m in counts)
    two = len(classes) == 2
    start = [math.log(counts[1][1] / counts[0][1])] if two else [math.log(m / n) for _, m in counts]
    model = BoostedTrees(list(features), classes, start, learning_rate, max_leaf_nodes)
    edges = bin_edges(data, features, max_bins)
    y = F.coalesce(*[F.when(F.col(label_col) == F.lit(c), F.lit(i)) for i, c in enumerate(classes)])
    bins = [f"b{i}" for i in range(len(features))]
    rows = binned(data.select(y.alias("y"), *[F.col(f"`{f}`") for f in features]), features, edges)
    rows = cut_lineage(rows.select("y", *bins, F.array(*[F.lit(s) for s in start]).alias("score")))
    for t in range(n_estimators):
        if two:
            p = F.array(F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("score")[0])))
            hit = [(F.col("y") == 1).cast("double")]
        else:
            # the largest score is taken off first, so that no exponential overflows
            e = F.transform("score", lambda s: F.exp(s - F.array_max("score")))
            p = F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))
            hit = [(F.col("y") == c).cast("double") for c in range(len(classes))]
        part = cut_lineage(rows.withColumn("p", p).select(
            "y", *bins, "score", F.array(*[h - F.col("p")[c] for c, h in enumerate(hit)]).alias("r"),
            F.transform("p", lambda x: x * (1 - x)).alias("h")))
        trees = grow(part, len(start), len(features), edges, max_leaf_nodes, min_leaf, max_depth,
                     1.0 if two else (len(classes) - 1) / len(classes))
        model.rounds.append(trees)
        if t + 1 < n_estimators:
            added = [F.col("score")[c] + F.lit(learning_rate) * _by_bins(tree, edges) for c, tree in enumerate(trees)]
            rows = part.select("y", *bins, F.array(*added).alias("score"))
    return model


def _by_bins(tree: Tree, edges: list[list[float]]) -> Column:
    """The value of the leaf that a binned row falls into."""
    def down(i):
        n = tree.nodes[i]
        if n.left is None:
            return F.lit(float(n.value))
        e = edges[n.feature]
        at = e.index(n.threshold) if n.threshold != math.inf else len(e)
        return F.when(F.col(f"b{n.feature}") <= at, down(n.left)).otherwise(down(n.right))
    return down(0)
