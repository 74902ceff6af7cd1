"""Boosted trees and logistic regression for click prediction.

The trees (``trees.py``) turn a row into its leaves, one per tree; the regression weighs the
leaves.  Rows with the same leaves and label are one row with a count to the regression, so
its passes run over the distinct combinations of leaves, and a step's gradient and curvature
are sums by slot and by pair of slots.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .trees import BoostedTrees, boosted_trees_fit

NEWTON_STEPS = 50
NEWTON_SIZE = 2000               # slots of the exact Newton step (its matrix is on the driver)


# ------------------------------------------------------------------ T11

def leaf_slots(leaves: Column, width: int) -> Column:
    """The position of every tree's 1 in the one-hot row: tree t, leaf l -> t·width + l."""
    return F.transform(leaves, lambda leaf, t: t * width + leaf)


def one_hot_vector(slots: Column, size: int) -> Column:
    """The one-hot row itself, as array<int> of 0 and 1."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: F.array_contains(slots, j).cast("int"))


# ------------------------------------------------------------------ regression on slots

@dataclass
class SlotRegression:
    """coefficients[c][slot] and intercepts[c]; one row of them for two classes."""
    coefficients: list[list[float]]
    intercepts: list[float]

    def scores(self, slots: Column) -> list[Column]:
        out = []
        for weights, start in zip(self.coefficients, self.intercepts):
            table = F.array(*[F.lit(float(w)) for w in weights])
            out.append(F.lit(float(start)) + F.aggregate(slots, F.lit(0.0), lambda a, s: a + F.get(table, s)))
        return out

    def probabilities(self, slots: Column) -> Column:
        """array<double> by class."""
        scores = self.scores(slots)
        if len(scores) == 1:
            p = F.lit(1.0) / (F.lit(1.0) + F.exp(-scores[0]))
            return F.array(F.lit(1.0) - p, p)
        s = F.array(*scores)
        e = F.transform(s, lambda x: F.exp(x - F.array_max(s)))
        return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def _sums(combos: DataFrame, model: SlotRegression, size: int) -> tuple[float, np.ndarray, np.ndarray]:
    """(loss, gradient, Hessian) without the penalty over combos (slots, n, hits); slot
    ``size`` is the intercept."""
    score = model.scores(F.col("slots"))[0]
    rows = combos.withColumn("z", score).withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z"))))
    loss = F.col("n") * F.greatest("z", F.lit(0.0)) + F.col("n") * F.log1p(F.exp(-F.abs("z"))) - F.col("hits") * F.col("z")
    rows = rows.select(F.concat("slots", F.array(F.lit(size))).alias("s"), (F.col("n") * F.col("p") - F.col("hits")).alias("g"),
                       (F.col("n") * F.col("p") * (1 - F.col("p"))).alias("h"), loss.alias("l"))
    pairs = rows.select(F.explode("s").alias("a"), "s", "g", "h", "l").select("a", F.explode("s").alias("b"), "g", "h", "l")
    got = pairs.where("a <= b").groupBy("a", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("l").alias("l")).collect()
    gradient, hessian, total = np.zeros(size + 1), np.zeros((size + 1, size + 1)), 0.0
    for r in got:                                      # at most (slots + 1)² / 2 sums
        hessian[r["a"], r["b"]] = hessian[r["b"], r["a"]] = r["h"]
        if r["a"] == r["b"]:
            gradient[r["a"]] = r["g"]
            total = r["l"] if r["a"] == size else total
    return total, gradient, hessian


def slot_regression_fit(rows: DataFrame, slots: Column, label: Column, size: int, n_classes: int,
                        reg: float = 1.0) -> SlotRegression:
    """Logistic regression on one-hot slots: the minimum of Σ loss + reg/2 · Σ w² (the
    intercept is free).  ``label``: class number.  Two classes: Newton steps to the exact
    minimum; more, or more slots than ``NEWTON_SIZE``: Spark's own estimator."""
    counted = rows.select(slots.alias("slots"), label.alias("y")).groupBy("slots", "y").agg(F.count(F.lit(1)).alias("n"))
    if n_classes > 2 or size > NEWTON_SIZE:
        data = counted.select(array_to_vector(one_hot_vector(F.col("slots"), size).cast("array<double>")).alias("features"),
                              F.col("y").cast("double").alias("label"), F.col("n").cast("double").alias("weight"))
        n = data.agg(F.sum("weight")).first()[0]
        fitted = LogisticRegression(weightCol="weight", regParam=reg / n, standardization=False, maxIter=200, tol=1e-9,
                                    family="multinomial" if n_classes > 2 else "binomial").fit(data)
        return SlotRegression(fitted.coefficientMatrix.toArray().tolist(), fitted.interceptVector.toArray().tolist())
    combos = cut_lineage(counted.groupBy("slots").agg(
        F.sum("n").cast("double").alias("n"), F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).cast("double").alias("hits")))
    penalty = np.append(np.full(size, float(reg)), 0.0)
    x = np.zeros(size + 1)

    def at(x):
        loss, g, h = _sums(combos, SlotRegression([x[:-1].tolist()], [float(x[-1])]), size)
        return loss + 0.5 * float(penalty @ (x * x)), g + penalty * x, h + np.diag(penalty)
    loss, g, h = at(x)
    for _ in range(NEWTON_STEPS):
        step = -np.linalg.lstsq(h, g, rcond=None)[0]
        if np.abs(step).max() < 1e-10:
            break
        new = at(x + step)
        while new[0] > loss + 1e-9 * (1 + abs(loss)) and np.abs(step).max() > 1e-10:
            step = step / 2                             # the full step went past the minimum
            new = at(x + step)
        x, (loss, g, h) = x + step, new
    return SlotRegression([x[:-1].tolist()], [float(x[-1])])


# ------------------------------------------------------------------ P16, P17

@dataclass
class GbdtLrModel:
    trees: BoostedTrees
    regression: SlotRegression

    def slots(self) -> Column:
        return leaf_slots(self.trees.leaves(), self.trees.max_leaf_nodes)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with leaves, probability (array by class), prob (of the last class) and
        prediction (the likeliest class; ties: the first)."""
        out = df.select("*", self.trees.leaves().alias("leaves"))
        out = out.withColumn("probability", self.regression.probabilities(leaf_slots(F.col("leaves"), self.trees.max_leaf_nodes)))
        classes = F.array(*[F.lit(c) for c in self.trees.classes])
        best = F.array_position("probability", F.array_max("probability"))
        return (out.withColumn("prediction", F.element_at(classes, best.cast("int")))
                .withColumn("prob", F.element_at("probability", -1)))

    def to_dict(self) -> dict:
        return {"trees": self.trees.to_dict(), "coefficients": self.regression.coefficients, "intercepts": self.regression.intercepts}

    @classmethod
    def from_dict(cls, d: dict) -> "GbdtLrModel":
        return cls(BoostedTrees.from_dict(d["trees"]), SlotRegression(d["coefficients"], d["intercepts"]))


def gbdt_lr_fit(df: DataFrame, feature_cols: list[str], label_col: str = "label", n_estimators: int = 5,
                max_leaf_nodes: int = 10, learning_rate: float = 0.1, reg: float = 1.0, **tree_options) -> GbdtLrModel:
    """Boosted trees with ``max_leaf_nodes`` leaves each -> T11 -> logistic regression
    with an L2 weight ``reg`` on the summed loss; any number of classes."""
    trees = boosted_trees_fit(df, feature_cols, label_col, n_estimators, max_leaf_nodes, learning_rate, **tree_options)
    data = df.where(F.col(label_col).isNotNull())
    y = F.coalesce(*[F.when(F.col(label_col) == F.lit(c), F.lit(i)) for i, c in enumerate(trees.classes)])
    regression = slot_regression_fit(data, leaf_slots(trees.leaves(), max_leaf_nodes), y,
                                     len(trees.trees()) * max_leaf_nodes, len(trees.classes), reg)
    return GbdtLrModel(trees, regression)
