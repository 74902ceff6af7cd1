import math
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemap.operators import trees as T
from tastemap.operators.fm_ctr import gbdt_lr_fit, leaf_slots, one_hot_vector, slot_regression_fit
from tastemap.sources.models import load_model, save_model


def plain_tree(x, r, h, max_leaf_nodes, min_leaf, scale):
    """Best-first tree by trying every cut; nodes as (rows, split)."""
    def best(idx):
        found = (0.0,)
        for f in range(x.shape[1]):
            known = sorted({v for v in x[idx, f] if not math.isnan(v)})
            every = sorted({v for v in x[:, f] if not math.isnan(v)})
            cuts = [(a + b) / 2 for a, b in zip(every, every[1:])] + [math.inf]
            for j, c in enumerate(cuts):
                left = [i for i in idx if (x[i, f] < c)]
                right = [i for i in idx if not (x[i, f] < c)]
                if min(len(left), len(right)) < max(1, min_leaf) or not known:
                    continue
                d = r[left].mean() - r[right].mean()
                gain = round(len(left) * len(right) / len(idx) * d * d, 9)
                if gain > found[0]:
                    found = (gain, f, c, left, right)
        return found
    nodes = [list(range(len(x)))]
    splits, leaves = {}, 1
    while leaves < max_leaf_nodes:
        todo = [(i, best(nodes[i])) for i in range(len(nodes)) if i not in splits]
        todo = [t for t in todo if t[1][0] > 0]
        if not todo:
            break
        i, b = min(todo, key=lambda t: (-t[1][0], t[0]))
        splits[i] = (b[1], b[2], len(nodes), b[0])
        nodes += [b[3], b[4]]
        leaves += 1
    value = [scale * r[n].sum() / h[n].sum() for n in nodes]
    return nodes, splits, value


def table(spark, n, classes, seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[rng.random(n) < 0.1, 1] = np.nan
    y = (np.nan_to_num(x[:, 0] + x[:, 1] * x[:, 2]) * 2 + rng.normal(size=n)).round().astype(int) % classes
    data = [(i, *[None if math.isnan(v) and i % 2 else float(v) for v in row], f"c{c}") for i, (row, c) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(data, "id long, a double, b double, c double, label string")


@pytest.mark.parametrize("classes,leaves,min_leaf", [(2, 6, 1), (2, 10, 15), (3, 5, 1)])
def test_equals_brute_force(spark, classes, leaves, min_leaf):
    x, y, df = table(spark, 160, classes, leaves)
    m = T.boosted_trees_fit(df, ["a", "b", "c"], "label", 2, leaves, 0.5, min_leaf)
    assert m.classes == [f"c{c}" for c in range(classes)]
    share = np.bincount(y, minlength=classes) / len(y)
    score = np.tile(np.log(share) if classes > 2 else [math.log(share[1] / share[0])], (len(y), 1))
    for row in m.rounds:
        if classes == 2:
            p = 1 / (1 + np.exp(-score))
            hit = (y == 1).astype(float)[:, None]
        else:
            p = np.exp(score) / np.exp(score).sum(1, keepdims=True)
            hit = np.eye(classes)[y]
        for c, tree in enumerate(row):
            nodes, splits, value = plain_tree(x, hit[:, c] - p[:, c], p[:, c] * (1 - p[:, c]), leaves, min_leaf,
                                              1.0 if classes == 2 else (classes - 1) / classes)
            assert len(tree.nodes) == len(nodes) and sum(n.left is None for n in tree.nodes) == len(splits) + 1
            for i, n in enumerate(tree.nodes):
                assert n.n == len(nodes[i]) and abs(n.value - value[i]) < 1e-9
                if i in splits:
                    f, cut, left, gain = splits[i]
                    assert (n.feature, n.left, n.right) == (f, left, left + 1) and n.threshold == pytest.approx(cut)
                    assert n.gain == pytest.approx(gain, abs=2e-9)
                else:
                    score[nodes[i], c] += 0.5 * value[i]
    got = {r["id"]: r for r in df.select("id", m.scores().alias("s"), m.leaves().alias("l")).collect()}
    assert np.allclose([got[i]["s"] for i in range(len(y))], score, atol=1e-9)
    assert all(0 <= leaf < leaves for r in got.values() for leaf in r["l"])


def test_exactly_as_many_leaves_and_depth_limit(spark):
    _, _, df = table(spark, 300, 2, 3)
    m = T.boosted_trees_fit(df, ["a", "b", "c"], "label", 1, 10)
    assert sum(n.left is None for n in m.rounds[0][0].nodes) == 10
    stump = T.boosted_trees_fit(df, ["a", "b", "c"], "label", 1, 10, max_depth=1)
    assert len(stump.rounds[0][0].nodes) == 3
    with pytest.raises(ValueError):
        T.boosted_trees_fit(df.where("label = 'c1'"), ["a"], "label")


def test_quantile_bins_of_many_values(spark):
    df = spark.range(5000).select((F.col("id") * 1.0).alias("a"), F.lit(7.0).alias("b"), (F.col("id") >= 3000).cast("int").alias("label"))
    edges = T.bin_edges(df, ["a", "b"], 16)
    assert len(edges[0]) <= 15 and edges[0] == sorted(edges[0]) and edges[1] == []
    m = T.boosted_trees_fit(df, ["a", "b"], "label", 3, 4, max_bins=16)
    wrong = df.where((m.scores()[0] > 0) != (F.col("label") == 1)).count()
    assert wrong < 5000 / 16


def test_regression_is_the_minimum(spark):
    rng = np.random.default_rng(4)
    leaves = rng.integers(0, 3, size=(300, 2))
    y = (rng.random(300) < 0.2 + 0.2 * leaves[:, 0]).astype(int)
    df = spark.createDataFrame([(list(map(int, row)), int(t)) for row, t in zip(leaves, y)], "l array<int>, y int")
    slots = leaf_slots(F.col("l"), 3)
    m = slot_regression_fit(df, slots, F.col("y"), 6, 2)
    x = np.zeros((300, 7))
    x[:, 6] = 1
    for t in range(2):
        x[np.arange(300), 3 * t + leaves[:, t]] = 1
    w = np.array(m.coefficients[0] + m.intercepts)
    gradient = x.T @ (1 / (1 + np.exp(-x @ w)) - y) + np.append(w[:6], 0)
    assert np.abs(gradient).max() < 1e-8
    assert [tuple(r[0]) for r in df.select(one_hot_vector(slots, 6)).collect()] == [tuple(map(int, r[:6])) for r in x]


@pytest.mark.parametrize("classes", [2, 3])
def test_gbdt_lr(spark, classes):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int) if classes == 2 else (x[:, 0] > 0).astype(int) + (x[:, 1] > 0)
    df = spark.createDataFrame([(i, *map(float, row), f"c{c}") for i, (row, c) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, label string")
    m = gbdt_lr_fit(df, ["a", "b", "c"], n_estimators=4, max_leaf_nodes=8, learning_rate=0.5)
    out = m.transform(df).select("id", "label", "probability", "prob", "prediction").collect()
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 and r["prob"] == r["probability"][-1] for r in out)
    assert np.mean([r["label"] == r["prediction"] for r in out]) > 0.85
    path = tempfile.mkdtemp(prefix="tastemap-test-") + "/gbdt"
    save_model(m, path)
    again = load_model(spark, path).transform(df).select("id", "prob").collect()
    assert {r["id"]: r["prob"] for r in again} == {r["id"]: r["prob"] for r in out}
