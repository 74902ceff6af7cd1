import numpy as np
import pytest

from tastemap.llm import neardup_vectors as nv

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.9):
    ok = [v is not None and not any(x is None or not np.isfinite(x) for x in v) and any(v) for _, v, *_ in rows]
    width = max((len(v) for (_, v, *_), o in zip(rows, ok) if o), default=1)
    x = np.zeros((len(rows), width))
    for i, (r, o) in enumerate(zip(rows, ok)):
        if o:
            x[i, :len(r[1])] = np.array(r[1], dtype=np.float32)
    norm = np.linalg.norm(x, axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        near = (x @ x.T) / np.outer(norm, norm) >= cosine
    near &= np.outer(ok, ok)
    np.fill_diagonal(near, False)
    label = np.arange(len(rows))
    while True:
        new = np.array([min(label[i], *label[near[i]], label[i]) if near[i].any() else label[i] for i in range(len(rows))])
        if (new == label).all():
            break
        label = new
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        c = (min(ids) if ids else None) if near[i].any() else r[0]
        out.append((r[0], int(near[i].sum()), c, r[0] is not None and r[0] == c))
    return sorted(out, key=str)


def vectors():
    rng = np.random.default_rng(5)
    rows = []
    for g in range(60):
        base = rng.normal(size=16)
        for _ in range(rng.choice([1, 1, 2, 5, 90 if g == 0 else 1])):
            rows.append((base + rng.normal(size=16) * rng.choice([0.02, 0.2, 0.35])).astype(np.float32))
    order = rng.permutation(len(rows))
    return [(int(o) * 3, [float(x) for x in v], 0) for o, v in zip(order, rows)]


EDGES = [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, [1.0, None], 1),
         (5004, [float("inf")] + [0.0] * 15, 1), (None, [1.0] + [0.0] * 15, 1), (5005, [3.0] + [0.0] * 15, 1),
         (5006, [3.0], 1), (5007, [-0.0] * 16, 1), (None, None, 1)]


@pytest.mark.parametrize("block", [2048, 16])
def test_matches_brute_force(spark, block):
    rows = vectors()
    rows += EDGES + [rows[0], rows[0], (rows[0][0], rows[7][1], 0)]
    got = nv.near_duplicate_vectors(spark.createDataFrame([(*r, 9) for r in rows], SCHEMA + ", n_links int"), block=block)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("spread", [0, 6000])
def test_pairs_in_a_dense_cluster_that_does_not_link(spark, spread):
    """600 vectors at cosine about 0.8 to each other with 60 pairs just above the threshold:
    runs of equal signs are far longer than the window.  With many others around them only
    their runs are compared in blocks, alone all vectors are."""
    rng = np.random.default_rng(9)
    centre = rng.normal(size=64)
    centre /= np.linalg.norm(centre)

    def around(c, cosine):
        other = rng.normal(size=64)
        other -= (other @ c) / (c @ c) * c
        return cosine * c + np.sqrt(1 - cosine ** 2) * other / np.linalg.norm(other) * np.linalg.norm(c)
    dense = [around(centre, 0.9) for _ in range(540)]
    dense += [around(dense[i], 0.905) for i in range(60)]
    rows = [(i, [float(x) for x in v.astype(np.float32)], 0) for i, v in enumerate(dense)]
    rows += [(1000 + i, [float(x) for x in v], 0) for i, v in enumerate(rng.normal(size=(spread, 64)).astype(np.float32))]
    got = nv.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA), window=16, block=128, passes=None if not spread else 40)
    got = {r["id"]: tuple(r) for r in got.collect()}
    want = brute(rows[:600])
    assert sum(r[1] for r in want) >= 120
    assert [r for r in want if got[r[0]] != r] == []


def test_copies_and_empty(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(300)] + [(900 + i, [2.0, -1.0], 0) for i in range(3)]
    got = nv.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(299, 0), (2, 900)}
    assert sum(r["kept"] for r in got) == 2
    assert nv.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nv.near_duplicate_vectors(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect()[0]["kept"]


def test_passes_grow_with_the_table():
    assert nv.passes_for(100) <= nv.passes_for(10_000) < nv.passes_for(10_000_000)


def test_band_forest_spans():
    rng = np.random.default_rng(2)
    m = np.triu(rng.random((40, 40)) < 0.04, 1)
    a, b = nv.band_forest(m)

    def parts(edges):
        root = list(range(40))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i
        for i, j in edges:
            root[find(i)] = find(j)
        return {frozenset(g) for g in ([x for x in range(40) if find(x) == find(i)] for i in range(40))}
    assert parts(zip(a, b)) == parts(zip(*np.nonzero(m))) and len(a) == 40 - len(parts(zip(a, b)))
