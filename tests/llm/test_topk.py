import numpy as np
import pytest

from tastemap.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, step=50):
    seen = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        seen[i, tuple(v)] = np.floor(256.0 * np.array(v, dtype=np.float32).astype(np.float64)).astype(np.int64)
    out = []
    for (q, _), a in seen.items():
        if q % step == 0:
            s = sorted((-int(a[:min(len(a), len(b))] @ b[:min(len(a), len(b))]), c)
                       for (c, _), b in seen.items() if c != q)
            out += [(q, r + 1, c, -x) for r, (x, c) in enumerate(s[:k])]
    return sorted(out)


def vectors(n=700, d=24, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) * rng.choice([0.3, 1.0, 2.5], n)[:, None]
    base[::9] = base[3] + 0.01 * rng.normal(size=base[::9].shape)         # a group of near copies
    base[5::31] = base[5]                                                # ties
    return [(i, [float(x) for x in v], 0) for i, v in enumerate(base.astype(np.float32))]


@pytest.mark.parametrize("block, chunk", [(8192, 4096), (64, 4)])
def test_matches_brute_force(spark, block, chunk):
    rows = vectors()
    rows += [(1000, None, 1), (1050, [1.0, None], 1), (1100, [float("nan")] * 24, 1), (1150, [float("inf")] * 24, 1),
             (None, [9.0] * 24, 1), (1200, [0.0] * 24, 1), (-50, [0.5] * 24, 1), (1250, [1.0, 2.0], 1), rows[0], rows[50]]
    got = topk.top_inner_products(spark.createDataFrame(rows, SCHEMA), block_rows=block, chunk_rows=chunk)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_pruning_keeps_the_best():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(500, 32)) * 200)
    q = np.floor(rng.normal(size=(40, 32)) * 200)
    turn = np.linalg.qr(rng.normal(size=(32, 32)))[0]
    scores = (q @ x.T).astype(np.int64)
    floor = np.sort(scores, axis=1)[:, -5].astype(float)
    i, j, s = topk.best_of_block(np.arange(1000, 1040), q, floor, np.arange(500), x, turn, 5, step=7)
    for r in range(40):
        want = sorted(zip(-scores[r], range(500)))[:5]
        assert [(-a, b) for a, b in want] == list(zip(s[i == r].tolist(), j[i == r].tolist()))


def test_few_rows_and_none(spark):
    assert topk.top_inner_products(spark.createDataFrame([], SCHEMA)).count() == 0
    assert topk.top_inner_products(spark.createDataFrame([(0, [1.0], 0)], SCHEMA)).count() == 0
    assert topk.top_inner_products(spark.createDataFrame([(1, [1.0], 0), (2, [1.0], 0)], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(0, [1.0], 7, 1), (1, [1.0], 7, 2)], "vec_id long, embedding array<double>, rank int, v int")
    assert [tuple(r) for r in topk.top_inner_products(clash).collect()] == [(0, 1, 1, 65536)]


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**22, 1.0], 0), (1, [2.0**22, 3.0], 0), (2, [2.0**22, 2.0], 0)]
    got = topk.top_inner_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 2**60 + 3 * 65536), (2, 2**60 + 2 * 65536)]
