import hashlib
import math
import random

import numpy as np
import pytest

from tastemap.llm import centroids as C

from .oracle import same_rows

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string"
DIM = 6


def plain(rows, dim, clusters, rounds, scale=1024):
    kept = [(i, [C._whole([x], scale)[0] for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents)) for _, v in kept]
    for _ in range(rounds):
        got = assign()
        for k in range(len(cents)):
            own = [v for (_, v), (_, j) in zip(kept, got) if j == k]
            if own:
                cents[k] = [sum(x) // len(own) for x in zip(*own)]
    got = assign()
    cap = lambda x: min(x, C.MOST)
    each = {k: sum(cap(d) for d, j in got if j == k) for k in range(len(cents))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(str((i, k, cap(d), cap(each[k]), cap(sum(each.values())), sha[k])) for (i, _), (d, k) in zip(kept, got))


def rows_of(n, seed, dim=DIM):
    rnd = random.Random(seed)
    mids = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    out = [(i, [float(np.float32(m + rnd.gauss(0, 0.3))) for m in mids[i % 5]]) for i in range(n)]
    out += [(1000 + i, out[0][1]) for i in range(n // 3)]               # a hot vector
    odd = [None, [], [1.0] * (dim - 1), [None] + [0.0] * (dim - 1), [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1)]
    out += [(2000 + i, v) for i, v in enumerate(odd)]
    return out + [(None, [0.5] * dim), (3, out[3][1]), (3, [-0.25] * dim), (4, [0.0] * dim), (5, [-0.0] * dim)]


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], SCHEMA)
    out = C.cluster_vectors(frame, dimensions=DIM, **kw).collect()
    return sorted(str(tuple(r)) for r in out)


@pytest.mark.parametrize("block,clusters,rounds", [(4, 8, 3), (512, 3, 10), (16, 5, 0)])
def test_equals_plain_rounds(spark, block, clusters, rounds):
    rows = rows_of(120, clusters)
    assert run(spark, rows, block=block, clusters=clusters, rounds=rounds) == plain(rows, DIM, clusters, rounds)


def test_few_vectors_and_none(spark):
    rows = [(1, [1.0] * DIM), (1, [1.0] * DIM), (2, [2.0] * DIM)]
    assert run(spark, rows) == plain(rows, DIM, 8, 10)
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []


def test_large_components_stay_exact(spark):
    rows = rows_of(30, 7) + [(900 + i, [float(np.float32(10.0 ** (3 * i))) * s for s in (1, -1, 1, -1, 1, 1)]) for i in range(1, 12)]
    assert run(spark, rows, clusters=4, rounds=4) == plain(rows, DIM, 4, 4)


def test_matches_sql(spark, duck):
    rnd = random.Random(11)
    rows = [(i, [float(np.float32(rnd.gauss(i % 4, 0.5))) for _ in range(64)], 0) for i in range(300)]
    rows += [(500, None, 0), (501, [0.0] * 64, 0), (501, [0.0] * 64, 1), (502, [1.0] * 63, 0), (503, [float("nan")] * 64, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    same_rows(duck, frame, "embeddings", C.clusters_sql(), C.cluster_vectors(frame).withColumnRenamed("id", "vec_id"))


def test_curve_visits_neighbours():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        side = 1 << bits
        cells = np.array(np.meshgrid(*[range(side)] * axes)).reshape(axes, -1).T
        keys = C.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(side ** axes))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_boxes_rule_out_far_centroids_only():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        m = rnd.integers(-50, 50, (20, 4)) + rnd.integers(-300, 300, 4)
        cents = [rnd.integers(-300, 300, 4) for _ in range(6)]
        left = C.candidates(m.min(axis=0), m.max(axis=0), cents)
        which, d = C.nearest(m, list(range(6)), cents)
        assert set(which.tolist()) <= set(left)
        again, e = C.nearest(m, left, cents)
        assert (again == which).all() and (d == e).all()
    blob = rnd.integers(-5, 5, (20, 4))
    assert C.candidates(blob.min(axis=0), blob.max(axis=0), [np.full(4, 0), np.full(4, 500)]) == [0]
