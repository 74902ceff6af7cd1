import hashlib
import math

import numpy as np
import pandas as pd
import pytest

from conftest import rows
from tastemap.operators import blocks as BL
from tastemap.operators import factor as FA
from tastemap.operators import sgd
from tastemap.operators import topn as TN
from tastemap.operators.factor import FactorModel, explicit_als, factor_predict, truncated_svd
from tastemap.operators.sgd import funk_svd, lfm_loss
from tastemap.operators.topn import factor_top_n, group_states


def _data(seed=0, users=20, items=15, n=150):
    rng = np.random.default_rng(seed)
    d = {}
    for u, i in zip(rng.integers(0, users, n), rng.integers(0, items, n)):
        d[(int(u) + 1, int(i) + 100)] = float(rng.integers(1, 6))
    return pd.DataFrame([(u, i, r) for (u, i), r in d.items()], columns=["user", "item", "rating"])


def _init(ids, k, seed, scale):
    def one(i, f):
        h = hashlib.md5(f"{i}:{f}:{seed}".encode()).hexdigest()
        u, v = (int(h[:8], 16) + 1) / 2**32, int(h[8:16], 16) / 2**32
        return math.sqrt(-2 * math.log(u)) * math.cos(2 * math.pi * v)
    return np.array([[one(i, f) for f in range(k)] for i in ids]) * scale


def test_start_factors_are_normal_and_distinct(spark):
    from pyspark.sql import functions as F
    from tastemap.functions.expr import portable_init
    df = spark.range(20_000).select(portable_init(F.col("id"), 3, 1).alias("f"))
    assert df.distinct().count() == 20_000
    m, s, c = df.select(F.avg(F.col("f")[0]), F.stddev(F.col("f")[1]), F.corr(F.col("f")[0], F.col("f")[2])).first()
    assert abs(m) < 0.03 and abs(s - 1) < 0.03 and abs(c) < 0.03
    got = spark.range(5).select(portable_init(F.col("id"), 4, 9, 0.1).alias("f")).collect()
    assert np.allclose([r["f"] for r in got], _init(range(5), 4, 9, 0.1))


def _als_numpy(pdf, k, reg, iters, seed, scale):
    us, its = sorted(pdf.user.unique()), sorted(pdf.item.unique())
    q = _init(its, k, seed, scale)
    p = np.zeros((len(us), k))
    ui = {u: x for x, u in enumerate(us)}
    ii = {i: x for x, i in enumerate(its)}
    for _ in range(iters):
        for side in (0, 1):
            keys, other, src = (us, ii, q) if side == 0 else (its, ui, p)
            out = np.zeros((len(keys), k))
            for x, key in enumerate(keys):
                g = pdf[pdf.user == key] if side == 0 else pdf[pdf.item == key]
                o = g.item if side == 0 else g.user
                y = src[[other[v] for v in o]]
                out[x] = np.linalg.solve(y.T @ y + reg * np.eye(k), y.T @ g.rating.to_numpy())
            if side == 0:
                p = out
            else:
                q = out
    return us, its, p, q


@pytest.mark.parametrize("per_block", [500_000, 4])
def test_als_matches_numpy(spark, monkeypatch, per_block):
    monkeypatch.setattr(BL.build_blocks, "__defaults__", (per_block,))        # whole and split keys
    pdf = _data()
    df = spark.createDataFrame(pdf)
    us, its, p, q = _als_numpy(pdf, 3, 0.1, 3, 1, 0.2)
    m = explicit_als(df, k=3, reg=0.1, n_iters=3, seed=1, init_scale=0.2)
    got = dict((u, np.array(v)) for u, v in rows(m.user_factors, "user", "p"))
    assert all(np.allclose(got[u], p[x], atol=1e-8) for x, u in enumerate(us))
    assert FA.normal_equation_residuals(m, df, 0.1).where("residual > 1e-9").count() == 0


def test_blocks_fill_their_partitions_and_routes_are_pages(spark):
    """One block a partition (by hash alone some tasks had several and others none), and routes
    that are lists of ids, not a row for every id and block."""
    from pyspark.sql import functions as F
    df = spark.range(4000).selectExpr("id % 400 AS user", "id % 37 AS item", "CAST(id % 5 AS double) AS rating")
    bm = BL.build_blocks(df, "user", "item", "rating", rows_per_block=200)
    used = bm.cells.select(F.spark_partition_id().alias("p"), "blk").distinct().collect()
    assert len(used) == len({r["p"] for r in used}) == bm.nblk == max(20, spark.sparkContext.defaultParallelism)
    routes = bm.routes.collect()
    assert len(routes) == len({(r["home"], r["blk"]) for r in routes}) <= bm.nblk ** 2
    needed = {(r["blk"], i) for r in routes for i in np.frombuffer(r["ids"], np.int64).tolist()}
    assert needed == {(r["blk"], r["other"]) for r in bm.cells.select("blk", "other").distinct().collect()}
    bm.release()


def test_blocks_split_heavy_key(spark):
    pdf = _data(1)
    df = spark.createDataFrame(pdf)
    bm = BL.build_blocks(df, "user", "item", "rating", rows_per_block=3)   # every user > 3 cells is split
    assert bm.split_keys
    f = spark.createDataFrame([(int(i), [1.0, float(i)]) for i in pdf.item.unique()], "item long, v array<double>")
    got = dict((u, np.array(s)) for u, s in rows(BL.block_product(bm, f, "item", "v"), "user", "s"))
    for u, g in pdf.groupby("user"):
        assert np.allclose(got[u], [g.rating.sum(), (g.rating * g.item).sum()])


def test_svd_recovers_low_rank(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(30, 3)) @ rng.normal(size=(3, 12))
    pdf = pd.DataFrame([(u + 1, i + 1, a[u, i]) for u in range(30) for i in range(12)], columns=["user", "item", "rating"])
    m = truncated_svd(spark.createDataFrame(pdf), k=3, n_iter=2, oversample=3, use_bias=False)
    pred = factor_predict(m, spark.createDataFrame(pdf[["user", "item"]])).toPandas()
    pred = pred.merge(pdf, on=["user", "item"])
    assert np.allclose(pred.score, pred.rating, atol=1e-6)


def test_funksvd_one_block_is_sequential(spark):
    pdf = _data(2)
    df = spark.createDataFrame(pdf)
    k, lr, reg, epochs = 2, 0.01, 0.02, 2
    m = funk_svd(df, n_epochs=epochs, n_factors=k, learning_rate=lr, reg=reg, blocks=1, seed=1)
    us, its = sorted(pdf.user.unique()), sorted(pdf.item.unique())
    pu, qi = _init(us, k, 1, 0.1), _init(its, k, 8, 0.1)
    bu, bi = np.zeros(len(us)), np.zeros(len(its))
    mu = pdf.rating.mean()
    x = pdf.sort_values(["user", "item"])
    for _ in range(epochs):
        for u, i, r in x.itertuples(index=False):
            a, b = us.index(u), its.index(i)
            e = r - (mu + bu[a] + bi[b] + pu[a] @ qi[b])
            bu[a] += lr * (e - reg * bu[a])
            bi[b] += lr * (e - reg * bi[b])
            pa = pu[a].copy()
            pu[a] += lr * (e * qi[b] - reg * pu[a])
            qi[b] += lr * (e * pa - reg * qi[b])
    got = dict((u, (np.array(p), b)) for u, p, b in rows(m.user_factors, "user", "p", "bu"))
    assert all(np.allclose(got[u][0], pu[x]) and np.isclose(got[u][1], bu[x]) for x, u in enumerate(us))


def test_batches_share_no_user_and_no_item():
    rng = np.random.default_rng(4)
    u, i = rng.integers(0, 30, 500), rng.integers(0, 20, 500)
    t = sgd.batch_numbers(u, i)
    for b in range(t.max() + 1):
        at = t == b
        assert len(set(u[at])) == len(set(i[at])) == at.sum()
    for x in (u, i):                                   # a user's or item's ratings keep their order
        for v in set(x):
            assert (np.diff(t[x == v]) > 0).all()


def test_funksvd_model_depends_on_blocks_alone(spark):
    from tastemap.operators.metrics import rmse_mae
    df = spark.createDataFrame(_data(3, 40, 30, 600))
    fits = [funk_svd(d, n_epochs=6, n_factors=3, learning_rate=0.02, blocks=3, trace=True)
            for d in (df, df.repartition(7))]
    a, b = (sorted(rows(m.user_factors, "user", "p", "bu")) for m in fits)
    assert [x[0] for x in a] == [x[0] for x in b] and np.allclose([x[1] for x in a], [x[1] for x in b], atol=1e-12)
    trace = fits[0].params["trace"]
    assert [t[0] for t in trace] == [5, 6] and trace[1][1] < trace[0][1]
    assert np.isclose(rmse_mae(factor_predict(fits[0], df)).first()["rmse"], trace[1][1])


def _toy_model(spark, k=2, link="identity"):
    rng = np.random.default_rng(5)
    uf = spark.createDataFrame([(u, rng.normal(size=k).tolist(), float(rng.normal())) for u in range(1, 9)],
                               "user long, p array<double>, bu double")
    itf = spark.createDataFrame([(i, rng.normal(size=k).tolist(), float(rng.normal())) for i in range(1, 13)],
                                "item long, q array<double>, bi double")
    return FactorModel(uf, itf, k, 0.5, None, link)


@pytest.mark.parametrize("per_block", [20_000, 5, 1])
def test_factor_top_n_matches_brute_force(spark, monkeypatch, per_block):
    monkeypatch.setattr(TN, "ITEMS_PER_BLOCK", per_block)
    m = _toy_model(spark)
    ratings = spark.createDataFrame([(1, 3, 1.0), (1, 5, 1.0), (2, 1, 1.0)], "user long, item long, rating double")
    recs = factor_top_n(m, ratings, 4).toPandas()
    u = m.user_factors.toPandas()
    it = m.item_factors.toPandas()
    for _, ur in u.iterrows():
        rated = {3, 5} if ur.user == 1 else ({1} if ur.user == 2 else set())
        sc = [(-(np.dot(ur.p, ir.q) + ur.bu + ir.bi + 0.5), ir["item"]) for _, ir in it.iterrows() if ir["item"] not in rated]
        assert recs[recs.user == ur.user].sort_values("rank").item.tolist() == [i for _, i in sorted(sc)[:4]]


@pytest.mark.parametrize("per_block", [20_000, 5])
def test_lfm_loss_matches_brute_force(spark, monkeypatch, per_block):
    monkeypatch.setattr(FA, "ITEMS_PER_BLOCK", per_block)
    m = _toy_model(spark, link="sigmoid")
    m = FactorModel(m.user_factors.drop("bu"), m.item_factors.drop("bi"), 2, 0.0, None, "sigmoid")
    ratings = spark.createDataFrame([(1, 3, 1.0), (4, 5, 1.0), (8, 12, 1.0)], "user long, item long, rating double")
    got = lfm_loss(m, ratings, 0.1).first()["loss"]
    P = np.stack(m.user_factors.orderBy("user").toPandas().p)
    Q = np.stack(m.item_factors.orderBy("item").toPandas().q)
    y = np.zeros((8, 12))
    for u, i in [(1, 3), (4, 5), (8, 12)]:
        y[u - 1, i - 1] = 1
    want = np.sum((y - 1 / (1 + np.exp(-(P @ Q.T)))) ** 2) + 0.1 * (np.sum(P ** 2) + np.sum(Q ** 2))
    assert np.isclose(got, want)


def test_registered_fits_see_all_their_ratings_at_the_published_setting(spark, monkeypatch):
    """Served models learn from all ratings, evaluated ones from the training split, each
    call from its own data, with the default number of epochs and blocks."""
    from pyspark.sql import functions as F

    from tastemap.operators.sgd import initial_model
    from tastemap.plans import queries_factor as qf
    sf = "/root/testdata/sf0.001"
    fits = []

    def fit(link):
        def record(data, **kw):
            fits.append((data.count(), kw))
            m = initial_model(data, 4, link=link)
            if link == "identity":
                m.user_factors = m.user_factors.withColumn("bu", F.lit(0.0))
                m.item_factors = m.item_factors.withColumn("bi", F.lit(0.0))
            return m
        return record
    monkeypatch.setattr(qf, "funk_svd", fit("identity"))
    monkeypatch.setattr(qf, "lfm", fit("sigmoid"))
    everything, train = qf.ratings(spark, sf).count(), qf.split(spark, sf)[0].count()
    assert train < everything
    for name, rows in (("funksvd", train), ("funksvd_topn", everything), ("lfm", train), ("lfm_loss", everything),
                       ("eval_funksvd", train), ("funksvd_topn", everything)):
        fn = {"funksvd": qf.funksvd_q, "lfm": qf.lfm_q, "lfm_loss": qf.lfm_loss_q}.get(name) or getattr(qf, name)
        fits.clear()
        fn(spark, sf)
        assert fits == [(rows, {})], name


def test_pieces_of_a_hot_cell_give_the_same_model(spark, monkeypatch):
    """A user with a third of all ratings: no piece above the limit, same factors as whole cells."""
    from pyspark.sql import functions as F
    pdf = _data(6, 30, 200, 300)
    hot = pd.DataFrame([(1, i, 1.0 + i % 5) for i in range(100, 250)], columns=["user", "item", "rating"])
    pdf = pd.concat([pdf[pdf.user != 1], hot])
    df = spark.createDataFrame(pdf)
    fits = []
    for limit in (10**9, 25):
        monkeypatch.setattr(sgd, "CELL_RATINGS", limit)
        fits.append(funk_svd(df, n_epochs=2, n_factors=2, learning_rate=0.05, blocks=2))
    a, b = (sorted(rows(m.user_factors, "user", "p", "bu")) for m in fits)
    assert [x[0] for x in a] == [x[0] for x in b] and np.allclose([x[1] for x in a], [x[1] for x in b], atol=1e-12)
    strata = sgd.store_strata(df.select("user", "item", F.col("rating").alias("y")), 2, F.lit(0).cast("long"), 25)
    sizes = [len(r["y"]) // 8 for r in strata.pieces.collect()]
    assert max(sizes) <= 25 and sum(sizes) == len(pdf) and max(strata.counts.values()) > 1
    monkeypatch.undo()
    assert sgd.blocks_for(1000) == 4 and (10**12 / sgd.blocks_for(10**12) ** 2) <= sgd.CELL_RATINGS


def test_samples_of_several_epochs_are_the_single_ones(spark):
    from tastemap.operators.prep import negative_samples
    df = spark.createDataFrame(_data(7, 12, 40, 90))
    both = rows(negative_samples(df, seeds={0: 5, 3: 9}), "epoch", "user", "item", "label")
    for e, seed in ((0, 5), (3, 9)):
        assert [x[1:] for x in both if x[0] == e] == rows(negative_samples(df, seed=seed), "user", "item", "label")


def test_svd_stops_and_splits_heavy_keys(spark, monkeypatch):
    monkeypatch.setattr(BL.build_blocks, "__defaults__", (7,))                 # keys over several blocks
    pdf = _data(8, 25, 18, 300)
    df = spark.createDataFrame(pdf)
    m = truncated_svd(df, k=3, n_iter=200, oversample=5, use_bias=False, tol=1e-14)
    dense = pdf.pivot(index="user", columns="item", values="rating").fillna(0).to_numpy()
    want = np.linalg.svd(dense, compute_uv=False)[:3]
    assert np.allclose(m.params["singular_values"], want, rtol=1e-8)
    u, s, vt = np.linalg.svd(dense)
    got = factor_predict(m, df).toPandas()
    best = (u[:, :3] * s[:3]) @ vt[:3]
    us, its = sorted(pdf.user.unique()), sorted(pdf.item.unique())
    assert np.allclose(got.score, [best[us.index(a), its.index(b)] for a, b in zip(got.user, got.item)], atol=1e-5)


def test_top_n_skips_most_products_and_keeps_ties(spark, monkeypatch):
    """Skewed item norms, users in few directions: far fewer products than the grid, exact."""
    monkeypatch.setattr(TN, "ITEMS_PER_BLOCK", 20)
    monkeypatch.setattr(TN, "USERS_PER_GROUP", 25)
    rng = np.random.default_rng(11)
    axes = np.eye(4)
    users = [(u, (axes[u % 4] * (1 + u % 3) + rng.normal(0, 0.05, 4)).tolist()) for u in range(200)]
    items = [(i, (axes[i % 4] * 5.0 / (1 + i // 4) ** 0.7 + rng.normal(0, 0.02, 4)).tolist()) for i in range(400)]
    items += [(1000 + i, items[i][1]) for i in range(8)]                       # exact ties: the smaller id first
    m = FactorModel(spark.createDataFrame(users, "user long, p array<double>"),
                    spark.createDataFrame(items, "item long, q array<double>"), 4)
    rated = [(u, i, 1.0) for u in range(0, 200, 3) for i in range(u % 7, 400, 9)] + [(5, i, 1.0) for i in range(400)]
    ratings = spark.createDataFrame(rated, "user long, item long, rating double")
    recs = factor_top_n(m, ratings, 5).toPandas()
    known = {}
    for u, i, _ in rated:
        known.setdefault(u, set()).add(i)
    q = np.array([v for _, v in items])
    for u, p in users:
        s = [(-float(x), i) for (i, _), x in zip(items, np.round(q @ np.array(p), 12)) if i not in known.get(u, ())]
        assert recs[recs.user == u].sort_values("rank").item.tolist() == [i for _, i in sorted(s)[:5]], u
    products = group_states(m, ratings, 5, True).agg({"products": "sum"}).first()[0]
    assert products < 0.4 * len(users) * len(items)


def test_top_n_chunks_take_users_of_like_floors(spark, monkeypatch):
    """A small chunk wants fewer items than all users of a group at once."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(TN, "ITEMS_PER_BLOCK", 20)
    users = spark.createDataFrame([(u, rng.normal(size=3).tolist()) for u in range(200)], "user long, p array<double>")
    items = spark.createDataFrame([(i, (rng.normal(size=3) * (1 + i % 7)).tolist()) for i in range(300)], "item long, q array<double>")
    none = spark.createDataFrame([], "user long, item long, rating double")
    sums = []
    for chunk in (10_000, 2):
        monkeypatch.setattr(TN, "USERS_PER_CHUNK", chunk)
        sums.append(group_states(FactorModel(users, items, 3), none, 5, True).agg({"products": "sum"}).first()[0])
    assert sums[1] < sums[0]
