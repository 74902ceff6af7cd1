import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from tastemap.operators import bias as B
from tastemap.operators import serve as S


def _bias_numpy(pdf, ud=10, idp=25):
    mu = pdf.rating.mean()
    bi = pdf.groupby("item").rating.apply(lambda v: (v - mu).sum() / (idp + len(v)))
    x = pdf.assign(e=pdf.rating - mu - pdf.item.map(bi))
    bu = x.groupby("user").e.apply(lambda v: v.sum() / (ud + len(v)))
    return mu, bi, bu


def test_bias_fit_matches_numpy(spark, ratings_df):
    m = B.bias_fit(ratings_df)
    mu, bi, bu = _bias_numpy(ratings_df.toPandas())
    assert np.isclose(m.mu, mu)
    got_bi = dict(rows(m.item_bias, "item", "bi"))
    got_bu = dict(rows(m.user_bias, "user", "bu"))
    assert all(np.isclose(got_bi[k], v) for k, v in bi.items())
    assert all(np.isclose(got_bu[k], v) for k, v in bu.items())


def test_bias_predict_unknown_null_and_residual(spark, ratings_df):
    m = B.bias_fit(ratings_df)
    pairs = spark.createDataFrame([(1, 10), (1, 99), (99, 10)], "user long, item long")
    got = {(u, i): s for u, i, s in rows(B.bias_predict(m, pairs), "user", "item", "score")}
    assert got[(1, 99)] is None and got[(99, 10)] is None and got[(1, 10)] is not None
    res = B.bias_residuals(m, ratings_df).join(B.bias_predict(m, ratings_df), ["user", "item"])
    back = res.select(F.max(F.abs(F.col("residual") + F.col("score") - F.col("rating")))).first()[0]
    assert back < 1e-12


def test_bias_switches(spark, ratings_df):
    m = B.bias_fit(ratings_df, user_bias=False, item_bias=False)
    assert all(v == 0.0 for _, v in rows(m.user_bias, "user", "bu"))
    assert all(v == 0.0 for _, v in rows(m.item_bias, "item", "bi"))


def test_known_score(spark, ratings_df):
    pairs = spark.createDataFrame([(1, 10), (1, 40)], "user long, item long")
    assert rows(B.known_score(ratings_df, pairs), "user", "item", "score") == [(1, 10, 5.0), (1, 40, None)]


def test_bias_top_n_unrated_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    data = {(int(u), int(i)): float(rng.integers(1, 6)) for u, i in zip(rng.integers(0, 30, 400), rng.integers(0, 50, 400))}
    df = spark.createDataFrame([(u, i, r) for (u, i), r in data.items()], "user long, item long, rating double")
    m = B.bias_fit(df)
    got = S.bias_top_n_unrated(m, df, 5).toPandas()
    mu, bi, bu = _bias_numpy(df.toPandas())
    rated = df.toPandas().groupby("user").item.apply(set)
    for u in rated.index:
        cand = sorted((-bi[i], i) for i in bi.index if i not in rated[u])[:5]
        want = [i for _, i in cand]
        have = got[got.user == u].sort_values("rank").item.tolist()
        assert have == want
        assert np.allclose(got[got.user == u].sort_values("rank").score, [mu + bu[u] + bi[i] for i in want])


def test_top_k_per_group_and_rated(spark, ratings_df):
    t = S.top_k_per_group(ratings_df, ["user"], [F.col("rating").desc(), F.col("item").asc()], 2)
    assert rows(t.where("user = 3"), "item", "rank") == [(10, 1), (20, 2)]   # ties: smaller id first
    rated = S.bias_top_n_rated(B.bias_fit(ratings_df), ratings_df, 10)
    assert rated.count() == ratings_df.count()


def test_selectors(spark, ratings_df):
    cand = spark.createDataFrame([(1, 10), (1, 40), (1, 77), (1, 40)], "user long, item long")
    items = ratings_df.select("item").distinct()
    restricted = S.restrict_candidates(cand, items)
    assert rows(restricted, "user", "item") == [(1, 10), (1, 40)]         # unknown 77 vanishes
    assert rows(S.select_unrated(ratings_df, restricted), "item") == [(40,)]
    assert rows(S.select_rated(ratings_df, restricted), "item") == [(10,)]


def test_combine_scores_ignores_missing(spark):
    a = spark.createDataFrame([(1, 1, 2.0), (1, 2, None)], "user long, item long, score double")
    b = spark.createDataFrame([(1, 1, 4.0), (1, 2, 3.0)], "user long, item long, score double")
    assert rows(S.combine_scores([a, b]), "user", "item", "score") == [(1, 1, 3.0), (1, 2, 3.0)]


def test_generic_recommend(spark, ratings_df):
    m = B.bias_fit(ratings_df)
    cand = spark.createDataFrame([(1, 10), (1, 40), (1, 99), (2, 40), (2, 10)], "user long, item long")
    meta = spark.createDataFrame([(40, "forty")], "item long, name string")
    out = S.recommend(lambda pairs: B.bias_predict(m, pairs), ratings_df, cand, 5,
                      selector="unrated", items=ratings_df.select("item"), mapping=meta)
    assert rows(out, "user", "item", "rank", "name") == [(1, 40, 1, "forty")]
    rated = S.recommend(lambda pairs: B.bias_predict(m, pairs), ratings_df, cand, 1, selector="rated")
    assert rows(rated, "user", "rank") == [(1, 1), (2, 1)]
