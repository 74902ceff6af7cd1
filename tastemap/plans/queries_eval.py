"""Registered evaluation and recommend-all queries."""

from __future__ import annotations

from ..operators import bias as B
from ..operators import metrics as M
from ..operators import serve as S
from ..operators.knn import item_knn_predict, item_knn_recommend, user_knn_predict, user_knn_recommend
from ..operators.serve import attach_metadata
from ..session import cut_lineage
from ..sources.tables import items_meta
from .common import R_CTE, SPLIT_CTE, bias_ctes, finish, ratings, split
from .queries import TOP_N, register
from .queries_knn import ITEM_KNN, USER_KNN, _knn_sql, item_sim_cte, user_sim_cte

REL = 2.5  # relevance threshold used by the registered metric queries

_BIAS_TEST = f"""WITH {R_CTE}, {SPLIT_CTE}, {bias_ctes('TR')},
P AS (SELECT TE."user", TE.item, TE.rating, mu + bu + bi AS score
      FROM TE LEFT JOIN BU USING ("user") LEFT JOIN BI USING (item) CROSS JOIN MU)"""

_BIAS_RECS = f"""WITH {R_CTE}, {SPLIT_CTE}, {bias_ctes('TR')},
U AS (SELECT DISTINCT "user" FROM TR),
C AS (SELECT U."user", BI.item, BI.bi FROM U CROSS JOIN BI
      WHERE NOT EXISTS (SELECT 1 FROM TR WHERE TR."user" = U."user" AND TR.item = BI.item)),
K AS (SELECT "user", item, row_number() OVER (PARTITION BY "user" ORDER BY bi DESC, item) AS rk FROM C),
REC AS (SELECT "user", item FROM K WHERE rk <= {TOP_N})"""

_RMSE = """round(sqrt(avg((score - rating) * (score - rating))), 6) AS rmse,
       round(avg(abs(score - rating)), 6) AS mae, count(score - rating) AS n_scored, count(*) AS n"""

_POOLED = f"""REL AS (SELECT DISTINCT "user", item FROM TE WHERE rating > {REL}
              AND "user" IN (SELECT "user" FROM REC)),
H AS (SELECT count(*) AS hits FROM REC JOIN REL USING ("user", item)),
NR AS (SELECT count(*) AS n_recommended FROM (SELECT DISTINCT "user", item FROM REC)),
NL AS (SELECT count(*) AS n_relevant FROM REL)"""

_POOLED_SELECT = """hits, n_recommended, n_relevant,
       round(CASE WHEN n_recommended > 0 THEN hits / CAST(n_recommended AS DOUBLE) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN n_relevant > 0 THEN hits / CAST(n_relevant AS DOUBLE) ELSE 0.0 END, 6) AS recall"""


def _bias_test(spark, sf):
    train, test = split(spark, sf)
    return train, test, B.bias_predict(B.bias_fit(train), test)


def _bias_recs(spark, sf):
    train, test = split(spark, sf)
    return train, test, S.bias_top_n_unrated(B.bias_fit(train), train, TOP_N)


@register("rmse_mae", f"{_BIAS_TEST}\nSELECT {_RMSE} FROM P")
def rmse_mae(spark, sf):
    """M1, M2: bias model, held-out pairs, missing predictions skipped."""
    _, _, pred = _bias_test(spark, sf)
    return finish(M.rmse_mae(pred))


@register("rmse_mae_filled", _knn_sql("item", 0.1, False, "sum", 1, 20, False, extra_ctes=""",
P0 AS (SELECT TE.rating, CASE WHEN n >= 1 AND den > 0 THEN own + num / den END AS score
       FROM TE LEFT JOIN A ON A.u = TE."user" AND A.t = TE.item),
P AS (SELECT rating, coalesce(score, (SELECT avg(score) FROM P0)) AS score FROM P0)""",
                                          tail=f"SELECT {_RMSE} FROM P"))
def rmse_mae_filled(spark, sf):
    """M1, M2 with ignore_na=False: missing item-kNN scores take the mean score."""
    train, test = split(spark, sf)
    return finish(M.rmse_mae(item_knn_predict(train, test, ITEM_KNN), ignore_na=False))


@register("prec_recall_at_k", f"""{_BIAS_TEST},
REC AS (SELECT "user", item FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY round(score, 6) DESC, item) AS rk
        FROM P WHERE round(score, 6) > {REL}) WHERE rk <= 10),
FL AS (SELECT P."user", P.rating > {REL} AS rel, REC.item IS NOT NULL AS rec FROM P LEFT JOIN REC USING ("user", item)),
AG AS (SELECT "user", sum(CASE WHEN rel THEN 1 ELSE 0 END) AS n_rel, sum(CASE WHEN rec THEN 1 ELSE 0 END) AS n_rec,
              sum(CASE WHEN rel AND rec THEN 1 ELSE 0 END) AS n_hit FROM FL GROUP BY "user")
SELECT "user",
       round(CASE WHEN n_rec > 0 THEN n_hit / CAST(n_rec AS DOUBLE) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN n_rel > 0 THEN n_hit / CAST(n_rel AS DOUBLE) ELSE 0.0 END, 6) AS recall FROM AG""")
def prec_recall_at_k(spark, sf):
    """M3 per user, k = 10, relevance threshold 2.5, bias scores of the test pairs."""
    _, _, pred = _bias_test(spark, sf)
    return finish(M.precision_recall_at_k(finish(pred), 10, REL))


@register("pooled_precision_recall", f"""{_BIAS_RECS}, {_POOLED}
SELECT {_POOLED_SELECT} FROM H, NR, NL""")
def pooled_precision_recall(spark, sf):
    """M4, M5: bias top-10 unrated vs the held-out pairs rated above 2.5."""
    _, test, recs = _bias_recs(spark, sf)
    return finish(M.pooled_precision_recall(recs, test, REL))


@register("coverage", f"""{_BIAS_RECS}
SELECT count(DISTINCT item) AS n_recommended_items, (SELECT count(DISTINCT item) FROM TR) AS n_items,
       round(count(DISTINCT item) / CAST((SELECT count(DISTINCT item) FROM TR) AS DOUBLE), 6) AS coverage FROM REC""")
def coverage(spark, sf):
    """M6: share of the training catalogue that appears in the bias top-10 lists."""
    train, _, recs = _bias_recs(spark, sf)
    return finish(M.coverage(recs, train))


@register("popularity", f"""{_BIAS_RECS},
POP AS (SELECT item, count(*) AS pop FROM TR GROUP BY item)
SELECT round(avg(ln(1 + CAST(coalesce(pop, 0) AS DOUBLE))), 6) AS popularity FROM REC LEFT JOIN POP USING (item)""")
def popularity(spark, sf):
    """M7: mean ln(1 + training popularity) of the recommended items."""
    train, _, recs = _bias_recs(spark, sf)
    return finish(M.mean_popularity(recs, train))


@register("train_fit_error", f"""WITH {R_CTE}, {bias_ctes('R')},
P AS (SELECT rating, mu + bu + bi AS score FROM R JOIN BU USING ("user") JOIN BI USING (item) CROSS JOIN MU)
SELECT {_RMSE} FROM P""")
def train_fit_error(spark, sf):
    """M8: fit error of the bias model on its own (observed) training cells."""
    r = ratings(spark, sf)
    return finish(M.rmse_mae(B.bias_predict(B.bias_fit(r), r)))


@register("eval_predictor", _knn_sql("user", 0.1, False, "sum", 2, 20, True, extra_ctes=""",
P AS (SELECT TE.rating, CASE WHEN n >= 2 AND den > 0 THEN own + num / den END AS score
      FROM TE LEFT JOIN A ON A.u = TE."user" AND A.t = TE.item)""", tail=f"SELECT {_RMSE} FROM P"))
def eval_predictor(spark, sf):
    """M9: held-out RMSE / MAE of user-kNN (with bias), unscored pairs skipped."""
    train, test = split(spark, sf)
    model = B.bias_fit(train)
    return finish(M.rmse_mae(user_knn_predict(train, test, USER_KNN, user_bias=model.user_bias)))


_ITEM_RECS = f"""WITH {R_CTE}, {SPLIT_CTE}, {item_sim_cte('TR')},
SIMT AS (SELECT * FROM ISIM WHERE round(sim, 9) > 0.1 AND i <> j),
C AS (SELECT TR."user" AS u, SIMT.i AS t, TR.item AS nb, TR.rating AS r, SIMT.sim FROM TR JOIN SIMT ON SIMT.j = TR.item),
C2 AS (SELECT * FROM C WHERE NOT EXISTS (SELECT 1 FROM TR WHERE TR."user" = C.u AND TR.item = C.t)),
K AS (SELECT *, row_number() OVER (PARTITION BY u, t ORDER BY round(sim, 9) DESC, nb) AS rk FROM C2),
A AS (SELECT u, t, count(*) AS n, sum((r - 0.0) * sim) AS num, sum(sim) AS den FROM K WHERE rk <= 20 GROUP BY u, t),
SC AS (SELECT u, t, 0.0 + num / den AS score FROM A WHERE n >= 1 AND den > 0),
TK AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY round(score, 6) DESC, t) AS rank FROM SC),
RECS AS (SELECT u AS "user", rank, t AS item, score FROM TK WHERE rank <= {TOP_N})"""


@register("recommend_all", f"""{_ITEM_RECS}
SELECT "user", CAST(rank AS INTEGER) AS rank, item, round(score, 6) AS score FROM RECS""")
def recommend_all(spark, sf):
    """Item-kNN (sim > 0.1, up to 20 neighbours) top-10 unrated for every user,
    candidates reached through similarities only."""
    train, _ = split(spark, sf)
    return finish(item_knn_recommend(train, TOP_N, ITEM_KNN, score_digits=6))


_USER_RECS = f"""WITH {R_CTE}, {SPLIT_CTE}, {user_sim_cte('TR')},
SIMT AS (SELECT * FROM USIM WHERE round(sim, 9) > 0.1 AND u <> v),
C AS (SELECT SIMT.u, TR.item AS t, SIMT.v AS nb, TR.rating AS r, SIMT.sim FROM SIMT JOIN TR ON TR."user" = SIMT.v),
C2 AS (SELECT * FROM C WHERE NOT EXISTS (SELECT 1 FROM TR WHERE TR."user" = C.u AND TR.item = C.t)),
K AS (SELECT *, row_number() OVER (PARTITION BY u, t ORDER BY round(sim, 9) DESC, nb) AS rk FROM C2),
A AS (SELECT u, t, count(*) AS n, sum(r * sim) AS num, sum(sim) AS den FROM K WHERE rk <= 20 GROUP BY u, t),
SC AS (SELECT u, t, round(num / den, 6) AS score FROM A WHERE n >= 2 AND den > 0),
TK AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, t) AS rank FROM SC)"""


@register("recommend_all_user", f"""{_USER_RECS}
SELECT u AS "user", CAST(rank AS INTEGER) AS rank, t AS item, score, p_name
FROM TK LEFT JOIN part ON p_partkey = t WHERE rank <= {TOP_N}""")
def recommend_all_user(spark, sf):
    """R7 + R5: user-kNN top-10 unrated for every user with part names."""
    train, _ = split(spark, sf)
    recs = user_knn_recommend(train, TOP_N, USER_KNN, score_digits=6)
    return finish(attach_metadata(recs, items_meta(spark, sf).select("item", "p_name")))


@register("eval_recommender", f"""{_ITEM_RECS},
REC AS (SELECT "user", item FROM RECS), {_POOLED}
SELECT {_POOLED_SELECT}, (SELECT count(DISTINCT item) FROM REC) AS n_recommended_items,
       (SELECT count(DISTINCT item) FROM TR) AS n_items,
       round((SELECT count(DISTINCT item) FROM REC) / CAST((SELECT count(DISTINCT item) FROM TR) AS DOUBLE), 6) AS coverage
FROM H, NR, NL""")
def eval_recommender(spark, sf):
    """Precision, recall (threshold 2.5) and coverage of the item-kNN top-10."""
    train, test = split(spark, sf)
    recs = cut_lineage(item_knn_recommend(train, TOP_N, ITEM_KNN, score_digits=6))    # read by two metrics
    pr = M.pooled_precision_recall(recs, test, REL)
    cov = M.coverage(recs, train)
    return finish(pr.crossJoin(cov))
