"""Registered similarity and neighbourhood queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bias as B
from ..operators import serve as S
from ..operators.knn import KnnParams, item_knn_predict, user_knn_predict
from ..operators.similarity import (corated_cosine, item_similarity, self_similarity_check,
                                    user_similarity)
from .common import R_CTE, SPLIT_CTE, bias_ctes, finish, ratings, split
from .queries import register


def norm_ctes(src: str, by: str, name: str) -> str:
    """Per-``by`` demeaned (damping 0) and L2-normalised cells of ``src``: name(user, item, x, norm)."""
    b = f'"{by}"'
    return f"""{name}_D AS (SELECT "user", item,
        rating - sum(rating) OVER (PARTITION BY {b}) / (CAST(0 AS DOUBLE) + count(*) OVER (PARTITION BY {b})) AS x
        FROM {src}),
{name}_N AS (SELECT {b}, sqrt(sum(x * x)) AS n FROM {name}_D GROUP BY {b}),
{name} AS (SELECT "user", item, x / (CASE WHEN n > 0 THEN n ELSE 1.0 END) AS x,
        CASE WHEN n > 0 THEN n ELSE 1.0 END AS norm FROM {name}_D JOIN {name}_N USING ({b}))"""


def item_sim_cte(src: str) -> str:
    return norm_ctes(src, "item", "IX") + """,
ISIM AS (SELECT a.item AS i, b.item AS j, sum(a.x * b.x) AS sim FROM IX a JOIN IX b USING ("user") GROUP BY a.item, b.item)"""


def user_sim_cte(src: str) -> str:
    return norm_ctes(src, "user", "UX") + """,
USIM AS (SELECT a."user" AS u, b."user" AS v, sum(a.x * b.x) AS sim FROM UX a JOIN UX b USING (item) GROUP BY a."user", b."user")"""


# ====================================================================== similarities

@register("item_sim", f"""
WITH {R_CTE}, {item_sim_cte('R')}
SELECT i, j, round(sim, 6) AS sim FROM ISIM WHERE round(sim, 9) > 0.1""")
def item_sim(spark, sf):
    """C1 on R, sim > 0.1."""
    s = item_similarity(ratings(spark, sf), min_sim=0.1)
    return finish(s.where(F.round("sim", 9) > 0.1))


@register("item_sim_popularity", f"""
WITH {R_CTE}, {item_sim_cte('R')},
NRM AS (SELECT DISTINCT item, norm FROM IX)
SELECT i, j, round(sim * pow(na.norm * nb.norm, 0.5), 6) AS sim
FROM ISIM JOIN NRM na ON na.item = i JOIN NRM nb ON nb.item = j
WHERE round(sim * pow(na.norm * nb.norm, 0.5), 9) > 0""")
def item_sim_popularity(spark, sf):
    """Popularity 0.5 (threshold forced to 0)."""
    s = item_similarity(ratings(spark, sf), popularity=0.5)
    return finish(s.where(F.round("sim", 9) > 0))


@register("user_sim", f"""
WITH {R_CTE}, {user_sim_cte('R')}
SELECT u, v, round(sim, 6) AS sim FROM USIM WHERE round(sim, 9) > 0.1""")
def user_sim(spark, sf):
    """C3 on R, sim > 0.1."""
    s = user_similarity(ratings(spark, sf), min_sim=0.1)
    return finish(s.where(F.round("sim", 9) > 0.1))


@register("user_sim_diag", f"""
WITH {R_CTE}, {norm_ctes('R', 'user', 'UX')}
SELECT "user", round(sum(x * x), 6) AS diag FROM UX GROUP BY "user"
HAVING sum(x * x) > 1 + 1e-6 OR sum(x * x) < 1 - 1e-6""")
def user_sim_diag(spark, sf):
    """C4: users whose self-similarity is not 1 (constant raters)."""
    return finish(self_similarity_check(ratings(spark, sf), "user"))


@register("user_sim_diag_constant", f"""
WITH {R_CTE}, I AS (SELECT "user", item, CASE WHEN "user" % 2 = 0 THEN 1.0::DOUBLE ELSE rating END AS rating FROM R),
{norm_ctes('I', 'user', 'UX')}
SELECT "user", round(sum(x * x), 6) AS diag FROM UX GROUP BY "user"
HAVING sum(x * x) > 1 + 1e-6 OR sum(x * x) < 1 - 1e-6""")
def user_sim_diag_constant(spark, sf):
    """C4 where constant raters exist: even user ids keep only the fact that they rated."""
    r = ratings(spark, sf).withColumn(
        "rating", F.when(F.col("user") % 2 == 0, F.lit(1.0)).otherwise(F.col("rating")))
    return finish(self_similarity_check(r, "user"))


@register("corated_cosine", f"""
WITH {R_CTE},
P AS (SELECT a."user" AS a, b."user" AS b, sum(a.rating * b.rating) AS xy, sum(a.rating * a.rating) AS xx,
             sum(b.rating * b.rating) AS yy, count(*) AS n
      FROM R a JOIN R b USING (item) WHERE a."user" <> b."user" GROUP BY a."user", b."user")
SELECT a, b, round(xy / sqrt(xx * yy), 6) AS sim FROM P WHERE n >= 2
UNION ALL SELECT DISTINCT "user", "user", 1.0 FROM R""")
def corated_cosine_q(spark, sf):
    """User-user cosine over co-rated items, minimum support 2, diagonal 1."""
    return finish(corated_cosine(ratings(spark, sf), "user", min_support=2).select("a", "b", "sim"))


# ====================================================================== kNN predictors

def _knn_sql(kind: str, thr: float | None, inclusive: bool, denom: str, min_nn: int, max_nn: int,
             bias: bool, popularity: float = 0.0, extra_ctes: str = "", tail: str | None = None) -> str:
    """kNN scores of the test pairs (TE) from the training split (TR).  ``tail``
    replaces the final SELECT (it can read CTE A: u, t, n, num, den, own)."""
    if kind == "user":
        sim_cte = user_sim_cte("TR")
        cand = """C AS (SELECT REQ.u, REQ.t, TR."user" AS nb, TR.rating AS r FROM REQ JOIN TR ON TR.item = REQ.t)"""
        simj = "USIM ON USIM.u = C.u AND USIM.v = C.nb"
        bias_join = ('LEFT JOIN BU bn ON bn."user" = K.nb LEFT JOIN BU bo ON bo."user" = K.u', "bn.bu", "bo.bu")
        sim_expr = "USIM.sim"
    else:
        sim_cte = item_sim_cte("TR")
        if popularity > 0:
            sim_cte += f""",
NRM AS (SELECT DISTINCT item, norm FROM IX),
PSIM AS (SELECT i, j, sim * pow(na.norm * nb.norm, {popularity}) AS sim
         FROM ISIM JOIN NRM na ON na.item = i JOIN NRM nb ON nb.item = j)"""
        cand = """C AS (SELECT REQ.u, REQ.t, TR.item AS nb, TR.rating AS r FROM REQ JOIN TR ON TR."user" = REQ.u)"""
        src = "PSIM" if popularity > 0 else "ISIM"
        simj = f"{src} ON {src}.i = C.t AND {src}.j = C.nb"
        bias_join = ("LEFT JOIN BI bn ON bn.item = K.nb LEFT JOIN BI bo ON bo.item = K.t", "bn.bi", "bo.bi")
        sim_expr = f"{src}.sim"
    if popularity > 0:
        thr, inclusive = 0.0, False
    all_nb = ((0.0 if thr is None else thr) <= 0) if inclusive else (thr is None or thr < 0)
    if all_nb:
        j = f"SELECT C.*, coalesce({sim_expr}, 0.0) AS sim FROM C LEFT JOIN {simj}"
    else:
        j = f"SELECT C.*, {sim_expr} AS sim FROM C JOIN {simj}"
    if inclusive:
        cond = f"round(sim, 9) >= {0.0 if thr is None else thr}"
    elif thr is not None:
        cond = f"round(sim, 9) > {thr}"
    else:
        cond = "TRUE"
    nbb, own = (bias_join[1], bias_join[2]) if bias else ("0.0", "0.0")
    joins = bias_join[0] if bias else ""
    den = "abs(sim)" if denom == "abs" else "sim"
    bias_sql = (bias_ctes("TR") + ",") if (bias or extra_ctes) else ""
    final = tail or f"""SELECT TE."user", TE.item, TE.rating,
       CASE WHEN n >= {min_nn} AND den > 0 THEN round(own + num / den, 6) END AS score
FROM TE LEFT JOIN A ON A.u = TE."user" AND A.t = TE.item"""
    return f"""
WITH {R_CTE}, {SPLIT_CTE}, {bias_sql} {sim_cte},
REQ AS (SELECT DISTINCT "user" AS u, item AS t FROM TE),
{cand},
J AS ({j}),
F AS (SELECT * FROM J WHERE {cond}),
K AS (SELECT *, row_number() OVER (PARTITION BY u, t ORDER BY round(sim, 9) DESC, nb) AS rk FROM F),
A AS (SELECT u, t, count(*) AS n, sum((r - {nbb}) * sim) AS num, sum({den}) AS den, max({own}) AS own
      FROM K {joins} WHERE rk <= {max_nn} GROUP BY u, t){extra_ctes}
{final}"""


USER_KNN = KnnParams(min_nn=2, max_nn=20, min_threshold=0.1)
USER_KNN_INCL = KnnParams(min_nn=1, max_nn=20, min_threshold=None, inclusive=True)
KNN_ABS = KnnParams(min_nn=1, max_nn=20, min_threshold=None, denominator="abs")
ITEM_KNN = KnnParams(min_nn=1, max_nn=20, min_threshold=0.1)
ITEM_KNN_BIAS = KnnParams(min_nn=2, max_nn=30, min_threshold=0.05)
ITEM_KNN_POP = KnnParams(min_nn=1, max_nn=20)


@register("user_knn", _knn_sql("user", 0.1, False, "sum", 2, 20, True))
def user_knn(spark, sf):
    """User-kNN with user bias, sim > 0.1, 2..20 neighbours, on test pairs."""
    train, test = split(spark, sf)
    model = B.bias_fit(train)
    return finish(user_knn_predict(train, test, USER_KNN, user_bias=model.user_bias))


@register("user_knn_threshold", _knn_sql("user", 0.5, True, "sum", 1, 20, False))
def user_knn_threshold(spark, sf):
    """P5 at a positive threshold that some similarities equal: sim >= 0.5 takes them in."""
    train, test = split(spark, sf)
    return finish(user_knn_predict(train, test, KnnParams(min_nn=1, max_nn=20, min_threshold=0.5, inclusive=True)))


@register("user_knn_inclusive", _knn_sql("user", None, True, "sum", 1, 20, False))
def user_knn_inclusive(spark, sf):
    """P5: unbiased user-kNN, sim >= 0 (zero sims take part), 1..20 neighbours."""
    train, test = split(spark, sf)
    return finish(user_knn_predict(train, test, USER_KNN_INCL))


@register("knn_abs", _knn_sql("user", None, False, "abs", 1, 20, False))
def knn_abs(spark, sf):
    """Weighted average with Σ|s| as denominator, all raters take part."""
    train, test = split(spark, sf)
    return finish(user_knn_predict(train, test, KNN_ABS))


@register("item_knn", _knn_sql("item", 0.1, False, "sum", 1, 20, False))
def item_knn(spark, sf):
    """Item-kNN, sim > 0.1, 1..20 neighbours, no bias."""
    train, test = split(spark, sf)
    return finish(item_knn_predict(train, test, ITEM_KNN))


@register("item_knn_bias", _knn_sql("item", 0.05, False, "sum", 2, 30, True))
def item_knn_bias(spark, sf):
    """P7 with item bias, sim > 0.05, 2..30 neighbours."""
    train, test = split(spark, sf)
    model = B.bias_fit(train)
    return finish(item_knn_predict(train, test, ITEM_KNN_BIAS, item_bias=model.item_bias))


@register("item_knn_popularity", _knn_sql("item", None, False, "sum", 1, 20, False, popularity=0.5))
def item_knn_popularity(spark, sf):
    """P7 + C2: popularity-scaled sims (p = 0.5), threshold forced to 0."""
    train, test = split(spark, sf)
    return finish(item_knn_predict(train, test, ITEM_KNN_POP, popularity=0.5))


# ====================================================================== P15

_COMBINED_SQL = _knn_sql("item", 0.1, False, "sum", 1, 20, False, extra_ctes=""",
KS AS (SELECT TE."user", TE.item, CASE WHEN n >= 1 AND den > 0 THEN own + num / den END AS score
        FROM TE LEFT JOIN A ON A.u = TE."user" AND A.t = TE.item),
BS AS (SELECT TE."user", TE.item, mu + bu + bi AS score
       FROM TE LEFT JOIN BU USING ("user") LEFT JOIN BI USING (item) CROSS JOIN MU),
U AS (SELECT * FROM KS UNION ALL SELECT * FROM BS)""", tail="""SELECT "user", item,
       round(sum(score) / sum(CASE WHEN score IS NOT NULL THEN 1.0 END), 6) AS score
FROM U GROUP BY "user", item""")


@register("combined_mean", _COMBINED_SQL)
def combined_mean(spark, sf):
    """Mean of the bias and item-kNN scores per test pair, missing ignored."""
    train, test = split(spark, sf)
    pairs = test.select("user", "item")
    bias_scores = B.bias_predict(B.bias_fit(train), pairs)
    knn_scores = item_knn_predict(train, pairs, ITEM_KNN)
    return finish(S.combine_scores([knn_scores, bias_scores]))
