"""Registered factor-model and click-model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import portable_init, unit_draw
from ..operators.factor import (als_half_step, als_wr, explicit_als, factor_predict,
                                normal_equation_residuals, truncated_svd)
from ..operators.fm import INTERCEPT, FmModel, category_slots, fm_fit, fm_predict, offset_slots, one_hot_slots
from ..operators.fm_ctr import gbdt_lr_fit
from ..operators.topn import factor_top_n
from ..operators.trees import boosted_trees_fit
from ..operators.bias import bias_fit
from ..operators.metrics import fit_error, rmse_mae
from ..operators.serve import attach_metadata
from ..operators.sgd import funk_svd, initial_model, lfm, lfm_loss
from ..sources.tables import items_meta, read_table
from .common import R_CTE, SPLIT_CTE, bias_ctes, finish, materialized, ratings, split
from .queries import TOP_N, register

ALS_REG = 0.1
INIT_SCALE = 0.1


def _init_sql(id_expr: str, f, seed: int = 1, scale: float = INIT_SCALE) -> str:
    """The same normal value as functions.expr.portable_init."""
    h = f"md5({id_expr} || ':{f}:{seed}')" if isinstance(f, int) else f"md5({id_expr} || ':' || {f} || ':{seed}')"
    word = lambda at: f"CAST(('0x' || substr({h}, {at}, 8)) AS BIGINT)"
    return (f"(sqrt(-2.0 * ln(({word(1)} + 1) / CAST(4294967296 AS DOUBLE)))"
            f" * cos(2.0 * pi() * ({word(9)} / CAST(4294967296 AS DOUBLE))) * CAST({scale} AS DOUBLE))")


def _vectors_sql(src: str, k: int, scale: float) -> str:
    """P("user", p) and Q(item, q): the untrained factors of all users and items."""
    vec = lambda col, seed: f"list_transform(range({k}), lambda f: {_init_sql(col, 'f', seed, scale)})"
    return f"""P AS MATERIALIZED (SELECT "user", {vec('"user"', 1)} AS p FROM (SELECT DISTINCT "user" FROM {src})),
Q AS MATERIALIZED (SELECT item, {vec('item', 8)} AS q FROM (SELECT DISTINCT item FROM {src}))"""


def _als_k1_ctes(src: str) -> str:
    return f"""Q0 AS MATERIALIZED (SELECT item, {_init_sql('item', 0)} AS q FROM (SELECT DISTINCT item FROM {src})),
P1 AS (SELECT "user", sum(q * rating) / (sum(q * q) + {ALS_REG}) AS p FROM {src} JOIN Q0 USING (item) GROUP BY "user"),
Q1 AS (SELECT item, sum(p * rating) / (sum(p * p) + {ALS_REG}) AS q FROM {src} JOIN P1 USING ("user") GROUP BY item),
P2 AS (SELECT "user", sum(q * rating) / (sum(q * q) + {ALS_REG}) AS p FROM {src} JOIN Q1 USING (item) GROUP BY "user"),
Q2 AS (SELECT item, sum(p * rating) / (sum(p * p) + {ALS_REG}) AS q FROM {src} JOIN P2 USING ("user") GROUP BY item)"""


@register("als_half_step", f"""WITH {R_CTE},
Q0 AS MATERIALIZED (SELECT item, {_init_sql('item', 0)} AS q0, {_init_sql('item', 1)} AS q1 FROM (SELECT DISTINCT item FROM R)),
S AS (SELECT "user", sum(q0 * q0) + {ALS_REG} AS a, sum(q0 * q1) AS b, sum(q1 * q1) + {ALS_REG} AS d,
             sum(q0 * rating) AS e, sum(q1 * rating) AS f FROM R JOIN Q0 USING (item) GROUP BY "user")
SELECT "user", round((d * e - b * f) / (a * d - b * b), 6) AS f0, round((a * f - b * e) / (a * d - b * b), 6) AS f1
FROM S""")
def als_half_step_q(spark, sf):
    """P9 building block: one user half-step, k = 2, against the portable item init."""
    r = ratings(spark, sf)
    q = r.select("item").distinct().select("item", portable_init(F.col("item"), 2, 1, INIT_SCALE).alias("f"))
    p = als_half_step(r, q, 2, ALS_REG)
    return finish(p.select("user", F.col("f")[0].alias("f0"), F.col("f")[1].alias("f1")))


@register("als_k1", f"""WITH {R_CTE}, {_als_k1_ctes('R')}
SELECT 'user' AS side, "user" AS id, round(p, 6) AS f0 FROM P2
UNION ALL SELECT 'item', item, round(q, 6) FROM Q2""")
def als_k1(spark, sf):
    """Explicit ALS, k = 1, two iterations: p = Σqr / (Σq² + λ)."""
    m = explicit_als(ratings(spark, sf), k=1, reg=ALS_REG, n_iters=2, seed=1, init_scale=INIT_SCALE)
    u = m.user_factors.select(F.lit("user").alias("side"), F.col("user").alias("id"), F.col("p")[0].alias("f0"))
    i = m.item_factors.select(F.lit("item").alias("side"), F.col("item").alias("id"), F.col("q")[0].alias("f0"))
    return finish(u.unionByName(i))


@register("als_biased_k1", f"""WITH {materialized(f"{R_CTE}, {SPLIT_CTE}, {bias_ctes('TR')}")},
RES AS MATERIALIZED (SELECT "user", item, rating - (SELECT mu FROM MU) - bi - bu AS rating FROM TR JOIN BI USING (item) JOIN BU USING ("user")),
{_als_k1_ctes('RES')},
UF AS (SELECT "user", p, bu FROM BU LEFT JOIN P2 USING ("user")), IFA AS (SELECT item, q, bi FROM BI LEFT JOIN Q2 USING (item))
SELECT TE."user", TE.item, TE.rating, round(p * q + (SELECT mu FROM MU) + bu + bi, 6) AS score
FROM TE LEFT JOIN UF USING ("user") LEFT JOIN IFA USING (item)""")
def als_biased_k1(spark, sf):
    """P10 + P18: ALS (k = 1, two iterations) on bias residuals of the training
    split; test score = mu + b_u + b_i + p·q, bias added once."""
    train, test = split(spark, sf)
    m = explicit_als(train, k=1, reg=ALS_REG, n_iters=2, seed=1, init_scale=INIT_SCALE, use_bias=True)
    return finish(factor_predict(m, test))


# ------------------------------------------------------------------ untrained factors (same numbers in SQL)

START_K = 10


@register("factor_scores", f"""WITH {R_CTE}, {SPLIT_CTE}, {_vectors_sql('TR', START_K, 1.0)}
SELECT TE."user", TE.item, TE.rating, round(list_inner_product(p, q), 6) AS score
FROM TE LEFT JOIN P USING ("user") LEFT JOIN Q USING (item)""")
def factor_scores(spark, sf):
    """p·q of the held-out pairs for known factors (the md5-drawn start, k = 10)."""
    train, test = split(spark, sf)
    return finish(factor_predict(initial_model(train, START_K), test))


@register("factor_topn", f"""WITH {R_CTE}, {_vectors_sql('R', START_K, 1.0)},
G AS (SELECT "user", item, list_inner_product(p, q) AS score FROM P CROSS JOIN Q),
K AS (SELECT G.*, row_number() OVER (PARTITION BY G."user" ORDER BY score DESC, item) AS rk FROM G ANTI JOIN R USING ("user", item))
SELECT "user", CAST(rk AS INTEGER) AS rank, K.item, round(score, 6) AS score, p_name
FROM K LEFT JOIN part ON p_partkey = K.item WHERE rk <= {TOP_N}""")
def factor_topn(spark, sf):
    """R7 + R5 for factor models: top-10 unrated items of every user with names, known factors."""
    r = ratings(spark, sf)
    recs = factor_top_n(initial_model(r, START_K), r, TOP_N)
    return finish(attach_metadata(recs, items_meta(spark, sf).select("item", "p_name")))


@register("lfm_loss_known", f"""WITH {R_CTE}, {_vectors_sql('R', START_K, 0.3)},
G AS (SELECT "user", item, 1.0 / (1.0 + exp(-list_inner_product(p, q))) AS s FROM P CROSS JOIN Q),
E AS (SELECT sum((CASE WHEN R.item IS NULL THEN 0 ELSE 1 END - s) * (CASE WHEN R.item IS NULL THEN 0 ELSE 1 END - s)) AS e
      FROM G LEFT JOIN R USING ("user", item)),
N AS (SELECT (SELECT sum(list_inner_product(p, p)) FROM P) + (SELECT sum(list_inner_product(q, q)) FROM Q) AS n)
SELECT round(e + CAST(0.1 AS DOUBLE) * n, 4) AS loss FROM E, N""")
def lfm_loss_known(spark, sf):
    """Full-grid loss of known factors."""
    r = ratings(spark, sf)
    return finish(lfm_loss(initial_model(r, START_K, scale=0.3, link="sigmoid"), r, 0.1).select("loss"), 4)


STEP_LR, STEP_REG = 0.05, 0.02


@register("funksvd_step", f"""WITH {R_CTE},
A AS (SELECT "user", min(item) AS item FROM R GROUP BY "user"),
ONE AS (SELECT min("user") AS "user", item FROM A GROUP BY item),
D AS (SELECT "user", item, rating FROM ONE JOIN R USING ("user", item)),
MU AS (SELECT avg(rating) AS mu FROM D), {_vectors_sql('D', 4, 0.1)},
E AS (SELECT "user", item, p, q, rating - mu - list_inner_product(p, q) AS e
      FROM D JOIN P USING ("user") JOIN Q USING (item) CROSS JOIN MU)
SELECT 'user' AS side, "user" AS id, round({STEP_LR} * e, 6) AS b,
       round(p[1] + {STEP_LR} * (e * q[1] - {STEP_REG} * p[1]), 6) AS f0,
       round(p[4] + {STEP_LR} * (e * q[4] - {STEP_REG} * p[4]), 6) AS f3 FROM E
UNION ALL
SELECT 'item', item, round({STEP_LR} * e, 6), round(q[1] + {STEP_LR} * (e * p[1] - {STEP_REG} * q[1]), 6),
       round(q[4] + {STEP_LR} * (e * p[4] - {STEP_REG} * q[4]), 6) FROM E""")
def funksvd_step(spark, sf):
    """One SGD step on ratings that share no user and no item (each user's smallest
    item, each such item's smallest user), over all blocks and strata."""
    r = ratings(spark, sf)
    one = (r.groupBy("user").agg(F.min("item").alias("item")).groupBy("item").agg(F.min("user").alias("user")))
    m = funk_svd(r.join(one, ["user", "item"]), n_epochs=1, n_factors=4, learning_rate=STEP_LR, reg=STEP_REG)
    u = m.user_factors.select(F.lit("user").alias("side"), F.col("user").alias("id"), F.col("bu").alias("b"),
                              F.col("p")[0].alias("f0"), F.col("p")[3].alias("f3"))
    i = m.item_factors.select(F.lit("item").alias("side"), F.col("item").alias("id"), F.col("bi").alias("b"),
                              F.col("q")[0].alias("f0"), F.col("q")[3].alias("f3"))
    return finish(u.unionByName(i))


# ------------------------------------------------------------------ fitted at the usual sizes

@register("als")
def als_q(spark, sf):
    """Explicit ALS, 20 factors, 30 iterations, on the training split.  Per item, whether
    its normal equation holds at the returned factors (checked by joins and sums, not by the
    solver); values are checked by ``als_k1`` and ``als_k2``."""
    train, _ = split(spark, sf)
    m = explicit_als(train, k=20, reg=ALS_REG, n_iters=30, seed=1)
    res = normal_equation_residuals(m, train, ALS_REG)
    return res.select("item", (F.col("residual") < 1e-6).alias("solved"))


def _als_k2_ctes(src: str) -> str:
    """Two iterations at k = 2: every half-step solves a 2 x 2 system per key."""
    def half(out, key, other, prev):
        return f"""{out}_S AS (SELECT {key}, sum(f0 * f0) + {ALS_REG} AS a, sum(f0 * f1) AS b, sum(f1 * f1) + {ALS_REG} AS d,
  sum(f0 * rating) AS e, sum(f1 * rating) AS f FROM {src} JOIN {prev} USING ({other}) GROUP BY {key}),
{out} AS MATERIALIZED (SELECT {key}, (d * e - b * f) / (a * d - b * b) AS f0, (a * f - b * e) / (a * d - b * b) AS f1 FROM {out}_S)"""
    u, i = '"user"', "item"
    return ",\n".join([f"Z0 AS MATERIALIZED (SELECT item, {_init_sql('item', 0)} AS f0, {_init_sql('item', 1)} AS f1 FROM (SELECT DISTINCT item FROM {src}))",
                       half("Y1", u, i, "Z0"), half("Z1", i, u, "Y1"), half("Y2", u, i, "Z1"), half("Z2", i, u, "Y2")])


@register("als_k2", f"""WITH {R_CTE}, {_als_k2_ctes('R')}
SELECT 'user' AS side, "user" AS id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM Y2
UNION ALL SELECT 'item', item, round(f0, 6), round(f1, 6) FROM Z2""")
def als_k2(spark, sf):
    """Explicit ALS, k = 2, two iterations."""
    m = explicit_als(ratings(spark, sf), k=2, reg=ALS_REG, n_iters=2, seed=1, init_scale=INIT_SCALE)
    u = m.user_factors.select(F.lit("user").alias("side"), F.col("user").alias("id"), F.col("p")[0].alias("f0"), F.col("p")[1].alias("f1"))
    i = m.item_factors.select(F.lit("item").alias("side"), F.col("item").alias("id"), F.col("q")[0].alias("f0"), F.col("q")[1].alias("f1"))
    return finish(u.unionByName(i))


@register("als_wr")
def als_wr_q(spark, sf):
    """MLlib ALS (weighted λ), 20 factors, 10 iterations; held-out scores."""
    train, test = split(spark, sf)
    return finish(factor_predict(als_wr(train, k=20, reg=0.1, n_iters=10), test))


SVD_ROUNDS = 20


def _power_sql(src: str) -> str:
    """V{n}(item, v): the leading right singular vector of ``src`` by power iteration."""
    out = [f"V0 AS (SELECT DISTINCT item, CAST(1.0 AS DOUBLE) AS v FROM {src})"]
    for n in range(SVD_ROUNDS):
        out.append(f"""U{n} AS (SELECT "user", sum(rating * v) AS u FROM {src} JOIN V{n} USING (item) GROUP BY "user"),
W{n} AS MATERIALIZED (SELECT item, sum(rating * u) AS w FROM {src} JOIN U{n} USING ("user") GROUP BY item),
V{n + 1} AS MATERIALIZED (SELECT item, w / sqrt((SELECT sum(w * w) FROM W{n})) AS v FROM W{n})""")
    return ",\n".join(out)


@register("svd_rank1", f"""WITH {R_CTE}, {SPLIT_CTE}, {_power_sql('TR')},
U AS (SELECT "user", sum(rating * v) AS u FROM TR JOIN V{SVD_ROUNDS} USING (item) GROUP BY "user")
SELECT TE."user", TE.item, TE.rating, round(u * v, 6) AS score FROM TE LEFT JOIN U USING ("user") LEFT JOIN V{SVD_ROUNDS} USING (item)""")
def svd_rank1(spark, sf):
    """The best rank-1 approximation of the ratings (missing cells 0); held-out scores."""
    train, test = split(spark, sf)
    return finish(factor_predict(truncated_svd(train, k=1, n_iter=20, use_bias=False), test))


@register("svd_scores")
def svd_scores(spark, sf):
    """Biased truncated SVD (20 factors, 20 power iterations); held-out scores."""
    train, test = split(spark, sf)
    return finish(factor_predict(truncated_svd(train, k=20, n_iter=20), test))


@register("funksvd")
def funksvd_q(spark, sf):
    """P11 at the published setting (30 factors, 100 epochs, lr 0.001, reg 0.005);
    held-out scores."""
    train, test = split(spark, sf)
    return finish(factor_predict(funk_svd(train), test))


@register("eval_funksvd")
def eval_funksvd(spark, sf):
    """M9: held-out RMSE and MAE of FunkSVD at the published setting (30 factors, 100 epochs)."""
    train, test = split(spark, sf)
    return finish(rmse_mae(factor_predict(funk_svd(train), test)))


EVAL_EPOCHS, EVAL_K = 3, 2


def one_each(r):
    """Each user's smallest item, each such item's smallest user: ratings that share neither."""
    one = r.groupBy("user").agg(F.min("item").alias("item")).groupBy("item").agg(F.min("user").alias("user"))
    return r.join(one, ["user", "item"])


ONE_EACH_CTES = """ONE AS (SELECT min("user") AS "user", item FROM (SELECT "user", min(item) AS item FROM R GROUP BY "user") GROUP BY item),
D AS MATERIALIZED (SELECT "user", item, rating FROM ONE JOIN R USING ("user", item))"""


def _epochs_sql(epochs: int, k: int, scale: float, lr: float, reg: float, biased: bool) -> str:
    """State T{n}("user", item, rating, bu, bi, p, q) of conflict-free ratings after n epochs."""
    vec = lambda col, seed: f"list_transform(range({k}), lambda f: {_init_sql(col, 'f', seed, scale)})"
    out = [f"""MU AS (SELECT avg(rating) AS mu FROM D),
T0 AS MATERIALIZED (SELECT "user", item, rating, CAST(0.0 AS DOUBLE) AS bu, CAST(0.0 AS DOUBLE) AS bi, {vec('"user"', 1)} AS p, {vec('item', 8)} AS q FROM D)"""]
    step = lambda x, y: f"list_transform(range(1, {k} + 1), lambda j: {x}[j] + CAST({lr} AS DOUBLE) * (e * {y}[j] - CAST({reg} AS DOUBLE) * {x}[j]))"
    score = "rating - ((SELECT mu FROM MU) + bu + bi + list_inner_product(p, q))" if biased else "1.0 - 1.0 / (1.0 + exp(-list_inner_product(p, q)))"
    for n in range(epochs):
        out.append(f"""E{n} AS (SELECT *, {score} AS e FROM T{n}),
T{n + 1} AS MATERIALIZED (SELECT "user", item, rating, bu + CAST({lr} AS DOUBLE) * (e - CAST({reg} AS DOUBLE) * bu) AS bu,
  bi + CAST({lr} AS DOUBLE) * (e - CAST({reg} AS DOUBLE) * bi) AS bi, {step('p', 'q')} AS p, {step('q', 'p')} AS q FROM E{n})""")
    return ",\n".join(out)


@register("eval_funksvd_epochs", f"""WITH {R_CTE}, {ONE_EACH_CTES}, {_epochs_sql(EVAL_EPOCHS, EVAL_K, 0.1, 0.05, 0.02, True)},
G AS (SELECT R.rating, (SELECT mu FROM MU) + u.bu + i.bi + list_inner_product(u.p, i.q) AS score
      FROM R LEFT JOIN T{EVAL_EPOCHS} u ON u."user" = R."user" LEFT JOIN T{EVAL_EPOCHS} i ON i.item = R.item)
SELECT round(sqrt(avg((score - rating) * (score - rating))), 6) AS rmse, round(avg(abs(score - rating)), 6) AS mae,
       count(score) AS n_scored, count(*) AS n FROM G""")
def eval_funksvd_epochs(spark, sf):
    """M9 + P11: errors on all ratings of a FunkSVD fitted for three epochs on ratings that
    share no user and no item."""
    r = ratings(spark, sf)
    m = funk_svd(one_each(r), n_epochs=EVAL_EPOCHS, n_factors=EVAL_K, learning_rate=0.05, reg=0.02)
    return finish(rmse_mae(factor_predict(m, r)))


@register("lfm_epochs", f"""WITH {R_CTE}, {ONE_EACH_CTES}, {_epochs_sql(2, 3, 1.0, 0.05, 0.1, False)}
SELECT 'user' AS side, "user" AS id, round(p[1], 6) AS f0, round(p[3], 6) AS f2 FROM T2
UNION ALL SELECT 'item', item, round(q[1], 6), round(q[3], 6) FROM T2""")
def lfm_epochs(spark, sf):
    """Factors after two epochs on positives that share no user and no item, without negatives."""
    m = lfm(one_each(ratings(spark, sf)), k=3, learning_rate=0.05, regularization_rate=0.1, epochs=2, ratio=0.0)
    u = m.user_factors.select(F.lit("user").alias("side"), F.col("user").alias("id"), F.col("p")[0].alias("f0"), F.col("p")[2].alias("f2"))
    i = m.item_factors.select(F.lit("item").alias("side"), F.col("item").alias("id"), F.col("q")[0].alias("f0"), F.col("q")[2].alias("f2"))
    return finish(u.unionByName(i))


@register("fit_error_factors", f"""WITH {R_CTE}, {_vectors_sql('R', START_K, 0.3)}, {bias_ctes('R')},
G AS (SELECT rating, mu + bi + bu + list_inner_product(p, q) AS score FROM R JOIN P USING ("user") JOIN Q USING (item)
      JOIN BI USING (item) JOIN BU USING ("user"), MU)
SELECT round(sqrt(avg((score - rating) * (score - rating))), 6) AS rmse, round(avg(abs(score - rating)), 6) AS mae,
       count(score) AS n_scored, count(*) AS n FROM G""")
def fit_error_factors(spark, sf):
    """M8: RMSE and MAE of known factors and fitted biases on the training cells."""
    r = ratings(spark, sf)
    m = initial_model(r, START_K, scale=0.3)
    m.bias = bias_fit(r)
    return finish(fit_error(lambda pairs: factor_predict(m, pairs), r))


@register("funksvd_topn")
def funksvd_topn(spark, sf):
    """R7 for factor models: FunkSVD on all ratings, top-10 unrated items for every user."""
    r = ratings(spark, sf)
    return finish(factor_top_n(funk_svd(r), r, TOP_N))


@register("lfm")
def lfm_q(spark, sf):
    """Implicit LFM (10 factors, 10 epochs), sigmoid scores of the held-out pairs."""
    train, test = split(spark, sf)
    return finish(factor_predict(lfm(train), test))


@register("lfm_loss")
def lfm_loss_q(spark, sf):
    """Full-grid LFM loss on all ratings after 10 epochs."""
    r = ratings(spark, sf)
    return finish(lfm_loss(lfm(r), r, 0.1))


FM_COLUMNS = ["user", "item", "brand", "segment"]


def fm_rows(spark, sf, df):
    """``df`` (user, item, ...) with the item's brand and the user's market segment."""
    brand = read_table(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("brand"))
    segment = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("user"), F.col("c_mktsegment").alias("segment"))
    return df.join(brand, "item", "left").join(segment, "user", "left")


@register("fm")
def fm_q(spark, sf):
    """Factorisation machine on user, item, brand and segment (5 factors, 10 epochs in
    batches of 200,000 rows); held-out scores."""
    train, test = split(spark, sf)
    m = fm_fit(fm_rows(spark, sf, train), FM_COLUMNS, "rating", ["user", "item"], n_epochs=10, learning_rate=0.3,
               reg=1e-5, batch_rows=200_000)
    return finish(fm_predict(m, fm_rows(spark, sf, test)).select("user", "item", "rating", "score"))


FM_STEPS, FM_LR, FM_REG, FM_SCALE = 4, 0.05, 0.001, 0.3


def _fm_steps_sql() -> str:
    """Parameters after ``FM_STEPS`` Adagrad steps (k = 2) over the two halves of R in turn."""
    def slots(col, after):
        off = " + ".join(f"(SELECT count(*) FROM S_{c})" for c in after) or "0"
        return f"""S_{col} AS MATERIALIZED (SELECT "{col}", row_number() OVER (ORDER BY count(*) DESC, "{col}") - 1 + {off} AS slot
FROM D WHERE "{col}" IS NOT NULL GROUP BY "{col}")"""
    index = ",\n".join(slots(c, FM_COLUMNS[:n]) for n, c in enumerate(FM_COLUMNS))
    rows = "\nUNION ALL ".join(f'SELECT pos, batch, rating AS y, slot FROM D JOIN S_{c} USING ("{c}")' for c in FM_COLUMNS)
    steps = []
    for t in range(FM_STEPS):
        reg = lambda x: f"coalesce(g{x}, 0.0) + CASE WHEN slot = -1 THEN 0.0 ELSE 2.0 * CAST({FM_REG} AS DOUBLE) * {x} END"
        cols = ["w", "v1", "v2"]
        steps.append(f"""A{t} AS (SELECT pos, any_value(y) AS y, sum(w) AS lin, sum(v1) AS s1, sum(v2) AS s2, sum(v1 * v1 + v2 * v2) AS q
  FROM X JOIN P{t} USING (slot) WHERE batch = {t % 2} GROUP BY pos),
C{t} AS (SELECT pos, s1, s2, 2.0 * ((SELECT w FROM P{t} WHERE slot = -1) + lin + 0.5 * (s1 * s1 + s2 * s2 - q) - y)
         / (SELECT count(*) FROM A{t}) AS c FROM A{t}),
G{t} AS (SELECT slot, sum(c) AS gw, sum(c * (s1 - v1)) AS gv1, sum(c * (s2 - v2)) AS gv2 FROM X JOIN C{t} USING (pos) JOIN P{t} USING (slot)
         GROUP BY slot UNION ALL SELECT -1, sum(c), 0.0, 0.0 FROM C{t}),
H{t} AS (SELECT slot, {", ".join(f"{x}, a{x}, {reg(x)} AS h{x}" for x in cols)} FROM P{t} LEFT JOIN G{t} USING (slot)),
P{t + 1} AS MATERIALIZED (SELECT slot, {", ".join(f"{x} - CAST({FM_LR} AS DOUBLE) * h{x} / sqrt(a{x} + h{x} * h{x}) AS {x}, a{x} + h{x} * h{x} AS a{x}" for x in cols)} FROM H{t})""")
    init = lambda f: f"CASE WHEN slot = -1 THEN 0.0 ELSE {_init_sql('slot', f, 1, FM_SCALE)} END"
    return f"""WITH {R_CTE},
D AS MATERIALIZED (SELECT "user", item, rating, p_brand AS brand, c_mktsegment AS segment, row_number() OVER (ORDER BY "user", item) - 1 AS pos,
  (row_number() OVER (ORDER BY "user", item) - 1) // CAST(ceil((SELECT count(*) FROM R) / 2) AS BIGINT) AS batch
  FROM R LEFT JOIN part ON p_partkey = item LEFT JOIN customer ON c_custkey = "user"),
{index},
X AS MATERIALIZED ({rows}),
P0 AS MATERIALIZED (SELECT slot, CAST(0.0 AS DOUBLE) AS w, CAST(0.1 AS DOUBLE) AS aw, {init(0)} AS v1, CAST(0.1 AS DOUBLE) AS av1,
  {init(1)} AS v2, CAST(0.1 AS DOUBLE) AS av2 FROM (SELECT DISTINCT slot FROM X UNION ALL SELECT -1)),
{", ".join(steps)}
SELECT slot, round(w, 6) AS w, round(v1, 6) AS f0, round(v2, 6) AS f1 FROM P{FM_STEPS}"""


@register("fm_steps", _fm_steps_sql())
def fm_steps(spark, sf):
    """P14 + T10 + T12: all parameters after two epochs of two batches (k = 2, four columns)."""
    r = ratings(spark, sf)
    m = fm_fit(fm_rows(spark, sf, r), FM_COLUMNS, "rating", ["user", "item"], n_epochs=2, n_factors=2,
               learning_rate=FM_LR, reg=FM_REG, batch_rows=-(-r.count() // 2), init_scale=FM_SCALE)
    return finish(m.weights.select("slot", "w", F.col("v")[0].alias("f0"), F.col("v")[1].alias("f1")))


@register("fm_known", f"""WITH {R_CTE}, {SPLIT_CTE}, {_vectors_sql('TR', START_K, 1.0)}
SELECT "user", item, round(coalesce(list_inner_product(p, q), 0.0), 6) AS score
FROM (SELECT "user", item FROM TE UNION ALL SELECT -1, item FROM TE) LEFT JOIN P USING ("user") LEFT JOIN Q USING (item)""")
def fm_known(spark, sf):
    """P14 prediction for known weights, with an unknown user (an all-zero block) per pair."""
    train, test = split(spark, sf)
    start = initial_model(train, START_K)
    slots = offset_slots({c: category_slots(train, c) for c in ("user", "item")})
    known = [slots[c].join(d.withColumnRenamed(c, "value"), "value").select("slot", F.lit(0.0).alias("w"), F.col(f).alias("v"))
             for c, d, f in (("user", start.user_factors, "p"), ("item", start.item_factors, "q"))]
    intercept = spark.range(1).select(F.lit(INTERCEPT).cast("long").alias("slot"), F.lit(0.0).alias("w"),
                                      F.array_repeat(F.lit(0.0), START_K).alias("v"))
    m = FmModel(slots, known[0].unionByName(known[1]).unionByName(intercept), START_K)
    pairs = test.select("user", "item")
    unknown = pairs.select(F.lit(-1).cast("long").alias("user"), "item")
    return finish(fm_predict(m, pairs.unionByName(unknown)))


@register("one_hot", f"""WITH {R_CTE}, {SPLIT_CTE},
US AS (SELECT "user", row_number() OVER (ORDER BY count(*) DESC, "user") - 1 AS user_slot FROM TR GROUP BY "user"),
ITS AS (SELECT item, row_number() OVER (ORDER BY count(*) DESC, item) - 1 + (SELECT count(*) FROM US) AS item_slot
       FROM TR GROUP BY item)
SELECT "user", item, user_slot, item_slot FROM R LEFT JOIN US USING ("user") LEFT JOIN ITS USING (item)""")
def one_hot(spark, sf):
    """Active one-hot slots of every rating, indexes from the training split."""
    train, _ = split(spark, sf)
    slots = {c: category_slots(train, c) for c in ("user", "item")}
    return one_hot_slots(ratings(spark, sf).select("user", "item"), slots)


def click_events(spark, sf):
    """Clicks fixture: label = purchase, features value, hour(ts), k."""
    ev = read_table(spark, sf, "events")
    return ev.select(
        "event_id",
        (F.col("event_type") == "purchase").cast("double").alias("label"),
        F.col("value").cast("double").alias("value"),
        F.hour("ts").cast("double").alias("hour"),
        F.coalesce(F.get_json_object("props", "$.k").cast("double"), F.lit(-1.0)).alias("k"))


@register("gbdt_lr_prob")
def gbdt_lr_prob(spark, sf):
    """P16 + P17 + T11: trees -> leaf one-hot -> logistic regression; positive-class
    probability of the held-out 20 % of events (md5 Bernoulli split on event_id)."""
    ev = click_events(spark, sf)
    held = unit_draw(F.col("event_id"), F.lit(1)) >= 0.8
    train, test = ev.where(~held), ev.where(held)
    m = gbdt_lr_fit(train, ["value", "hour", "k"], "label", n_estimators=5, max_leaf_nodes=10)
    out = m.transform(test).select("event_id", "label", F.col("prediction").alias("predicted"), "prob")
    return finish(out)


TREE_LEAVES, TREE_NEWTON = 10, 12


def _tree_ctes() -> str:
    """One best-first tree on (hour, k) by brute force over all cuts: T{s} are the rows with
    their node after s splits, B{s} the split taken next."""
    steps = [f"""ALL_E AS MATERIALIZED (SELECT event_id, CAST(event_type = 'purchase' AS DOUBLE) AS label, CAST(hour(ts) AS DOUBLE) AS x0,
  coalesce(CAST(json_extract_string(props, '$.k') AS DOUBLE), -1.0) AS x1,
  CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':1'), 1, 8)) AS BIGINT) / 4294967296.0 >= 0.8 AS held FROM events),
T0 AS MATERIALIZED (SELECT event_id, label, x0, x1, held, 0 AS node, label - (SELECT avg(label) FROM ALL_E WHERE NOT held) AS r,
  (SELECT avg(label) FROM ALL_E WHERE NOT held) * (1 - (SELECT avg(label) FROM ALL_E WHERE NOT held)) AS h FROM ALL_E)"""]
    for s in range(TREE_LEAVES - 1):
        cells = " UNION ALL ".join(f"SELECT node, {f} AS f, x{f} AS v, r FROM T{s} WHERE NOT held" for f in (0, 1))
        steps.append(f"""V{s} AS (SELECT node, f, v, count(*) AS n, sum(r) AS r FROM ({cells}) GROUP BY node, f, v),
W{s} AS (SELECT node, f, v, lead(v) OVER o AS nv, sum(n) OVER o AS nl, sum(r) OVER o AS rl, sum(n) OVER a AS n, sum(r) OVER a AS r
  FROM V{s} WINDOW o AS (PARTITION BY node, f ORDER BY v), a AS (PARTITION BY node, f)),
B{s} AS MATERIALIZED (SELECT node, f, (v + nv) / 2 AS cut, round(nl * (n - nl) / n * pow(rl / nl - (r - rl) / (n - nl), 2), 9) AS gain
  FROM W{s} WHERE nv IS NOT NULL ORDER BY gain DESC, node, f, cut LIMIT 1),
T{s + 1} AS MATERIALIZED (SELECT event_id, label, x0, x1, held, r, h, CASE WHEN T{s}.node <> B{s}.node OR gain <= 0 THEN T{s}.node
  WHEN CASE f WHEN 0 THEN x0 ELSE x1 END < cut THEN {2 * s + 1} ELSE {2 * s + 2} END AS node FROM T{s}, B{s})""")
    return ",\n".join(steps)


@register("best_first_tree", f"""WITH {_tree_ctes()},
L AS (SELECT node, count(*) AS n, sum(r) / sum(h) AS value FROM T{TREE_LEAVES - 1} WHERE NOT held GROUP BY node),
S AS ({" UNION ALL ".join(f"SELECT {s} AS step, * FROM B{s} WHERE gain > 0" for s in range(TREE_LEAVES - 1))})
SELECT 'split' AS kind, node, f AS feature, round(cut, 6) AS threshold, round(gain, 6) AS gain, CAST(NULL AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS value FROM S
UNION ALL SELECT 'leaf', node, NULL, NULL, NULL, n, round(value, 6) FROM L""")
def best_first_tree(spark, sf):
    """Nodes of the first tree (hour, k; ten leaves): every split with its gain, every
    leaf with its rows and value."""
    ev = click_events(spark, sf)
    m = boosted_trees_fit(ev.where(unit_draw(F.col("event_id"), F.lit(1)) < 0.8), ["hour", "k"], "label", 1, TREE_LEAVES)
    rows = [("leaf", i, None, None, None, n.n, float(n.value)) if n.left is None else
            ("split", i, n.feature, float(n.threshold), float(n.gain), None, None) for i, n in enumerate(m.rounds[0][0].nodes)]
    return finish(spark.createDataFrame(rows, "kind string, node int, feature int, threshold double, gain double, n long, value double"))


def _one_tree_regression_sql() -> str:
    """Newton steps for one tree's leaves: w by leaf and the intercept b (an arrow system)."""
    steps = [f"""N AS (SELECT node, count(*) AS n, sum(label) AS s FROM T{TREE_LEAVES - 1} WHERE NOT held GROUP BY node),
K0 AS MATERIALIZED (SELECT node, n, s, CAST(0.0 AS DOUBLE) AS w, CAST(0.0 AS DOUBLE) AS b FROM N)"""]
    for t in range(TREE_NEWTON):
        steps.append(f"""J{t} AS (SELECT *, n * p - s + w AS g, n * p * (1 - p) AS a FROM (SELECT *, 1 / (1 + exp(-(w + b))) AS p FROM K{t})),
D{t} AS (SELECT -(sum(n * p - s) - sum(a * g / (a + 1))) / (sum(a) - sum(a * a / (a + 1))) AS db FROM J{t}),
K{t + 1} AS MATERIALIZED (SELECT node, n, s, w - (g + a * db) / (a + 1) AS w, b + db AS b FROM J{t}, D{t})""")
    return ",\n".join(steps)


@register("gbdt_lr_check", f"""WITH {_tree_ctes()},
{_one_tree_regression_sql()}
SELECT event_id, label, round(1 / (1 + exp(-(w + b))), 6) AS prob FROM T{TREE_LEAVES - 1} JOIN K{TREE_NEWTON} USING (node) WHERE held""")
def gbdt_lr_check(spark, sf):
    """P16, P17, T11 with one tree (hour, k; ten leaves): probabilities of the held-out events."""
    ev = click_events(spark, sf)
    held = unit_draw(F.col("event_id"), F.lit(1)) >= 0.8
    m = gbdt_lr_fit(ev.where(~held), ["hour", "k"], "label", n_estimators=1, max_leaf_nodes=TREE_LEAVES)
    return finish(m.transform(ev.where(held)).select("event_id", "label", "prob"))
