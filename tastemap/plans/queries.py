"""Registered queries: one Spark builder per operator and, where SQL can say it,
the DuckDB oracle over the same parquet tables.

Every builder reads the fixture tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bias as B
from ..operators import metrics as M
from ..operators import prep as T
from ..operators import serve as S
from ..sources.tables import fixture_ratings, items_meta, raw_ratings, read_table
from .common import (R_CTE, SEED, SPLIT_CTE, TEST_FRAC, bias_ctes, finish, md5_draw_sql,
                     materialized, ratings, split)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOP_N = 10


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ====================================================================== serving (flagship)

@register("topn_with_names", f"""
WITH {R_CTE}, {bias_ctes('R')},
U AS (SELECT DISTINCT "user" FROM R),
C AS (SELECT U."user", BI.item, BI.bi FROM U CROSS JOIN BI
      WHERE NOT EXISTS (SELECT 1 FROM R WHERE R."user" = U."user" AND R.item = BI.item)),
K AS (SELECT "user", item, bi, row_number() OVER (PARTITION BY "user" ORDER BY bi DESC, item) AS rk FROM C)
SELECT K."user", CAST(rk AS INTEGER) AS rank, K.item, round(mu + bu + bi, 6) AS score, p_name
FROM K JOIN BU USING ("user") CROSS JOIN MU LEFT JOIN part ON p_partkey = K.item
WHERE rk <= {TOP_N}""")
def topn_with_names(spark, sf):
    """Flagship: bias model on R, top-10 unrated parts per customer, with part names."""
    r = ratings(spark, sf)
    model = B.bias_fit(r)
    recs = S.bias_top_n_unrated(model, r, TOP_N)
    names = items_meta(spark, sf).select("item", "p_name")
    return finish(S.attach_metadata(recs, names))


@register("topn_unrated", f"""
WITH {R_CTE}, {SPLIT_CTE}, {bias_ctes('TR')},
U AS (SELECT DISTINCT "user" FROM TR),
C AS (SELECT U."user", BI.item, BI.bi FROM U CROSS JOIN BI
      WHERE NOT EXISTS (SELECT 1 FROM TR WHERE TR."user" = U."user" AND TR.item = BI.item)),
K AS (SELECT "user", item, bi, row_number() OVER (PARTITION BY "user" ORDER BY bi DESC, item) AS rk FROM C)
SELECT K."user", CAST(rk AS INTEGER) AS rank, K.item, round(mu + bu + bi, 6) AS score
FROM K JOIN BU USING ("user") CROSS JOIN MU WHERE rk <= {TOP_N}""")
def topn_unrated(spark, sf):
    """R1 + R4: bias model fitted on the training split, top-10 unrated per user."""
    train, _ = split(spark, sf)
    model = B.bias_fit(train)
    return finish(S.bias_top_n_unrated(model, train, TOP_N))


@register("topn_rated", f"""
WITH {R_CTE}, {bias_ctes('R')},
K AS (SELECT R."user", R.item, bi, row_number() OVER (PARTITION BY R."user" ORDER BY bi DESC, R.item) AS rk
      FROM R JOIN BI USING (item))
SELECT K."user", CAST(rk AS INTEGER) AS rank, K.item, round(mu + bu + bi, 6) AS score
FROM K JOIN BU USING ("user") CROSS JOIN MU WHERE rk <= 5""")
def topn_rated(spark, sf):
    """R2 + R4: top-5 among each user's rated items, bias model."""
    r = ratings(spark, sf)
    return finish(S.bias_top_n_rated(B.bias_fit(r), r, 5))


@register("top_k_per_group", f"""
WITH {R_CTE}
SELECT "user", item, rating, CAST(rk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS rk FROM R)
WHERE rk <= 3""")
def top_k_per_group(spark, sf):
    """The 3 highest ratings per user, earlier (smaller) item first on ties."""
    r = ratings(spark, sf)
    return finish(S.top_k_per_group(r, ["user"], [F.col("rating").desc(), F.col("item").asc()], 3))


# ====================================================================== preparation

@register("ratings_matrix", """
WITH D AS (SELECT o_custkey AS "user", l_partkey AS item, sum(l_quantity) AS rating
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey)
SELECT "user", item, round(rating, 6) AS rating,
       CAST(dense_rank() OVER (ORDER BY "user") - 1 AS BIGINT) AS user_pos,
       CAST(dense_rank() OVER (ORDER BY item) - 1 AS BIGINT) AS item_pos
FROM D""")
def ratings_matrix(spark, sf):
    """Raw order lines, duplicate (user, item) summed, dense positions."""
    m, _, _ = T.index_ratings(raw_ratings(spark, sf))
    return finish(m.select("user", "item", "rating", "user_pos", "item_pos"))


@register("sparsity", f"""
WITH {R_CTE}
SELECT count(*) AS nnz, count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items,
       round(1.0 - count(*) / (count(DISTINCT "user") * count(DISTINCT item)), 6) AS sparsity
FROM R""")
def sparsity(spark, sf):
    """T3."""
    return finish(T.sparsity(ratings(spark, sf)))


@register("coverage_check", f"""
WITH {R_CTE}
SELECT DISTINCT item FROM R WHERE item NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""")
def coverage_check(spark, sf):
    """Items of R missing from a supplied item index (parts of size <= 25)."""
    index = read_table(spark, sf, "part").where(F.col("p_size") <= 25).select(F.col("p_partkey").alias("item"))
    return T.uncovered_ids(ratings(spark, sf), index, "item")


@register("demean_item", f"""
WITH {R_CTE},
M AS (SELECT item, sum(rating) / (CAST(5 AS DOUBLE) + count(*)) AS mean FROM R GROUP BY item)
SELECT "user", item, round(rating - mean, 6) AS rating, round(mean, 6) AS mean FROM R JOIN M USING (item)""")
def demean_item(spark, sf):
    """T4: per-item damped mean (damping 5) subtracted."""
    return finish(T.demean(ratings(spark, sf), "item", damping=5.0).select("user", "item", "rating", "mean"))


@register("norm_user", f"""
WITH {R_CTE},
N AS (SELECT "user", sqrt(sum(rating * rating)) AS n FROM R GROUP BY "user")
SELECT "user", item, round(rating / n, 6) AS rating, round(n, 6) AS norm FROM R JOIN N USING ("user")""")
def norm_user(spark, sf):
    """T5: per-user L2 normalisation."""
    return finish(T.l2_normalize(ratings(spark, sf), "user").select("user", "item", "rating", "norm"))


@register("split_per_user", f"""
WITH {R_CTE}, {SPLIT_CTE}
SELECT "user", item, rating, rn <= round_even(CAST({TEST_FRAC} AS DOUBLE) * n, 0) AS is_test FROM S""")
def split_per_user(spark, sf):
    """T6."""
    return finish(T.split_per_group(ratings(spark, sf), TEST_FRAC, "user", SEED))


@register("split_global", f"""
WITH {R_CTE},
H AS (SELECT *, row_number() OVER (ORDER BY {md5_draw_sql('"user"', 'item', str(SEED))}, "user", item) AS rn,
             count(*) OVER () AS n FROM R)
SELECT "user", item, rating, rn <= round_even(CAST(0.2 AS DOUBLE) * n, 0) AS is_test FROM H""")
def split_global(spark, sf):
    """T7 exact global fraction (20 %)."""
    return finish(T.split_global(ratings(spark, sf), 0.2, SEED))


@register("split_bernoulli", f"""
WITH {R_CTE}
SELECT "user", item, rating,
       NOT ({md5_draw_sql('"user"', 'item', str(SEED))} / 4294967296.0 < 0.8) AS is_test FROM R""")
def split_bernoulli(spark, sf):
    """T7 Bernoulli pivot 0.8."""
    return finish(T.split_bernoulli(ratings(spark, sf), 0.8, SEED))


@register("user_slice", f"""
WITH {R_CTE}
SELECT "user", item, rating FROM R WHERE "user" = (SELECT min(o_custkey) FROM orders)""")
def user_slice(spark, sf):
    """The row of the smallest customer key."""
    first = read_table(spark, sf, "orders").agg(F.min("o_custkey")).first()[0]
    # not the cached R: the predicate on the grouping key reaches the scan of orders
    return finish(T.slice_rows(fixture_ratings(spark, sf), "user", first))


@register("rating_summary", f"""
WITH {R_CTE}
SELECT count(rating) AS n, round(avg(rating), 6) AS mean, round(stddev_samp(rating), 6) AS std, min(rating) AS min,
       quantile_cont(rating, 0.25) AS q25, quantile_cont(rating, 0.5) AS q50, quantile_cont(rating, 0.75) AS q75,
       max(rating) AS max FROM R""")
def rating_summary(spark, sf):
    """Summary statistics of the loaded ratings."""
    return finish(M.summary(ratings(spark, sf), "rating"))


@register("align_scores", f"""
WITH {R_CTE}, {SPLIT_CTE}, {bias_ctes('TR')},
SC AS (SELECT "user", item, mu + bu + bi AS score FROM TR JOIN BU USING ("user") JOIN BI USING (item) CROSS JOIN MU)
SELECT R."user", R.item, round(SC.score, 6) AS score FROM R LEFT JOIN SC USING ("user", item)""")
def align_scores(spark, sf):
    """Every pair of R requested against scores known for the training pairs
    (bias model on the training split); test-only pairs get NULL."""
    train, _ = split(spark, sf)
    model = B.bias_fit(train)
    scores = (train.select("user", "item").join(model.user_bias, "user").join(model.item_bias, "item")
              .select("user", "item", (F.lit(model.mu) + F.col("bu") + F.col("bi")).alias("score")))
    return finish(T.align_scores(ratings(spark, sf), scores))


@register("minibatch_ids", f"""
WITH {R_CTE}
SELECT "user", item, CAST(floor((row_number() OVER (ORDER BY "user", item) - 1) / 1000) AS BIGINT) AS batch_id FROM R""")
def minibatch_ids(spark, sf):
    """Batches of 1000 rows in (user, item) order."""
    return T.minibatch_ids(ratings(spark, sf).select("user", "item"), ["user", "item"], 1000)


@register("negative_samples", f"""
WITH {R_CTE},
P AS (SELECT DISTINCT "user", item FROM R),
I AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS BIGINT) AS item_pos FROM (SELECT DISTINCT item FROM P)),
NI AS (SELECT count(*) AS n_items FROM I),
NU AS (SELECT "user", count(*) AS n FROM P GROUP BY "user"),
D AS (SELECT "user", n, d FROM NU, range(1, 5 * n + 1) t(d)),
DI AS (SELECT D."user", D.n, D.d, I.item FROM D CROSS JOIN NI
       JOIN I ON I.item_pos = {md5_draw_sql('D."user"', 'D.d', str(SEED))} % n_items),
C AS (SELECT "user", item, min(d) AS d, max(n) AS n FROM DI
      WHERE NOT EXISTS (SELECT 1 FROM P WHERE P."user" = DI."user" AND P.item = DI.item)
      GROUP BY "user", item),
NEG AS (SELECT "user", item FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY d) AS rk FROM C) WHERE rk <= n)
SELECT "user", item, 1 AS label FROM P UNION ALL SELECT "user", item, 0 AS label FROM NEG""")
def negative_samples(spark, sf):
    """Positives + up to n negatives per user from 5n md5 draws."""
    return T.negative_samples(ratings(spark, sf), seed=SEED)


# ====================================================================== bias

@register("bias_fit", f"""
WITH {R_CTE}, {bias_ctes('R')}
SELECT 'mu' AS kind, CAST(NULL AS BIGINT) AS id, round(mu, 6) AS value FROM MU
UNION ALL SELECT 'item', item, round(bi, 6) FROM BI
UNION ALL SELECT 'user', "user", round(bu, 6) FROM BU""")
def bias_fit(spark, sf):
    """P1 on R: mu, item biases (damping 25) then user biases (damping 10)."""
    m = B.bias_fit(ratings(spark, sf))
    mu = spark.range(1).select(F.lit("mu").alias("kind"), F.lit(None).cast("long").alias("id"),
                               F.lit(m.mu).alias("value"))
    items = m.item_bias.select(F.lit("item").alias("kind"), F.col("item").alias("id"), F.col("bi").alias("value"))
    users = m.user_bias.select(F.lit("user").alias("kind"), F.col("user").alias("id"), F.col("bu").alias("value"))
    return finish(mu.unionByName(items).unionByName(users))


@register("bias_predict", f"""
WITH {materialized(f"{R_CTE}, {SPLIT_CTE}, {bias_ctes('TR')}")}
SELECT TE."user", TE.item, TE.rating, round((SELECT mu FROM MU) + bu + bi, 6) AS score
FROM TE LEFT JOIN BU USING ("user") LEFT JOIN BI USING (item)""")
def bias_predict(spark, sf):
    """Fit on the training split, score every test pair (unknown item: NULL)."""
    train, test = split(spark, sf)
    return finish(B.bias_predict(B.bias_fit(train), test))


@register("bias_residual", f"""
WITH {R_CTE}, {bias_ctes('R')}
SELECT "user", item, round(rating - mu - bi - bu, 6) AS residual
FROM R JOIN BI USING (item) JOIN BU USING ("user") CROSS JOIN MU""")
def bias_residual(spark, sf):
    """T14."""
    r = ratings(spark, sf)
    return finish(B.bias_residuals(B.bias_fit(r), r))


@register("bias_item_only", f"""
WITH {R_CTE},
MU AS (SELECT avg(rating) AS mu FROM R),
BI AS (SELECT item, (sum(rating) - count(*) * max(mu)) / (CAST(25 AS DOUBLE) + count(*)) AS bi FROM R, MU GROUP BY item)
SELECT R."user", R.item, round(mu + bi, 6) AS score FROM R JOIN BI USING (item) CROSS JOIN MU""")
def bias_item_only(spark, sf):
    """P1/P2 with user_bias=False."""
    r = ratings(spark, sf)
    m = B.bias_fit(r, user_bias=False)
    return finish(B.bias_predict(m, r.select("user", "item")))


@register("known_score", f"""
WITH {R_CTE}, {SPLIT_CTE},
P AS (SELECT "user", item FROM TE UNION ALL SELECT "user", item FROM TR)
SELECT P."user", P.item, round(TR.rating, 6) AS score FROM P LEFT JOIN TR USING ("user", item)""")
def known_score(spark, sf):
    """Existing rating in the training split, else NULL (test + train pairs)."""
    train, test = split(spark, sf)
    pairs = test.select("user", "item").unionByName(train.select("user", "item"))
    return finish(B.known_score(train, pairs))


@register("topn_candidates", f"""
WITH {R_CTE}, {SPLIT_CTE}, {bias_ctes('TR')},
C AS (SELECT DISTINCT TE."user", TE.item FROM TE WHERE TE.item IN (SELECT item FROM TR)
      AND NOT EXISTS (SELECT 1 FROM TR WHERE TR."user" = TE."user" AND TR.item = TE.item)),
P AS (SELECT C."user", C.item, mu + bu + bi AS score FROM C JOIN BU USING ("user") JOIN BI USING (item) CROSS JOIN MU),
K AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY round(score, 6) DESC, item) AS rk FROM P)
SELECT K."user", CAST(rk AS INTEGER) AS rank, K.item, round(score, 6) AS score, p_brand
FROM K LEFT JOIN part ON p_partkey = K.item WHERE rk <= 3""")
def topn_candidates(spark, sf):
    """R1-R5 generic: each user's held-out items as candidates, restricted to items
    the model knows, unrated only, ranked by the bias model, best 3 with brands."""
    train, test = split(spark, sf)
    model = B.bias_fit(train)
    brands = items_meta(spark, sf).select("item", "p_brand")
    recs = S.recommend(lambda pairs: finish(B.bias_predict(model, pairs)), train, test.select("user", "item"), 3,
                       selector="unrated", items=train.select("item"), mapping=brands)
    return finish(recs)
