"""Latent-factor models: ALS (P9, P9b, P10), truncated SVD (P8), prediction
(P18) and top-N serving for factor models (R7)."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import block_of, dot, portable_init, sigmoid
from ..session import Rewritten, cut_lineage
from .bias import BiasModel, bias_fit, bias_residuals
from .blocks import block_product, build_blocks, unpacked
from .linalg import gram_of, inverse_factor
from .prep import dense_index


@dataclass
class FactorModel:
    user_factors: DataFrame          # (user, p array<double>[, bu double])
    item_factors: DataFrame          # (item, q array<double>[, bi double])
    k: int
    mu: float = 0.0                  # global mean added to every score
    bias: BiasModel | None = None    # damped bias model added once (Q3)
    link: str = "identity"           # "identity" or "sigmoid" (LFM)
    params: dict = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return {"user_factors": self.user_factors, "item_factors": self.item_factors}


def _score_expr(model: FactorModel):
    s = dot(F.col("p"), F.col("q"))
    cols = {c for c in model.user_factors.columns} | {c for c in model.item_factors.columns}
    if "bu" in cols:
        s = s + F.coalesce(F.col("bu"), F.lit(0.0))
    if "bi" in cols:
        s = s + F.coalesce(F.col("bi"), F.lit(0.0))
    s = s + F.lit(float(model.mu))
    return sigmoid(s) if model.link == "sigmoid" else s


def factor_predict(model: FactorModel, pairs: DataFrame, score_col: str = "score") -> DataFrame:
    """p·q (+ mu + b_u + b_i) for requested pairs; NULL when either side is unknown."""
    out = (pairs.join(model.user_factors, "user", "left").join(model.item_factors, "item", "left")
           .withColumn(score_col, F.when(F.col("p").isNotNull() & F.col("q").isNotNull(), _score_expr(model))))
    drop = [c for c in ("p", "q", "bu", "bi") if c in out.columns]
    out = out.drop(*drop)
    if model.bias is not None:
        b = model.bias
        out = (out.join(b.user_bias, "user", "left").join(b.item_bias, "item", "left")
               .withColumn(score_col, F.col(score_col) + F.lit(b.mu) + F.col("bu") + F.col("bi"))
               .drop("bu", "bi"))
    return out


# ================================================================== ALS

def explicit_als(ratings: DataFrame, k: int = 20, reg: float = 0.001, n_iters: int = 30,
                 seed: int = 1, init_scale: float = 0.1, use_bias: bool = False,
                 bias_model: BiasModel | None = None) -> FactorModel:
    """P9 explicit ALS: x_u = (Σ_i q_i q_iᵀ + reg·I)⁻¹ Σ_i r_ui q_i over observed
    cells (reg not scaled by the count), alternating users and items from item factors
    N(0, init_scale²).  P10 (``use_bias``): fitted on the bias residuals, the bias added
    back once.  The ratings stay in key blocks; a half-step ships every factor row once
    to each block that needs it, sums the normal equations and solves them
    there (``blocks.block_product``).  An iteration is one job and one write, for more blocks than
    cores two: the shuffles of one half-step lie on the disks at a time."""
    bias = None
    data = ratings.select("user", "item", "rating")
    if use_bias:
        bias = bias_model or bias_fit(ratings)
        data = bias_residuals(bias, ratings, "rating")
    data = cut_lineage(data)
    by_user = build_blocks(data, "user", "item", "rating")
    by_item = build_blocks(data, "item", "user", "rating")
    q = data.select("item").distinct().select("item", portable_init(F.col("item"), k, seed, init_scale).alias("s"))
    solve = normal_solver(k, reg)
    users, items = Rewritten(data.sparkSession, "als-users"), Rewritten(data.sparkSession, "als-items")
    large = max(by_user.nblk, by_item.nblk) > data.sparkSession.sparkContext.defaultParallelism
    for it in range(n_iters):
        p = block_product(by_user, q, "item", "s", "normal", finish=solve, binary=True)
        if large or it == n_iters - 1:
            p = users.keep(p)             # the last is returned as well as used; many blocks: one half-step's shuffles at a time
        q = items.keep(block_product(by_item, p, "user", "s", "normal", finish=solve, binary=True))
    by_user.release()
    by_item.release()
    return FactorModel(unpacked(p, "user", "s", "p"), unpacked(q, "item", "s", "q"),
                       k, 0.0, bias, params=dict(k=k, reg=reg, n_iters=n_iters, seed=seed))


def normal_solver(k: int, reg: float):
    """Rows [Σ f fᵀ, Σ r f] -> (Σ f fᵀ + reg·I)⁻¹ Σ r f, a batch of k x k systems at a time."""
    def solve(sums: np.ndarray) -> np.ndarray:
        out = np.empty((len(sums), k))
        for at in range(0, len(sums), 4096):
            s = sums[at:at + 4096]
            a = s[:, :k * k].reshape(-1, k, k) + reg * np.eye(k)
            out[at:at + 4096] = np.linalg.solve(a, s[:, k * k:, None])[..., 0]
        return out
    return solve


def als_half_step(ratings: DataFrame, item_factors: DataFrame, k: int, reg: float) -> DataFrame:
    """One user half-step against given item factors (item, f): (user, f)."""
    by_user = build_blocks(ratings.select("user", "item", "rating"), "user", "item", "rating")
    out = block_product(by_user, item_factors, "item", "f", "normal", finish=normal_solver(k, reg))
    return out.withColumnRenamed("s", "f")


def normal_equation_residuals(model: FactorModel, ratings: DataFrame, reg: float) -> DataFrame:
    """(item, residual): largest absolute residual of each item's normal equation
    (Σ p pᵀ + reg·I) q = Σ r p at the returned factors, by joins and per-row sums."""
    j = (ratings.select("user", "item", "rating").join(model.user_factors.select("user", "p"), "user")
         .join(model.item_factors.select("item", "q"), "item"))
    gap = dot(F.col("p"), F.col("q")) - F.col("rating")
    terms = j.select("item", "q", F.posexplode(F.transform("p", lambda x: x * gap)).alias("f", "t"))
    sums = terms.groupBy("item", "f").agg(F.sum("t").alias("t"), F.first("q").alias("q"))
    return (sums.select("item", F.abs(F.col("t") + F.lit(reg) * F.col("q")[F.col("f")]).alias("r"))
            .groupBy("item").agg(F.max("r").alias("residual")))


def als_wr(ratings: DataFrame, k: int = 10, reg: float = 0.1, n_iters: int = 10, seed: int = 1) -> FactorModel:
    """MLlib ALS (λ scaled by each entity's rating count, ALS-WR) — a
    different model from P9.  Ids are mapped to dense int positions first."""
    from pyspark.ml.recommendation import ALS
    users = dense_index(ratings, "user", "uix")
    items = dense_index(ratings, "item", "iix")
    data = ratings.join(users, "user").join(items, "item").select(
        F.col("uix").cast("int"), F.col("iix").cast("int"), "rating")
    als = ALS(rank=k, regParam=reg, maxIter=n_iters, seed=seed, userCol="uix", itemCol="iix",
              ratingCol="rating", coldStartStrategy="nan", nonnegative=False)
    m = als.fit(data)
    uf = m.userFactors.select(F.col("id").cast("long").alias("uix"),
                              F.col("features").cast("array<double>").alias("p")).join(users, "uix").drop("uix")
    itf = m.itemFactors.select(F.col("id").cast("long").alias("iix"),
                               F.col("features").cast("array<double>").alias("q")).join(items, "iix").drop("iix")
    return FactorModel(uf, itf, k, params=dict(k=k, reg=reg, n_iters=n_iters, seed=seed, kind="als_wr"))


# ================================================================== truncated SVD

def truncated_svd(ratings: DataFrame, k: int = 10, n_iter: int = 4, oversample: int = 10,
                  seed: int = 0, use_bias: bool = True, bias_model: BiasModel | None = None,
                  tol: float = 0.0) -> FactorModel:
    """SVD of the (bias-residual) rating matrix with missing cells = 0 by
    randomised subspace iteration (Halko, Martinsson, Tropp 2011) from a normal test
    matrix.  The bases stay distributed.  A product is one job and one write: its tasks add
    their share of the Gram matrix, whose triangular factor is handed to the next product as
    a constant, so no basis is orthonormalised in a pass of its own (but for a second time at
    the end).  Only l x l matrices reach the driver.  The iteration ends after ``n_iter``
    rounds, or when the k leading Ritz values stand still (relative change up to ``tol``; the
    vectors are then known to about its square root).
    Scores are row·V·Vᵀ = (UΣ)_u · V_i (+ bias)."""
    bias = None
    a = ratings.select("user", "item", F.col("rating").alias("a"))
    if use_bias:
        bias = bias_model or bias_fit(ratings)
        a = bias_residuals(bias, ratings, "a")
    a = cut_lineage(a)
    spark = a.sparkSession
    sizes = a.agg(F.countDistinct("user").alias("u"), F.countDistinct("item").alias("i")).first()
    l = min(k + oversample, sizes["u"], sizes["i"])
    k = min(k, l)
    by_user = build_blocks(a, "user", "item", "a")
    by_item = build_blocks(a, "item", "user", "a")
    tables = {"user": Rewritten(spark, "svd-users"), "item": Rewritten(spark, "svd-items")}

    def times(matrix, vecs: DataFrame, on: str, col: str, r: np.ndarray | None) -> tuple[DataFrame, np.ndarray]:
        """(rows of the product, their Gram matrix)."""
        out = tables[matrix.key].keep(block_product(matrix, vecs, on, col, apply=r, binary=True, gram=True))
        parts = out.where(F.col(matrix.key).isNull()).select("s").collect()           # l x l, one a task
        g = sum((np.frombuffer(p["s"], np.float64).reshape(l, l) for p in parts), np.zeros((l, l)))
        return out.where(F.col(matrix.key).isNotNull()), (g + g.T) / 2

    omega = a.select("item").distinct().select("item", portable_init(F.col("item"), l, seed).alias("v"))
    y, g = times(by_user, omega, "item", "v", None)
    before = None
    for _ in range(n_iter):
        z, gz = times(by_item, y, "user", "s", inverse_factor(g))                      # Gram of AᵀQ: Ritz values
        y, g = times(by_user, z, "item", "s", inverse_factor(gz))
        ritz = np.linalg.eigvalsh(gz)[::-1][:k]
        if before is not None and np.abs(ritz - before).max() <= tol * max(ritz[0], 1e-300):
            break
        before = ritz
    once = inverse_factor(g)
    r = once @ inverse_factor(gram_of(y, "s", once, l))                                # Q = Y r, orthonormal to rounding
    z, g = times(by_item, y, "user", "s", r)                                           # rows of Bᵀ = Aᵀ Q
    by_user.release()
    by_item.release()
    lam, w = np.linalg.eigh(g)
    order = np.argsort(lam)[::-1][:k]
    lam, w = np.clip(lam[order], 0, None), w[:, order]
    sig = np.sqrt(lam)
    inv = np.where(sig > 1e-12, 1.0 / np.where(sig > 1e-12, sig, 1.0), 0.0)
    user_f = unpacked(y, "user", "s", "p", r @ (w * sig[None, :]))                     # U Σ
    item_f = unpacked(z, "item", "s", "q", w * inv[None, :])                           # V
    return FactorModel(user_f, item_f, k, 0.0, bias,
                       params=dict(k=k, n_iter=n_iter, oversample=oversample, seed=seed,
                                   singular_values=sig.tolist()))


# ================================================================== the full grid

USERS_PER_BLOCK = 50_000
ITEMS_PER_BLOCK = 20_000


def grid_blocks(users: DataFrame, items: DataFrame, block, schema: str) -> DataFrame:
    """``block(users, items)`` for every pair of a user block and an item block."""
    par = users.sparkSession.sparkContext.defaultParallelism
    nu = max(2 * par, math.ceil(users.count() / USERS_PER_BLOCK))
    nb = max(1, math.ceil(items.count() / ITEMS_PER_BLOCK))
    ur = (users.withColumn("ub", block_of("user", nu))
          .withColumn("ib", F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))))
    ir = (items.withColumn("ib", block_of("item", nb))
          .withColumn("ub", F.explode(F.sequence(F.lit(0), F.lit(nu - 1)))))
    return ur.groupBy("ub", "ib").cogroup(ir.groupBy("ub", "ib")).applyInPandas(block, schema)
