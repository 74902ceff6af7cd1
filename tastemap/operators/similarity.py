"""Item-item and user-user similarities (C1-C5), as sparse long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blockmm import self_product
from .prep import demean, l2_normalize


def _normalized(ratings: DataFrame, by: str) -> DataFrame:
    """Demean (damping 0) then L2-normalise per ``by``; norms over all its cells."""
    return l2_normalize(demean(ratings, by, "rating", 0.0), by, "rating", "norm")


def _of_wanted(prod: DataFrame, i: str, j: str) -> DataFrame:
    return prod.withColumnsRenamed({"a": i, "b": j, "xy": "sim"})


def item_similarity(ratings: DataFrame, min_sim: float | None = None,
                    popularity: float = 0.0, wanted: DataFrame | None = None, n_wanted: int = 0) -> DataFrame:
    """(i, j, sim) with sim = dot product of the per-item demeaned and
    normalised rating columns; both orders and the diagonal.  With popularity p > 0
    sim is scaled by (‖i‖·‖j‖)^p and only sim > 0 is kept (threshold forced to 0).
    ``min_sim`` keeps sim > min_sim only (applied before anything is persisted).  ``wanted``
    (i, j, ...; about ``n_wanted`` rows): its rows with sim, those whose pair has none left out."""
    x = _normalized(ratings, "item")
    if popularity > 0:
        # Σ (x_a ‖a‖^p)(x_b ‖b‖^p): the sums come out scaled, no pair is joined with its norms
        x = x.withColumn("rating", F.col("rating") * F.pow("norm", F.lit(float(popularity))))
        min_sim = 0.0
    if wanted is not None:
        return _of_wanted(self_product(x, "user", "item", "rating", min_xy=min_sim,
                                       wanted=wanted.withColumnsRenamed({"i": "a", "j": "b"}), n_wanted=n_wanted), "i", "j")
    prod = self_product(x, "user", "item", "rating", min_xy=min_sim)
    return prod.select(F.col("a").alias("i"), F.col("b").alias("j"), F.col("xy").alias("sim"))


def user_similarity(ratings: DataFrame, min_sim: float | None = None, wanted: DataFrame | None = None, n_wanted: int = 0) -> DataFrame:
    """(u, v, sim) on per-user demeaned and normalised rating rows.  ``wanted`` (u, v, ...; about
    ``n_wanted`` rows): its rows with sim, those whose pair has none left out."""
    x = _normalized(ratings, "user")
    if wanted is not None:
        return _of_wanted(self_product(x, "item", "user", "rating", min_xy=min_sim,
                                       wanted=wanted.withColumnsRenamed({"u": "a", "v": "b"}), n_wanted=n_wanted), "u", "v")
    prod = self_product(x, "item", "user", "rating", min_xy=min_sim)
    return prod.select(F.col("a").alias("u"), F.col("b").alias("v"), F.col("xy").alias("sim"))


def self_similarity_check(ratings: DataFrame, by: str = "user", eps: float = 1e-6) -> DataFrame:
    """C4: ids whose diagonal Σx² of the normalised rows differs from 1 by more
    than eps (constant raters have 0)."""
    x = _normalized(ratings, by)
    diag = x.groupBy(by).agg(F.sum(F.col("rating") * F.col("rating")).alias("diag"))
    return diag.where((F.col("diag") > 1 + eps) | (F.col("diag") < 1 - eps))


def corated_cosine(ratings: DataFrame, by: str = "user", min_support: int = 5) -> DataFrame:
    """Cosine over co-rated cells only, between rows ``by`` (users by default):
    Σxy / sqrt(Σx²·Σy²) with all sums over the common columns; pairs with fewer than
    ``min_support`` common columns are 0 (not emitted); the diagonal is 1."""
    other = "item" if by == "user" else "user"
    prod = self_product(ratings, other, by, "rating", squares=True, min_n=min_support)
    off = prod.where(F.col("a") != F.col("b")).select(
        "a", "b", (F.col("xy") / F.sqrt(F.col("xx") * F.col("yy"))).alias("sim"), "n")
    diag = ratings.select(F.col(by).alias("a")).distinct().select(
        "a", F.col("a").alias("b"), F.lit(1.0).alias("sim"), F.lit(None).cast("long").alias("n"))
    return off.unionByName(diag)
