"""Damped bias baseline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class BiasModel:
    mu: float
    item_bias: DataFrame   # (item, bi)   every item seen in training (bi = 0 when disabled)
    user_bias: DataFrame   # (user, bu)   every user seen in training (bu = 0 when disabled)
    params: dict

    def tables(self) -> dict[str, DataFrame]:
        return {"item_bias": self.item_bias, "user_bias": self.user_bias}


def global_mean(ratings: DataFrame) -> float:
    return float(ratings.agg(F.avg("rating")).first()[0])


def bias_fit(ratings: DataFrame, user_bias: bool = True, item_bias: bool = True,
             user_damping: float = 10.0, item_damping: float = 25.0) -> BiasModel:
    """mu = mean; b_i = sum(r - mu) / (item_damping + n_i) first, then
    b_u = sum(r - mu - b_i) / (user_damping + n_u).  Two aggregations and one join;
    mu is a scalar (one row), so nothing grows on the driver."""
    mu = global_mean(ratings)
    m = F.lit(mu)
    per_item = ratings.groupBy("item").agg(F.sum("rating").alias("s"), F.count(F.lit(1)).alias("n"))
    if item_bias:
        bi = per_item.select("item", ((F.col("s") - F.col("n") * m) / (F.lit(float(item_damping)) + F.col("n"))).alias("bi"))
    else:
        bi = per_item.select("item", F.lit(0.0).alias("bi"))
    if user_bias:
        resid = ratings.join(bi, "item").select("user", (F.col("rating") - m - F.col("bi")).alias("e"))
        bu = resid.groupBy("user").agg(
            (F.sum("e") / (F.lit(float(user_damping)) + F.count(F.lit(1)))).alias("bu"))
    else:
        bu = ratings.select("user").distinct().withColumn("bu", F.lit(0.0))
    return BiasModel(mu, bi, bu, dict(user_bias=user_bias, item_bias=item_bias,
                                      user_damping=user_damping, item_damping=item_damping))


def bias_predict(model: BiasModel, pairs: DataFrame, score_col: str = "score") -> DataFrame:
    """Mu + b_u + b_i; NULL when the user or the item is unknown.  Other pair
    columns (e.g. the actual rating) are kept."""
    return (pairs.join(model.user_bias, "user", "left").join(model.item_bias, "item", "left")
            .withColumn(score_col, F.lit(model.mu) + F.col("bu") + F.col("bi"))
            .drop("bu", "bi"))


def bias_residuals(model: BiasModel, ratings: DataFrame, value_col: str = "residual") -> DataFrame:
    """R - mu - b_i - b_u on the observed cells."""
    return (ratings.join(model.item_bias, "item").join(model.user_bias, "user")
            .select("user", "item", (F.col("rating") - F.lit(model.mu) - F.col("bi") - F.col("bu")).alias(value_col)))


def known_score(ratings: DataFrame, pairs: DataFrame, score_col: str = "score") -> DataFrame:
    """The existing rating of a pair, else NULL."""
    known = ratings.select("user", "item", F.col("rating").alias(score_col)).where(F.col(score_col) != 0)
    return pairs.join(known, ["user", "item"], "left")
