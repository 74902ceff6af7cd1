"""Offline evaluation (M1-M10).  Every metric is one aggregation; nothing is
collected per user on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _valid(c: str):
    return F.col(c).isNotNull() & ~F.isnan(c)


def rmse_mae(pred: DataFrame, score_col: str = "score", actual_col: str = "rating",
             ignore_na: bool = True) -> DataFrame:
    """M1, M2, M9: RMSE and MAE over the scored rows; ``ignore_na=False`` fills a
    missing score with the mean score (a one-row aggregate, broadcast); the scores are
    written once for it, not computed a second time."""
    p = F.col(score_col)
    if not ignore_na:
        pred = cut_lineage(pred.select(score_col, actual_col))
        mean = pred.agg(F.avg(F.when(_valid(score_col), p)).alias("_m"))
        pred = pred.crossJoin(F.broadcast(mean)).withColumn(
            score_col, F.when(_valid(score_col), p).otherwise(F.col("_m")))
    err = F.when(_valid(score_col), F.col(score_col) - F.col(actual_col))
    return pred.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
                    F.count(err).alias("n_scored"), F.count(F.lit(1)).alias("n"))


def assert_unique_pairs(df: DataFrame) -> None:
    if df.groupBy("user", "item").count().where(F.col("count") > 1).limit(1).count() > 0:
        raise ValueError("(user, item) is not unique")


def precision_recall_at_k(pred: DataFrame, k: int | None = 10, threshold: float = 3.5,
                          score_col: str = "score", actual_col: str = "rating",
                          check_unique: bool = True) -> DataFrame:
    """M3 per user: relevant = actual > threshold; recommended = score > threshold,
    the k best (score desc, item asc); precision = |rel ∩ rec| / |rec|, recall =
    |rel ∩ rec| / |rel|, 0 when a denominator is 0."""
    if check_unique:
        assert_unique_pairs(pred)
    rec = pred.where(_valid(score_col) & (F.col(score_col) > threshold))
    if k is not None:
        w = Window.partitionBy("user").orderBy(F.col(score_col).desc(), F.col("item"))
        rec = rec.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k)
    flags = pred.select("user", "item", (F.col(actual_col) > threshold).alias("_rel")).join(
        rec.select("user", "item", F.lit(True).alias("_rec")), ["user", "item"], "left")
    per = flags.groupBy("user").agg(
        F.sum(F.when(F.col("_rel"), 1).otherwise(0)).alias("n_rel"),
        F.sum(F.when(F.col("_rec").isNotNull(), 1).otherwise(0)).alias("n_rec"),
        F.sum(F.when(F.col("_rel") & F.col("_rec").isNotNull(), 1).otherwise(0)).alias("n_hit"))
    return per.select(
        "user",
        F.when(F.col("n_rec") > 0, F.col("n_hit") / F.col("n_rec")).otherwise(F.lit(0.0)).alias("precision"),
        F.when(F.col("n_rel") > 0, F.col("n_hit") / F.col("n_rel")).otherwise(F.lit(0.0)).alias("recall"))


def pooled_precision_recall(recs: DataFrame, test: DataFrame, threshold: float = 3.5) -> DataFrame:
    """M4, M5 (standard definitions, Q8): over the users that received
    recommendations, precision = hits / recommended, recall = hits / relevant."""
    r = recs.select("user", "item").distinct()
    users = r.select("user").distinct()
    rel = test.where(F.col("rating") > threshold).select("user", "item").distinct().join(users, "user", "left_semi")
    one, zero = F.lit(1), F.lit(0)
    tagged = (r.select(one.alias("_rec"), zero.alias("_rel"), zero.alias("_hit"))
              .unionByName(rel.select(zero.alias("_rec"), one.alias("_rel"), zero.alias("_hit")))
              .unionByName(r.join(rel, ["user", "item"], "left_semi")
                           .select(zero.alias("_rec"), zero.alias("_rel"), one.alias("_hit"))))
    out = tagged.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(a)
                       for c, a in (("_hit", "hits"), ("_rec", "n_recommended"), ("_rel", "n_relevant"))])
    return out.select(
        "hits", "n_recommended", "n_relevant",
        F.when(F.col("n_recommended") > 0, F.col("hits") / F.col("n_recommended")).otherwise(0.0).alias("precision"),
        F.when(F.col("n_relevant") > 0, F.col("hits") / F.col("n_relevant")).otherwise(0.0).alias("recall"))


def coverage(recs: DataFrame, all_items: DataFrame) -> DataFrame:
    """M6: distinct recommended items / all items."""
    tagged = recs.select("item", F.lit(True).alias("_r")).unionByName(all_items.select("item", F.lit(False).alias("_r")))
    out = tagged.agg(F.countDistinct(F.when(F.col("_r"), F.col("item"))).alias("n_recommended_items"),
                     F.countDistinct(F.when(~F.col("_r"), F.col("item"))).alias("n_items"))
    return out.withColumn("coverage", F.col("n_recommended_items") / F.col("n_items"))


def mean_popularity(recs: DataFrame, train: DataFrame) -> DataFrame:
    """M7: avg ln(1 + popularity) over all recommendation rows; popularity = number
    of training ratings of the item, 0 when unknown."""
    pop = train.groupBy("item").agg(F.count(F.lit(1)).alias("_pop"))
    return (recs.select("item").join(pop, "item", "left")
            .agg(F.avg(F.log1p(F.coalesce(F.col("_pop"), F.lit(0)).cast("double"))).alias("popularity")))


def fit_error(predict, ratings: DataFrame) -> DataFrame:
    """M8: RMSE / MAE of a fitted model on its observed training cells;
    ``predict(pairs)`` returns the pairs with a ``score`` column."""
    return rmse_mae(predict(ratings.select("user", "item", "rating")))


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles (exact) of one column."""
    q = F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
                   F.min(column).alias("min"), F.max(column).alias("max"), q.alias("_q"))
            .select("n", "mean", "std", "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"),
                    F.col("_q")[2].alias("q75"), "max"))
