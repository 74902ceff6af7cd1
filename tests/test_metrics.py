import math

import numpy as np

from conftest import rows
from tastemap.operators import metrics as M


def test_rmse_mae_ignore_and_fill(spark):
    df = spark.createDataFrame([(1, 1, 3.0, 4.0), (1, 2, None, 2.0), (1, 3, 5.0, 5.0)],
                               "user long, item long, score double, rating double")
    r = M.rmse_mae(df).first()
    assert np.isclose(r["rmse"], math.sqrt(0.5)) and np.isclose(r["mae"], 0.5) and r["n_scored"] == 2
    f = M.rmse_mae(df, ignore_na=False).first()      # missing -> mean score 4.0, error 2
    assert np.isclose(f["rmse"], math.sqrt((1 + 4 + 0) / 3)) and f["n_scored"] == 3


def test_precision_recall_at_k(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0, 5.0), (1, 2, 4.0, 1.0), (1, 3, 1.0, 4.0), (2, 1, 1.0, 1.0)],
        "user long, item long, score double, rating double")
    got = {u: (p, r) for u, p, r in rows(M.precision_recall_at_k(df, k=10, threshold=3.5), "user", "precision", "recall")}
    assert got[1] == (0.5, 0.5) and got[2] == (0.0, 0.0)
    got1 = {u: (p, r) for u, p, r in rows(M.precision_recall_at_k(df, k=1, threshold=3.5), "user", "precision", "recall")}
    assert got1[1] == (1.0, 0.5)
    dup = df.unionByName(df)
    try:
        M.precision_recall_at_k(dup).collect()
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_pooled_coverage_popularity(spark):
    recs = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "user long, item long")
    test = spark.createDataFrame([(1, 1, 5.0), (1, 4, 5.0), (2, 3, 1.0), (3, 9, 5.0)],
                                 "user long, item long, rating double")
    p = M.pooled_precision_recall(recs, test, 3.5).first()
    assert p["hits"] == 1 and p["n_recommended"] == 3 and p["n_relevant"] == 2   # user 3 got no recs
    assert np.isclose(p["precision"], 1 / 3) and np.isclose(p["recall"], 0.5)
    train = spark.createDataFrame([(1, 1, 1.0), (2, 1, 1.0), (2, 2, 1.0), (3, 5, 1.0), (3, 6, 1.0)],
                                  "user long, item long, rating double")
    assert np.isclose(M.coverage(recs, train).first()["coverage"], 3 / 4)
    pop = M.mean_popularity(recs, train).first()["popularity"]
    assert np.isclose(pop, (math.log(3) + math.log(2) + math.log(1)) / 3)


def test_filled_scores_are_computed_once(spark):
    """the mean of the scores was a second run of the whole prediction."""
    seen = spark.sparkContext.accumulator(0)

    def score(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (None, 1.0)], "score double, rating double").coalesce(1)
    got = M.rmse_mae(df.mapInArrow(score, df.schema), ignore_na=False).first()
    assert seen.value == 3
    assert (got["n_scored"], got["n"]) == (3, 3) and abs(got["mae"] - 2 / 3) < 1e-12
