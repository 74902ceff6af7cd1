import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from tastemap.operators import prep as T


def test_normalize_drops_zero_and_casts(spark):
    df = spark.createDataFrame([("1", "2", "0"), ("1", "3", "4")], "u string, i string, r string")
    out = T.normalize_ratings(df, "u", "i", "r")
    assert out.schema.simpleString() == "struct<user:bigint,item:bigint,rating:double>"
    assert rows(out, "user", "item", "rating") == [(1, 3, 4.0)]


def test_sum_duplicates_and_positions(spark):
    df = spark.createDataFrame([(5, 7, 1.0), (5, 7, 2.0), (9, 3, 4.0)], "user long, item long, rating double")
    m, users, items = T.index_ratings(df)
    assert rows(m, "user", "item", "rating", "user_pos", "item_pos") == [(5, 7, 3.0, 0, 1), (9, 3, 4.0, 1, 0)]


def test_coverage_check_raises(spark, ratings_df):
    idx = spark.createDataFrame([(1,), (2,)], "user long")
    try:
        T.assert_covers(ratings_df, idx, "user")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_split_round_half_even(spark):
    # 0.1 * n for n = 5, 15, 25, 35 -> 0, 2, 2, 4 test rows
    data = [(u, i, 1.0) for u, n in [(1, 5), (2, 15), (3, 25), (4, 35)] for i in range(n)]
    df = spark.createDataFrame(data, "user long, item long, rating double")
    s = T.split_per_group(df, 0.1, "user", 1)
    got = dict((r["user"], r["c"]) for r in s.where("is_test").groupBy("user").agg(F.count("*").alias("c")).collect())
    assert got.get(1, 0) == 0 and got[2] == 2 and got[3] == 2 and got[4] == 4
    train, test = T.train_test(s)
    assert train.count() + test.count() == df.count()


def test_split_global_exact_matches_sort(spark):
    data = [(u, i, 1.0) for u in range(40) for i in range(25)]
    df = spark.createDataFrame(data, "user long, item long, rating double")
    s = T.split_global(df, 0.2, 3)
    h = df.withColumn("h", F.conv(F.substring(F.md5(F.concat_ws(":", "user", "item", F.lit(3))), 1, 8), 16, 10)
                      .cast("long")).toPandas()
    want = set(map(tuple, h.sort_values(["h", "user", "item"]).head(round(0.2 * len(h)))[["user", "item"]].values))
    got = set(rows(s.where("is_test"), "user", "item"))
    assert got == want


def test_minibatch_ids(spark):
    df = spark.createDataFrame([(u, i) for u in range(3) for i in range(5)], "user long, item long")
    b = T.minibatch_ids(df, ["user", "item"], 4)
    got = [r[2] for r in rows(b, "user", "item", "batch_id")]
    assert got == [i // 4 for i in range(15)]
    try:
        T.minibatch_ids(df, ["user", "item"], 0)
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_negative_samples_cap_and_disjoint(spark, ratings_df):
    out = T.negative_samples(ratings_df, seed=1).toPandas()
    pos = out[out.label == 1]
    neg = out[out.label == 0]
    assert len(pos) == ratings_df.count()
    for u, g in neg.groupby("user"):
        assert len(g) <= len(pos[pos.user == u])
    assert not set(map(tuple, neg[["user", "item"]].values)) & set(map(tuple, pos[["user", "item"]].values))
    assert not neg.duplicated(["user", "item"]).any()


def test_demean_and_norm(spark, ratings_df):
    d = T.demean(ratings_df, "user", damping=0.0).toPandas()
    assert np.allclose(d.groupby("user").rating.sum(), 0)
    n = T.l2_normalize(d.pipe(lambda x: spark.createDataFrame(x[["user", "item", "rating"]])), "user").toPandas()
    norms = n.groupby("user").rating.apply(lambda v: float(np.sqrt((v ** 2).sum())))
    assert np.isclose(norms[1], 1) and np.isclose(norms[3], 0)   # constant rater keeps 0 (norm 1)


def test_align_scores_keeps_unknown(spark):
    pairs = spark.createDataFrame([(1, 1), (1, 99)], "user long, item long")
    scores = spark.createDataFrame([(1, 1, 2.5)], "user long, item long, score double")
    got = rows(T.align_scores(pairs, scores), "user", "item", "score")
    assert got == [(1, 1, 2.5), (1, 99, None)]


def test_hot_group_selection_equals_window(spark):
    # one user with a third of all rows; the histogram path must equal the window
    data = [(1, i, 1.0) for i in range(300)] + [(u, i, 1.0) for u in range(2, 40) for i in range(15)]
    df = spark.createDataFrame(data, "user long, item long, rating double")
    a = rows(T.split_per_group(df, 0.3, "user", 1), "user", "item", "is_test")
    b = rows(T.split_per_group(df, 0.3, "user", 1, limit=20), "user", "item", "is_test")
    assert a == b
    assert sum(1 for r in a if r[0] == 1 and r[2]) == 90
    na = rows(T.negative_samples(df, seed=2), "user", "item", "label")
    nb = rows(T.negative_samples(df, seed=2, limit=20), "user", "item", "label")
    assert na == nb


def test_explode_range_chunks_hot_rows(spark):
    df = spark.createDataFrame([(1, 250_003), (2, 3), (3, 0)], "user long, n long")
    out = T.explode_range(df, ["user"], F.lit(1), F.col("n"), "d", chunk=1000)
    got = {r["user"]: (r["c"], r["lo"], r["hi"]) for r in
           out.groupBy("user").agg(F.count("*").alias("c"), F.min("d").alias("lo"), F.max("d").alias("hi")).collect()}
    assert got == {1: (250_003, 1, 250_003), 2: (3, 1, 3)}        # empty range: no rows
    assert out.groupBy("d", "user").count().where("count > 1").count() == 0
    assert out.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_split_invariants_property(spark):
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=4, deadline=None)
    @given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 40)), min_size=1, max_size=80, unique=True),
           st.sampled_from([0.1, 0.25, 0.5]), st.integers(0, 9))
    def check(pairs, frac, seed):
        df = spark.createDataFrame([(u, i, 1.0) for u, i in pairs], "user long, item long, rating double")
        s = T.split_per_group(df, frac, "user", seed).toPandas()
        assert len(s) == len(pairs)                                   # train ∪ test = ratings, disjoint
        for u, g in s.groupby("user"):
            assert int(g.is_test.sum()) == int(round(frac * len(g)))  # Python round: half to even
    check()


def test_negative_draws_are_never_broadcast(spark, monkeypatch, capsys):
    """the draws (many times the users) once went to the driver, as their size before the explode is small."""
    import re
    df = spark.createDataFrame([(u, (7 * u + k) % 900) for u in range(300) for k in range(10)], "user long, item long")
    want = None
    for most in (10 ** 6, 0):
        monkeypatch.setattr(T, "BROADCAST_ITEMS", most)
        neg = T.negative_samples(df)
        got = sorted(tuple(r) for r in neg.collect())
        neg.explain()
        plan = capsys.readouterr().out.split("Initial Plan")[0]
        joins = re.findall(r"(\w+Join) \[item_pos#\d+L?\], \[item_pos#\d+L?\](.*)", plan)
        assert joins and all(("BuildRight" in rest) if most else kind == "SortMergeJoin" for kind, rest in joins), joins
        assert want is None or got == want
        want = got


def test_negative_draws_are_the_first_of_each_user(spark):
    # by hand: draws 1..5n of md5(user:draw:seed); a null user has no known items, a null item is never known
    import hashlib
    cells = [(u, i) for u in (1, 2, None) for i in (10, 20, 30, None)] + [(5, 10), (6, 40)]
    df = spark.createDataFrame([(*c, 1.0) for c in cells], "user long, item long, rating double")
    index = sorted({i for _, i in cells}, key=lambda i: (i is not None, i or 0))
    want = []
    for u in {u for u, _ in cells}:
        known = {i for v, i in cells if v == u and i is not None and u is not None}
        n, got = sum(v == u for v, _ in cells), []
        for d in range(1, 5 * n + 1):
            text = ":".join(str(x) for x in (u, d, 3) if x is not None)
            item = index[int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % len(index)]
            if item not in known and item not in got and len(got) < n:
                got.append(item)
        want += [(u, i) for i in got]
    for limit in (T.GROUP_ROWS, 3):                            # 3: some users' draws are dealt over the tasks
        neg = T.negative_samples(df, seed=3, limit=limit).where("label = 0")
        assert sorted(((r["user"], r["item"]) for r in neg.collect()), key=str) == sorted(want, key=str)


def test_negative_draws_end_when_there_are_enough(spark, capsys):
    df = spark.createDataFrame([(1, i, 1.0) for i in range(50)], "user long, item long, rating double")
    T.negative_samples(df).explain()
    assert "sequence(" not in capsys.readouterr().out.lower()  # the 5 n draws of a user are no rows
    known, made = set(range(900)), []

    class Known(set):
        def __contains__(self, at):
            made.append(at)
            return at in known
    assert len(T._distinct_draws(b"1:", b":1", 5000, 3, 1000, Known())) == 3 and len(made) < 100
