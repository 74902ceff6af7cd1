import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tastemap.operators.blockmm import self_product
from tastemap.operators.knn import KnnParams, item_knn_predict, item_knn_recommend, user_knn_predict
from tastemap.operators.similarity import (corated_cosine, item_similarity, self_similarity_check,
                                           user_similarity)


def _random_ratings(seed=0, users=25, items=30, n=250):
    rng = np.random.default_rng(seed)
    d = {}
    for u, i in zip(rng.integers(0, users, n), rng.integers(0, items, n)):
        d[(int(u), int(i))] = float(rng.integers(1, 6))
    d[(99, 0)] = d[(99, 1)] = d[(99, 2)] = 3.0      # a constant rater
    return pd.DataFrame([(u, i, r) for (u, i), r in d.items()], columns=["user", "item", "rating"])


def _dense(pdf):
    us, its = sorted(int(x) for x in pdf.user.unique()), sorted(int(x) for x in pdf.item.unique())
    m = np.zeros((len(us), len(its)))
    for u, i, r in pdf.itertuples(index=False):
        m[us.index(u), its.index(i)] = r
    return us, its, m


def _normalized(m, axis):
    """Demean (damping 0) and L2-normalise rows (axis=1) or columns (axis=0) over present cells."""
    x = m.copy() if axis == 1 else m.T.copy()
    for r in range(x.shape[0]):
        nz = x[r] != 0
        if nz.any():
            x[r, nz] -= x[r, nz].mean()
            n = np.linalg.norm(x[r, nz])
            if n > 0:
                x[r, nz] /= n
    return x if axis == 1 else x.T


def test_block_product_any_blocking(spark):
    pdf = _random_ratings()
    df = spark.createDataFrame(pdf)
    us, its, m = _dense(pdf)
    want = m.T @ m
    for mb, gb in [(1, 1), (3, 1), (4, 3)]:
        got = self_product(df, "user", "item", "rating", member_blocks=mb, group_blocks=gb).toPandas()
        for a, b, xy in got[["a", "b", "xy"]].itertuples(index=False):
            assert np.isclose(xy, want[its.index(a), its.index(b)])
        nz = int(((m != 0).astype(int).T @ (m != 0).astype(int) > 0).sum())
        assert len(got) == nz


def test_item_and_user_similarity(spark):
    pdf = _random_ratings(1)
    df = spark.createDataFrame(pdf)
    us, its, m = _dense(pdf)
    xi = _normalized(m, 0)
    si = xi.T @ xi
    got = item_similarity(df).toPandas()
    assert all(np.isclose(s, si[its.index(i), its.index(j)]) for i, j, s in got.itertuples(index=False))
    assert (got.sim.abs() <= 1 + 1e-9).all()
    xu = _normalized(m, 1)
    su = xu @ xu.T
    got = user_similarity(df, min_sim=0.1).toPandas()
    assert all(s > 0.1 and np.isclose(s, su[us.index(u), us.index(v)]) for u, v, s in got.itertuples(index=False))
    assert len(got) == int((su > 0.1).sum())
    diag = rows(self_similarity_check(df, "user"), "user")
    assert diag == [(99,)]


def test_corated_cosine(spark):
    pdf = _random_ratings(2)
    df = spark.createDataFrame(pdf)
    us, its, m = _dense(pdf)
    got = {(a, b): s for a, b, s in rows(corated_cosine(df, "user", 2).select("a", "b", "sim"), "a", "b", "sim")}
    for x in range(len(us)):
        assert got[(us[x], us[x])] == 1.0
        for y in range(len(us)):
            if x == y:
                continue
            common = (m[x] != 0) & (m[y] != 0)
            if common.sum() >= 2:
                a, b = m[x, common], m[y, common]
                assert np.isclose(got[(us[x], us[y])], a @ b / np.sqrt((a @ a) * (b @ b)))
            else:
                assert (us[x], us[y]) not in got


def _knn_brute(m, sim, pairs, p: KnnParams, us, its, kind, bias=None):
    out = {}
    for u, t in pairs:
        if u not in us or t not in its:
            out[(u, t)] = None
            continue
        ui, ti = us.index(u), its.index(t)
        if kind == "user":
            cand = [(sim[ui, v], us[v], m[v, ti], v) for v in range(len(us)) if m[v, ti] != 0]
            own = bias[ui] if bias is not None else 0.0
        else:
            cand = [(sim[ti, j], its[j], m[ui, j], j) for j in range(len(its)) if m[ui, j] != 0]
            own = bias[ti] if bias is not None else 0.0
        thr = p.min_threshold
        if p.inclusive:
            cand = [c for c in cand if round(c[0], 9) >= (0.0 if thr is None else thr)]
        elif thr is not None:
            cand = [c for c in cand if round(c[0], 9) > thr]
        cand.sort(key=lambda c: (-round(c[0], 9), c[1]))
        cand = cand[: p.max_nn]
        den = sum(abs(c[0]) if p.denominator == "abs" else c[0] for c in cand)
        if len(cand) < p.min_nn or den <= 0:
            out[(u, t)] = None
            continue
        nb = (lambda c: bias[c[3]]) if bias is not None else (lambda c: 0.0)
        out[(u, t)] = own + sum((c[2] - nb(c)) * c[0] for c in cand) / den
    return out


def _check(got, want):
    assert set(got) == set(want)
    for k, v in want.items():
        assert (v is None and got[k] is None) or np.isclose(got[k], v), (k, got[k], v)


def test_user_knn_variants(spark):
    pdf = _random_ratings(3)
    df = spark.createDataFrame(pdf)
    us, its, m = _dense(pdf)
    xu = _normalized(m, 1)
    su = xu @ xu.T
    pairs = [(u, i) for u in us[:8] for i in its] + [(12345, its[0]), (us[0], 777)]
    pdf_pairs = spark.createDataFrame(pairs, "user long, item long")
    bias = np.linspace(-0.5, 0.5, len(us))
    ub = spark.createDataFrame([(u, float(b)) for u, b in zip(us, bias)], "user long, bu double")
    for p, b in [(KnnParams(min_nn=2, max_nn=3, min_threshold=0.1), ub),
                 (KnnParams(min_nn=1, max_nn=4, inclusive=True), None),
                 (KnnParams(min_nn=1, max_nn=4, denominator="abs"), None),
                 (KnnParams(min_nn=1, max_nn=50), None), (KnnParams(min_nn=1, max_nn=3), ub),
                 (KnnParams(min_nn=3, max_nn=4, inclusive=True), ub), (KnnParams(min_nn=2, max_nn=6, min_threshold=-0.3), None),
                 (KnnParams(min_nn=2, max_nn=6, min_threshold=-0.3, inclusive=True, denominator="abs"), ub)]:
        got = {(u, i): s for u, i, s in rows(user_knn_predict(df, pdf_pairs, p, user_bias=b), "user", "item", "score")}
        _check(got, _knn_brute(m, su, pairs, p, us, its, "user", bias if b is not None else None))


def test_item_knn_and_recommend(spark):
    pdf = _random_ratings(4)
    df = spark.createDataFrame(pdf)
    us, its, m = _dense(pdf)
    xi = _normalized(m, 0)
    si = xi.T @ xi
    pairs = [(u, i) for u in us for i in its]
    pp = spark.createDataFrame(pairs, "user long, item long")
    bias = np.linspace(0.3, -0.3, len(its))
    ib = spark.createDataFrame([(i, float(b)) for i, b in zip(its, bias)], "item long, bi double")
    for p, b in [(KnnParams(min_nn=1, max_nn=3, min_threshold=0.05), None),
                 (KnnParams(min_nn=2, max_nn=5, min_threshold=0.0), ib),
                 (KnnParams(min_nn=1, max_nn=5), None), (KnnParams(min_nn=3, max_nn=4, inclusive=True), ib),
                 (KnnParams(min_nn=2, max_nn=6, denominator="abs"), ib)]:
        got = {(u, i): s for u, i, s in rows(item_knn_predict(df, pp, p, item_bias=b), "user", "item", "score")}
        _check(got, _knn_brute(m, si, pairs, p, us, its, "item", bias if b is not None else None))
    # recommend-all = top-n of the scored unrated pairs
    p = KnnParams(min_nn=1, max_nn=3, min_threshold=0.05)
    want = _knn_brute(m, si, pairs, p, us, its, "item")
    recs = item_knn_recommend(df, 3, p, score_digits=6).toPandas()
    for u in us:
        cand = [(-round(s, 6), i) for (uu, i), s in want.items() if uu == u and s is not None
                and m[us.index(u), its.index(i)] == 0]
        assert recs[recs.user == u].sort_values("rank").item.tolist() == [i for _, i in sorted(cand)[:3]]


def test_block_product_heavy_group_path(spark, monkeypatch):
    from tastemap.operators import blockmm
    pdf = _random_ratings(5)
    heavy = pd.DataFrame([(500, i, float(1 + i % 5)) for i in range(30)], columns=["user", "item", "rating"])
    pdf = pd.concat([pdf, heavy], ignore_index=True)
    df = spark.createDataFrame(pdf)
    us, its, m = _dense(pdf)
    want = m.T @ m
    monkeypatch.setattr(blockmm, "ROWS_PER_TASK", 80)     # user 500 (30 rows) is "heavy" (> 20)
    got = self_product(df, "user", "item", "rating").toPandas()
    assert len(got) == int(((m != 0).astype(int).T @ (m != 0).astype(int) > 0).sum())
    for a, b, xy in got[["a", "b", "xy"]].itertuples(index=False):
        assert np.isclose(xy, want[its.index(a), its.index(b)])


def test_popular_items_are_not_joined_on_the_item_alone(spark, capsys):
    import re
    df = spark.createDataFrame(_random_ratings(3))
    for p in (KnnParams(inclusive=True), KnnParams(denominator="abs")):
        user_knn_predict(df, df.select("user", "item"), p).explain()
        joins = re.findall(r"Join \[([^\]]*)\]", capsys.readouterr().out)
        assert joins and not [j for j in joins if re.fullmatch(r"t#\d+L?", j)]


def test_block_product_sends_half_of_each_group(spark, monkeypatch):
    """rows are sent once per block that pairs them, not once per block there is."""
    from tastemap.operators import blockmm
    pdf = _random_ratings(6)
    df = spark.createDataFrame(pdf)
    us, its, m = _dense(pdf)
    groups = df.groupBy("user").agg(F.collect_list(F.struct(F.col("item").alias("m"), F.col("rating").alias("x"))).alias("cells"))
    sent = groups.select("cells").mapInArrow(blockmm._send(1000, np.zeros(0, np.int64)), blockmm._SENT)
    cells = sent.agg(F.sum(F.length("x") / 8)).first()[0]
    k = pdf.groupby("user").size().to_numpy()
    assert cells <= (k * (k + 1) / 2).sum()
    want = m.T @ m
    monkeypatch.setattr(blockmm, "BLOCK_PAIRS", 50)
    monkeypatch.setattr(blockmm, "PAIR_CHUNK", 7)
    monkeypatch.setattr(blockmm, "MERGE_CODES", 20)
    monkeypatch.setattr(blockmm, "HOT_ROWS", 8)           # several items have blocks of their own
    got = self_product(df, "user", "item", "rating", min_xy=10.0, min_n=2, squares=True).toPandas()
    both = (m != 0).astype(int).T @ (m != 0).astype(int)
    assert len(got) == int(((want > 10) & (both >= 2)).sum()) and not got.duplicated(["a", "b"]).any()
    for a, b, xy, xx, yy, n in got.itertuples(index=False):
        i, j = its.index(a), its.index(b)
        common = (m[:, i] != 0) & (m[:, j] != 0)
        assert np.isclose(xy, want[i, j]) and n == both[i, j]
        assert np.isclose(xx, (m[common, i] ** 2).sum()) and np.isclose(yy, (m[common, j] ** 2).sum())


def test_block_product_wide_and_null_members(spark):
    rows_ = [(1, 2 ** 40, 2.0), (1, -5, 3.0), (1, None, 4.0), (2, None, 1.0), (2, -5, 2.0), (None, -5, 1.0), (None, 7, 5.0)]
    got = self_product(spark.createDataFrame(rows_, "g long, m long, x double"), "g", "m", "x").collect()
    assert {(r["a"], r["b"]): (r["xy"], r["n"]) for r in got} == {
        (2 ** 40, 2 ** 40): (4.0, 1), (2 ** 40, -5): (6.0, 1), (-5, 2 ** 40): (6.0, 1), (2 ** 40, None): (8.0, 1),
        (None, 2 ** 40): (8.0, 1), (-5, -5): (14.0, 3), (-5, None): (14.0, 2), (None, -5): (14.0, 2), (None, None): (17.0, 2),
        (-5, 7): (5.0, 1), (7, -5): (5.0, 1), (7, 7): (25.0, 1)}


def test_block_product_of_nothing(spark):
    assert self_product(spark.createDataFrame([], "g long, m long, x double"), "g", "m", "x").count() == 0


def test_popularity_scales_the_cells_and_joins_no_pairs(spark, capsys):
    """similarities were joined with the norms twice, a shuffle of all pairs each."""
    pdf = _random_ratings(7)
    us, its, m = _dense(pdf)
    sims = item_similarity(spark.createDataFrame(pdf), popularity=0.5)
    sims.explain()
    plan = capsys.readouterr().out
    assert plan.index("FlatMapGroupsInArrow") < (plan.find("Join") if "Join" in plan else len(plan))
    xi = _normalized(m, 0)
    centred = np.where(m != 0, m - m.sum(0) / np.maximum((m != 0).sum(0), 1), 0.0)
    norm = np.linalg.norm(centred, axis=0)
    norm[norm == 0] = 1.0
    want = (xi.T @ xi) * np.sqrt(np.outer(norm, norm))
    got = {(i, j): s for i, j, s in sims.where(F.round("sim", 9) > 0).collect()}
    assert set(got) == {(its[a], its[b]) for a, b in zip(*np.nonzero(np.round(want, 9) > 0))}
    assert all(np.isclose(s, want[its.index(i), its.index(j)]) for (i, j), s in got.items())


def test_requests_do_not_meet_every_similarity_of_their_anchor(spark, capsys):
    """requests were joined with all positive and all negative similarities on the anchor alone."""
    import re
    df = spark.createDataFrame(_random_ratings(8))
    pairs = df.select("user", "item")
    user_knn_predict(df, pairs, KnnParams(denominator="abs")).explain()
    user_knn_predict(df, pairs, KnnParams(inclusive=True)).explain()
    item_knn_predict(df, pairs, KnnParams(), popularity=0.5).explain()
    joins = re.findall(r"Join \[([^\]]*)\]", capsys.readouterr().out)
    assert joins and all("," in j for j in joins), joins


def test_neighbours_on_either_way(spark, monkeypatch):
    """from the ratings or, for popular items, from the similarities, once each."""
    from tastemap.operators import knn
    rng = np.random.default_rng(9)
    pdf = pd.concat([_random_ratings(9),
                     pd.DataFrame([(200 + u, 500, float(rng.integers(1, 6))) for u in range(30)]       # a popular item
                                  + [(200 + u, 501 + u, float(rng.integers(1, 6))) for u in range(30)]
                                  + [(300, 501, 2.0), (300, 502, 5.0)], columns=["user", "item", "rating"])], ignore_index=True)
    df = spark.createDataFrame(pdf)
    us, its, m = _dense(pdf)
    xu = _normalized(m, 1)
    su = xu @ xu.T
    pairs = [(u, t) for u in (0, 1, 99, 200, 300) for t in its]
    pp = spark.createDataFrame(pairs, "user long, item long")
    for few in (0, 1_000):
        monkeypatch.setattr(knn, "FEW_RATINGS", few)
        req = spark.createDataFrame([(300, 500), (0, 1)], "u long, t long")
        rated = df.select(F.col("user").alias("v"), F.col("item").alias("t"), F.col("rating").alias("r"))
        hits, sizes = knn._neighbours(req, user_similarity(df).select("u", "v", "sim"), rated, "u", "t", "v")
        got = [(r["u"], r["t"], r["v"]) for r in hits.where(F.abs("sim") > 1e-9).collect()]
        want = [(u, t, us[v]) for u, t in ((300, 500), (0, 1)) for v in range(len(us))
                if m[v, its.index(t)] != 0 and abs(su[us.index(u), v]) > 1e-9]
        assert sorted(got) == sorted(want) and any(t == 500 for _, t, _ in got)
        assert {(r["u"], r["t"]): r["_all"] for r in sizes.collect()} == {
            (u, t): int((m[:, its.index(t)] != 0).sum()) for u, t in ((300, 500), (0, 1))}
        for p in (KnnParams(max_nn=4, denominator="abs"), KnnParams(max_nn=4, inclusive=True)):
            scores = {(u, i): s for u, i, s in rows(user_knn_predict(df, pp, p), "user", "item", "score")}
            _check(scores, _knn_brute(m, su, pairs, p, us, its, "user"))


# ------------------------------------------------------------------ passes, wanted pairs, shuffle files

def _random_rows(spark, n=400):
    rng = np.random.default_rng(3)
    cells = {(int(g), int(m)) for g, m in zip(rng.integers(0, 40, n), rng.integers(0, 60, n))}
    return spark.createDataFrame([(g, m, float(rng.normal())) for g, m in sorted(cells)], "g long, m long, x double")


def test_product_in_passes_and_of_wanted_pairs_is_the_product(spark, monkeypatch):
    from tastemap.operators import blockmm
    x = _random_rows(spark)
    whole = {(r["a"], r["b"]): r["xy"] for r in blockmm.self_product(x, "g", "m", "x", min_xy=0.0).collect()}
    ask = [(a, b, n) for n, (a, b) in enumerate([(a, b) for a in range(62) for b in range(0, 62, 3)] * 2)]
    ask = spark.createDataFrame([*ask, (None, 3, -1), (3, None, -1)], "a long, b long, tag long")
    for pairs in (blockmm.PASS_PAIRS, 200):
        monkeypatch.setattr(blockmm, "PASS_PAIRS", pairs)
        assert {(r["a"], r["b"]): r["xy"] for r in blockmm.self_product(x, "g", "m", "x", min_xy=0.0).collect()} == pytest.approx(whole)
        got = {(r["tag"], r["a"], r["b"]): r["xy"] for r in blockmm.self_product(x, "g", "m", "x", min_xy=0.0, wanted=ask).collect()}
        assert got == pytest.approx({(r["tag"], r["a"], r["b"]): whole[r["a"], r["b"]] for r in ask.collect() if (r["a"], r["b"]) in whole})


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(n).getName() for n in range(files.size()) if files.apply(n).getName().startswith("shuffle_")}


def test_written_steps_leave_no_shuffle_files(spark):
    import time

    from tastemap.session import Rewritten, cut_lineage
    before = _shuffle_files(spark)
    table = spark.range(20_000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    kept, cut = Rewritten(spark, "test-steps").keep(table), cut_lineage(table)
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert sorted(kept.collect()) == sorted(cut.collect()) and kept.count() == 100
