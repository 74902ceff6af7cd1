import random
import tracemalloc
import zlib

import numpy as np
import pytest

from tastemap.llm import quality, toxicity
from tastemap.llm.common import held_out
from tastemap.llm.features import gram_features, texts_of, words_of
from tastemap.llm.samples import labelled_sample

VOCAB = [f"word{i}" for i in range(150)]
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=900):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(VOCAB) for _ in range(rng.randint(20, 90))]
        toxic, good = int(rng.random() < 0.2), int(rng.random() < 0.7)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["nastyone", "uglytwo", "vilethree"]))
        text = ". ".join(" ".join(words[k:k + 9]).capitalize() for k in range(0, len(words), 9)) + "."
        if not good:
            text = rng.choice([text.upper() + "!!!", " | ".join(words), " ".join(w + "###" for w in words),
                               " ".join([words[0]] * 60)])
        docs.append((i, text))
        labels.append((i, good, toxic))
    return docs, labels


def is_held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def data():
    return corpus()


def test_held_out_rule(spark):
    from pyspark.sql import functions as F
    rows = spark.range(-5, 60).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == is_held(r["id"]) for r in rows)
    assert spark.range(1).select(held_out(F.lit(None).cast("long"))).first()[0] is True


def test_sample_never_holds_held_out_rows(spark, doc_frame, data):
    docs, labels = data
    lab = spark.createDataFrame([*labels, (3, None, 0), (None, 1, 1), (4, 1, 1), (4, 0, 0)], LABELS)
    got = labelled_sample(doc_frame(docs), lab, "toxic", 100, 1).collect()
    assert len(got) == 100 and not any(is_held(r["doc_id"]) for r in got)
    four = [r for r in labelled_sample(doc_frame(docs), lab, "toxic", 10_000, 1).collect() if r["doc_id"] == 4]
    assert [r["label"] for r in four] == [1]
    lab = spark.createDataFrame([(4, 0, 0), (4, 0, 1), (3, None, 0)], LABELS)
    got = {r["doc_id"]: r["label"] for r in labelled_sample(doc_frame(docs), lab, "toxic", 10, 1).collect()}
    assert got == {k: v for k, v in {4: 1, 3: 0}.items() if not is_held(k)}


def test_toxicity_on_held_out(spark, doc_frame, data):
    docs, labels = data
    lab = spark.createDataFrame(labels, LABELS)
    frame = doc_frame(docs)
    weights = toxicity.toxicity_fit(frame, lab)
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(frame, weights).collect()}
    held = [x for x in labels if is_held(x[0])]
    wrong = sum((scores[i] >= 0.5) != bool(t) for i, _, t in held)
    assert wrong <= 0.03 * len(held)
    assert weights.count() < 500                                       # sparse
    # labels of the held-out fold change nothing
    flipped = spark.createDataFrame([(i, q, 1 - t if is_held(i) else t) for i, q, t in labels], LABELS)
    a = sorted(map(tuple, weights.collect()))
    assert a == sorted(map(tuple, toxicity.toxicity_fit(frame, flipped).collect()))


def test_toxicity_edges(spark, doc_frame, data):
    docs, labels = data
    weights = toxicity.toxicity_fit(doc_frame(docs), spark.createDataFrame(labels, LABELS))
    odd = doc_frame([(1, None, "s", 9.0), (None, "", "s", 9.0), (2, "nastyone uglytwo vilethree", "s", 9.0),
                     (2, "nastyone uglytwo vilethree", "s", 9.0), (3, "plain " * 40_000, "s", 9.0)], ", score double")
    scores = toxicity.toxicity_scores(odd, weights, out="p").collect()
    by = {(r["doc_id"], r["text"] is None): r["p"] for r in scores}
    assert all(0 <= r["p"] <= 1 for r in scores) and len(scores) == 5
    assert by[(1, True)] == by[(None, False)] < 0.5 <= by[(2, False)]
    out = toxicity.drop_toxic(odd, spark.createDataFrame([], LABELS), threshold=0.51)
    assert out.columns == odd.columns and out.count() == 5             # no labels: nothing goes
    assert toxicity.toxicity_scores(doc_frame([]), weights).count() == 0


def test_without_usable_labels_nothing_is_dropped(spark, doc_frame, data):
    docs, labels = data
    frame = doc_frame(docs[:50])
    unusable = [[], [(i, 1, None) for i, _, _ in labels], [x for x in labels if is_held(x[0])]]
    for rows in unusable:
        kept = toxicity.drop_toxic(frame, spark.createDataFrame(rows, LABELS))
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, frame.collect()))


def test_ftrl_against_plain_loop():
    rng = random.Random(8)
    rows = [(np.array(sorted(rng.sample(range(16), 4))), rng.randint(0, 1)) for _ in range(200)]
    model = toxicity.Ftrl(4, 0.5, 1.0, 0.7, 0.1)
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        l1 = 0.0 if i == 16 else 0.7
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (1 if z[i] > 0 else -1) * l1) / ((1.0 + n[i] ** 0.5) / 0.5 + 0.1)
    for f, y in rows:
        model.learn(f, y)
        at = [*f.tolist(), 16]
        w = {i: weight(i) for i in at}
        g = 1 / (1 + np.exp(-sum(w.values()))) - y
        for i in at:
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5
            z[i] += g - sigma * w[i]
            n[i] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_scores_take_a_slice_of_a_batch_at_a_time(doc_frame, monkeypatch):
    import pyarrow as pa

    n = 5000
    column = pa.array([None if i % 7 == 0 else f"{i} " + "x" * 3000 for i in range(n)])
    assert list(texts_of(column)) == column.to_pylist()
    assert list(texts_of(column.slice(0, 0))) == []
    tracemalloc.start()
    assert sum(t is None for t in texts_of(column)) == len(range(0, n, 7))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < column.nbytes / 5

    def whole(*args, **kwargs):
        raise AssertionError("a whole batch of texts as Python strings")

    monkeypatch.setattr(toxicity.F, "pandas_udf", whole)
    weights = pa.table({"feature": pa.array([1 << toxicity.BITS], pa.int32()), "weight": [0.5]})
    rows = toxicity.toxicity_scores(doc_frame([(1, "a b"), (2, None)]), weights).collect()
    assert [round(r["score"], 9) for r in rows] == [round(1 / (1 + np.exp(-0.5)), 9)] * 2


def test_gram_features_count():
    assert len(gram_features(words_of("one two three four"), 20)) == 4 + 3 + 2 + 1
    assert len(gram_features([], 20)) == 0
    a, b = gram_features(["x", "y"], 20), gram_features(["y", "x"], 20)
    assert set(a[:2]) == set(b[:2]) and a[2] != b[2]


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    fm = quality.FactorisationMachine(6, 3)
    fm.w = rng.normal(size=64).astype(np.float32)
    fm.v = rng.normal(size=(64, 3)).astype(np.float32)
    fm.b = 0.3
    at, x = np.array([3, 10, 44, 60]), np.array([0.5, -1.0, 2.0, 0.25], dtype=np.float32)
    pairs = sum(float(fm.v[at[i]] @ fm.v[at[j]]) * x[i] * x[j] for i in range(4) for j in range(i))
    got, _ = fm.score(at, x, np.zeros(4, int), 1)
    assert abs(got[0] - (0.3 + float(fm.w[at] @ x) + pairs)) < 1e-4
    again = quality.FactorisationMachine.from_bytes(fm.to_bytes(), 6)
    assert np.array_equal(again.v, fm.v) and again.b == fm.b


def test_quality_gradient():
    """One small step lowers the loss of the batch it was taken on."""
    rng = np.random.default_rng(1)
    fm = quality.FactorisationMachine(5, 2)
    at, row = rng.integers(0, 32, 40), np.repeat(np.arange(8), 5)
    x, y = rng.random(40).astype(np.float32), rng.integers(0, 2, 8).astype(float)

    def loss():
        p = quality.sigmoid(fm.score(at, x, row, 8)[0])
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    before = loss()
    for _ in range(20):
        fm.learn(at, x, row, y, rate=0.02)
    assert loss() < before - 0.01


def test_quality_on_held_out_and_edges(spark, doc_frame, data):
    docs, labels = data
    frame = doc_frame(docs)
    model = quality.quality_fit(frame, spark.createDataFrame(labels, LABELS))
    scores = {r["doc_id"]: r["score"] for r in quality.quality_scores(frame, model).collect()}
    held = [x for x in labels if is_held(x[0])]
    wrong = sum((scores[i] >= quality.THRESHOLD) != bool(q) for i, q, _ in held)
    assert wrong <= 0.03 * len(held)
    odd = doc_frame([(1, None, "s", 1.0), (None, "", None, 1.0), (5, "z" * 100_000, "s", 2.0), (6, " \n \n", "s", 1.0),
                     (6, " \n \n", "s", 1.0)], ", score double")
    got = quality.quality_scores(odd, model, out="p").collect()
    assert len(got) == 5 and all(0 <= r["p"] <= 1 for r in got)
    assert quality.quality_scores(doc_frame([]), model).count() == 0
    untrained = quality.quality_fit(frame, spark.createDataFrame([], LABELS))
    assert all(abs(r["score"] - 0.5) < 0.2 for r in quality.quality_scores(frame, untrained).collect())


def test_without_labels_the_registered_query_predicts_0_below_one_half(doc_frame, spark, tmp_path):
    from tastemap.llm import registry
    doc_frame([(1, "some text"), (2, None), (None, "")]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = registry.QUERIES["op3_toxicity"](spark, str(tmp_path)).collect()
    assert len(got) == 3 and all(r["score"] < 0.5 and r["predicted"] == 0 for r in got)


def plain_grams(words, bits):
    """Buckets of words, pairs and skip-grams, one by one in whole numbers."""
    import xxhash
    mask = (1 << 64) - 1
    m1, m2, m3 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
    h = [xxhash.xxh64_intdigest(w.encode(), 0) for w in words]
    out = {(x * m1 & mask) >> (64 - bits) for x in h}
    for a, b in zip(h, h[1:]):
        x = (a * m1 + b * m2) & mask
        out.add(((x ^ (x >> 29)) * m3 & mask) >> (64 - bits))
    for gap in (2, 3):
        for a, b in zip(h, h[gap:]):
            x = (a * m2 + b * m3 + gap) & mask
            out.add(((x ^ (x >> 31)) * m1 & mask) >> (64 - bits))
    return out


def test_toxicity_scores_against_plain_sums(spark, doc_frame, data):
    import re
    docs, labels = data
    frame = doc_frame(docs[:200] + [(5000, "A a a, b!  nastyone"), (5001, "")])
    weights = toxicity.toxicity_fit(doc_frame(docs), spark.createDataFrame(labels, LABELS)).toArrow()
    w = dict(zip(weights["feature"].to_pylist(), weights["weight"].to_pylist()))
    for r in toxicity.toxicity_scores(frame, weights).collect():
        grams = plain_grams(re.findall(r"\w+", (r["text"] or "").lower()), toxicity.BITS)
        z = sum(w.get(g, 0.0) for g in grams) + w.get(1 << toxicity.BITS, 0.0)
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-9


def test_quality_scores_against_all_pairs(spark, doc_frame, data):
    docs, labels = data
    model = quality.quality_fit(doc_frame(docs), spark.createDataFrame(labels, LABELS))
    fm = quality.FactorisationMachine.from_bytes(bytes(model.first()["model"]))
    frame = doc_frame(docs[:25] + [(5000, ""), (5001, None)])
    for r in quality.quality_scores(frame, model).collect():
        at, x = quality.fm_features(r["text"], r["n_chars"], quality.BITS)
        z = fm.b + sum(float(fm.w[a]) * float(v) for a, v in zip(at, x))
        z += sum(float(fm.v[at[i]].astype(float) @ fm.v[at[j]].astype(float)) * float(x[i]) * float(x[j])
                 for i in range(len(at)) for j in range(i))
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-4


def test_quality_step_against_plain_adagrad():
    rng = np.random.default_rng(2)
    fm = quality.FactorisationMachine(5, 2)
    at, row = np.concatenate([rng.permutation(32)[:5] for _ in range(6)]), np.repeat(np.arange(6), 5)
    x, y = rng.random(30).astype(np.float32), rng.integers(0, 2, 6).astype(float)
    b, w, v = fm.b, fm.w.astype(float), fm.v.astype(float)
    gw, gv, gb = np.full(32, 1e-6), np.full((32, 2), 1e-6), 1e-6
    dw, dv, db = np.zeros(32), np.zeros((32, 2)), 0.0
    for r in range(6):
        a, z = at[row == r], x[row == r].astype(float)
        s = v[a] * z[:, None]
        raw = b + w[a] @ z + sum(s[i] @ s[j] for i in range(5) for j in range(i))
        g = (1 / (1 + np.exp(-raw)) - y[r]) / 6
        db += g
        for i in range(5):
            dw[a[i]] += g * z[i]
            dv[a[i]] += g * z[i] * (s.sum(axis=0) - s[i])
    used = np.unique(at)
    dw[used] += quality.L2 * w[used]
    dv[used] += quality.L2 * v[used]
    fm.learn(at, x, row, y)
    gw, gv, gb = gw + dw * dw, gv + dv * dv, gb + db * db
    assert np.allclose(fm.w, w - quality.RATE * dw / np.sqrt(gw), atol=1e-4)
    assert np.allclose(fm.v, v - quality.RATE * dv / np.sqrt(gv), atol=1e-4)
    assert abs(fm.b - (b - quality.RATE * db / np.sqrt(gb))) < 1e-6
