"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The features of a text are the hash buckets of its words, word pairs and skip-grams,
each counted once.  The regression is fitted online over a bounded sample
of labelled rows (``SAMPLE_ROWS``): every coordinate has its own rate, and the L1 term
keeps all but a few coordinates at zero, so the model is a short list of weights that is
broadcast; scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_value
from .features import gram_features, sigmoid, texts_of, words_of
from .samples import epochs_in_order, labelled_sample

BITS = 20
SAMPLE_ROWS = 12_000
EPOCHS = 4
SEED = 11
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.02
UNKNOWN = 0.0                     # score of every text under a model without weights
THRESHOLD = 0.5


class Ftrl:
    """FTRL-proximal state; coordinate 2**bits is the intercept (free of L1)."""

    def __init__(self, bits: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.bias = 1 << bits
        self.z = np.zeros(self.bias + 1)
        self.n = np.zeros(self.bias + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.bias, 0.0, self.l1)
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, features: np.ndarray, label: int) -> None:
        at = np.append(features, self.bias)
        w = self.weights(at)
        g = float(sigmoid(w.sum())) - label
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights(np.arange(self.bias + 1))
        at = np.flatnonzero(w)
        return at, w[at]


def ftrl_fit(sample: DataFrame, text_col: str = "text", bits: int = BITS, epochs: int = EPOCHS) -> DataFrame:
    """(feature int, weight double) of the non-zero weights; ``sample`` as given by
    samples.labelled_sample."""
    @F.pandas_udf("array<int>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: np.unique(gram_features(words_of(t), bits)), na_action=None)

    rows = epochs_in_order(sample.select("__id", "label", features(text_col).alias("features")), epochs)

    def learn(batches):
        model = Ftrl(bits)
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(np.diff(lists.offsets.to_numpy())).tolist()
            for y, s, e in zip(labels.tolist(), [0, *ends], ends):
                model.learn(flat[s:e], y)
        at, w = model.sparse()
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w)], names=["feature", "weight"])

    return rows.select("label", "features").mapInArrow(learn, "feature int, weight double")


_DENSE: dict = {}


def _dense(key, at, w, bits: int) -> np.ndarray:
    if key not in _DENSE:
        _DENSE.clear()
        table = np.zeros((1 << bits) + 1, dtype=np.float64)
        table[at] = w
        _DENSE[key] = table
    return _DENSE[key]


def toxicity_scores(docs: DataFrame, weights: DataFrame, text_col: str = "text", out: str = "score",
                    bits: int = BITS) -> DataFrame:
    """``docs`` with the toxicity probability of each text (null and empty texts: that of
    the intercept).  ``weights``, or the Arrow table of it, has at most 2**bits + 1 rows.

    A model without any weight knows nothing against a text: its scores are ``UNKNOWN``.
    Every row is scored for itself: repeated rows and equal scores need no rule, an empty
    table gives no rows, texts of any length are read whole, and extra columns ride along
    (one already called ``out`` is replaced)."""
    model = weights.toArrow() if isinstance(weights, DataFrame) else weights
    if not model.num_rows:
        return docs.withColumn(out, F.lit(UNKNOWN))
    at = model["feature"].to_numpy().copy()
    w = model["weight"].to_numpy().copy()
    shared = broadcast_value(docs, (at, w))
    key = shared._jbroadcast.id() if shared._jbroadcast is not None else id(shared)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        table = _dense(key, *shared.value, bits)
        out = np.empty(len(texts))
        for i, t in enumerate(texts_of(texts)):
            f = gram_features(words_of(t), bits)
            f = f[table[f] != 0.0]
            out[i] = table[np.unique(f)].sum() + table[-1]
        return pa.array(sigmoid(out))

    return docs.withColumn(out, score(F.col(text_col)))


def toxicity_fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Weights learnt from at most ``rows`` labelled documents outside the held-out fold.
    Without labelled documents there are no weights.  Of several labels of one id the largest
    counts, of repeated documents one; null ids, texts and labels teach nothing; extra columns
    are not looked at."""
    sample = labelled_sample(docs.select("doc_id", "text"), labels, "toxic", rows, SEED)
    return ftrl_fit(sample)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns as before, whatever
    their names.  Without weights (no usable label) nothing speaks against a document: all are
    kept.  Copies of a row go or stay together; an empty table stays empty."""
    from .common import packed, unpacked
    weights = toxicity_fit(docs, labels).toArrow()
    if not weights.num_rows:
        return docs
    slim = docs.select(F.col("text").alias("__text"), packed(docs))
    scored = toxicity_scores(slim, weights, "__text", "__score")
    return unpacked(scored.filter(F.col("__score") < threshold), docs.schema)
