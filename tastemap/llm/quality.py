"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): the
sum-of-squares identity scores all pairwise interactions in time linear in the features.
Fitted by AdaGrad mini-batches over a bounded sample of labelled rows (``SAMPLE_ROWS``);
the model has a fixed size (``2**BITS`` coordinates of ``1 + FACTORS`` numbers) and is
broadcast; scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_value
from .features import MIX_1, sigmoid, word_hashes
from .samples import epochs_in_order, labelled_sample

BITS = 17
FACTORS = 8
SAMPLE_ROWS = 12_000
EPOCHS = 3
BATCH = 32
RATE = 0.05
L2 = 1e-5
SEED = 23
THRESHOLD = 0.3
BINS = 16

_LETTER_CASE = bytes(range(65, 91))
_SPACES = b" \t\n\r\x0b\x0c"
_DIGITS = b"0123456789"
_PUNCT = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def structure(text: str, n_chars) -> list[float]:
    """Statistics of a text's form, each a share between 0 and 1 or a logarithm."""
    raw = text.encode("utf-8", "surrogatepass")
    size = max(1, len(raw))

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / size
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(1, len(lines))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    longest = max(map(len, words), default=0)
    sentence = sum(w[-1] in ".!?" for w in words)
    bare = sum(not w[-1].isalnum() for w in words)
    lone = sum(len(w) == 1 for w in words)
    capitals = sum(w[0].isupper() for w in words)
    return [
        np.log2(1 + len(words)) / 20, np.log2(1 + len(text)) / 24, np.log2(1 + m) / 16,
        share(_LETTER_CASE), share(_DIGITS), share(_PUNCT), share(_SPACES),
        len(counts) / n, max(counts.values(), default=0) / n, repeats / n,
        1 - len(set(lines)) / m, min(1.0, len(text) / n / 24), min(1.0, longest / 60),
        sentence / n, bare / n, lone / n, capitals / n,
        min(1.0, np.log2(1 + n / m) / 10),
        min(1.0, sum(len(x.split()) < 4 for x in lines) / m),
        0.0 if n_chars is None else 0.02 + 0.98 * min(1.0, np.log2(1 + max(0.0, float(n_chars))) / 24),
    ]


def fm_features(text: str | None, n_chars, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, values): a text's distinct words share one unit of length, and so do
    its binned statistics."""
    text = text or ""
    if n_chars is not None and n_chars != n_chars:      # NaN: a null in a numeric column
        n_chars = None
    size = 1 << bits
    words = list(set(text.lower().split()))
    h = (word_hashes(words) * MIX_1) >> np.uint64(64 - bits + 1) if words else np.empty(0, np.uint64)
    at_words, counts = np.unique(h.astype(np.int64), return_counts=True)
    x_words = counts / max(1.0, np.sqrt((counts ** 2).sum()))
    stats = structure(text, n_chars)
    place = [(k * BINS + min(BINS - 1, int(s * BINS))) for k, s in enumerate(stats)]
    near = [(k * BINS + min(BINS - 1, int(s * BINS + 0.5))) for k, s in enumerate(stats)]
    # statistics live in the upper half of the coordinates, in order: they never collide
    at_stats = size // 2 + np.array(place + [len(stats) * BINS + p for p in near], dtype=np.int64)
    x_stats = np.full(len(at_stats), 1.0 / np.sqrt(len(at_stats)))
    scale = 2.0
    return (np.concatenate([at_words, at_stats]).astype(np.int32),
            np.concatenate([x_words, scale * x_stats]).astype(np.float32))


class FactorisationMachine:
    def __init__(self, bits: int = BITS, factors: int = FACTORS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.b = 0.0
        self.w = np.zeros(1 << bits, dtype=np.float32)
        self.v = rng.normal(0, 0.05, (1 << bits, factors)).astype(np.float32)
        self.gb, self.gw, self.gv = 1e-6, np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6)

    def score(self, at: np.ndarray, x: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(raw scores, per-row factor sums) of ``n`` rows given as flat coordinates."""
        xv = self.v[at] * x[:, None]
        first = np.bincount(row, self.w[at] * x, n)
        sums = np.stack([np.bincount(row, xv[:, f], n) for f in range(xv.shape[1])], axis=1)
        squares = np.bincount(row, (xv * xv).sum(axis=1), n)
        return self.b + first + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def learn(self, at, x, row, labels, rate: float = RATE, l2: float = L2) -> None:
        n = len(labels)
        raw, sums = self.score(at, x, row, n)
        g = (sigmoid(raw) - labels) / n
        gx = (g[row] * x).astype(np.float32)
        where, inverse = np.unique(at, return_inverse=True)
        dw = np.bincount(inverse, gx, len(where)) + l2 * self.w[where]
        rows = gx[:, None] * (sums[row] - self.v[at] * x[:, None])
        dv = np.stack([np.bincount(inverse, rows[:, f], len(where)) for f in range(rows.shape[1])], axis=1)
        dv += l2 * self.v[where]
        self.gw[where] += dw * dw
        self.gv[where] += dv * dv
        self.w[where] -= rate * dw / np.sqrt(self.gw[where])
        self.v[where] -= rate * dv / np.sqrt(self.gv[where])
        db = float(g.sum())
        self.gb += db * db
        self.b -= rate * db / np.sqrt(self.gb)

    def to_bytes(self) -> bytes:
        return np.float64(self.b).tobytes() + self.w.tobytes() + self.v.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, bits: int = BITS) -> "FactorisationMachine":
        model = cls.__new__(cls)
        size = 1 << bits
        model.b = float(np.frombuffer(raw[:8])[0])
        model.w = np.frombuffer(raw[8:8 + 4 * size], dtype=np.float32)
        model.v = np.frombuffer(raw[8 + 4 * size:], dtype=np.float32).reshape(size, -1)
        return model


def fm_fit(sample: DataFrame, text_col: str = "text", chars_col: str = "n_chars", bits: int = BITS,
           factors: int = FACTORS, epochs: int = EPOCHS) -> DataFrame:
    """One row ``model binary``; ``sample`` as given by samples.labelled_sample."""
    @F.pandas_udf("at array<int>, x array<float>")
    def features(texts: pd.Series, chars: pd.Series) -> pd.DataFrame:
        rows = [fm_features(t, c, bits) for t, c in zip(texts, chars)]
        return pd.DataFrame({"at": [a for a, _ in rows], "x": [x for _, x in rows]})

    rows = epochs_in_order(sample.select(
        "__id", "label", features(F.col(text_col), F.col(chars_col).cast("double")).alias("f")), epochs)

    def learn(batches):
        import pyarrow as pa
        model = FactorisationMachine(bits, factors)
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            lists = batch.column(1)
            ends = np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy()))))
            at = lists.flatten().to_numpy(zero_copy_only=False)
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            for s in range(0, len(labels), BATCH):
                e = min(s + BATCH, len(labels))
                span = slice(ends[s], ends[e])
                row = np.repeat(np.arange(e - s), np.diff(ends[s:e + 1]))
                model.learn(at[span], x[span], row, labels[s:e])
        yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], names=["model"])

    return rows.select("label", "f.at", "f.x").mapInArrow(learn, "model binary")


_MODELS: dict = {}


def quality_scores(docs: DataFrame, model: DataFrame, text_col: str = "text", chars_col: str = "n_chars",
                   out: str = "score", bits: int = BITS) -> DataFrame:
    """``docs`` with the probability of good quality of each text (null: as empty).

    Every row is scored for itself: repeated rows and equal scores need no rule, an empty
    table gives no rows, texts of any length are read whole, a null or NaN count of characters
    is a value of its own, and extra columns ride along (one already called ``out`` is
    replaced)."""
    fitted = model.first()                         # fixed size: 2**bits * (1 + factors) floats
    raw = bytes(fitted["model"]) if fitted else FactorisationMachine(bits).to_bytes()
    shared = broadcast_value(docs, raw)
    key = hash(raw)

    @F.pandas_udf("double")
    def score(texts: pd.Series, chars: pd.Series) -> pd.Series:
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = FactorisationMachine.from_bytes(shared.value, bits)
        fm = _MODELS[key]
        out = np.empty(len(texts))
        for i, (t, c) in enumerate(zip(texts, chars)):
            at, x = fm_features(t, c, bits)
            xv = fm.v[at] * x[:, None]
            s = xv.sum(axis=0)
            out[i] = fm.b + fm.w[at] @ x + 0.5 * (s @ s - (xv * xv).sum())
        return pd.Series(sigmoid(out))

    return docs.withColumn(out, score(F.col(text_col), F.col(chars_col).cast("double")))


def quality_fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Model learnt from at most ``rows`` labelled documents outside the held-out fold.
    Without labelled documents the model is the untrained one (scores near 0.5).  Of several
    labels of one id the largest counts, of repeated documents one; null ids and labels teach
    nothing; extra columns are not looked at."""
    sample = labelled_sample(docs.select("doc_id", "text", "n_chars"), labels, "quality", rows, SEED)
    return fm_fit(sample)
