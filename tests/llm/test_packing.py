import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tastemap.llm import packing, tokens


def direct_ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.vocabulary_path()).encode(text or "", add_special_tokens=False).ids


TEXTS = ["a\x01b \x01 c", "x <|endoftext|> y<|startoftext|>z ́e don't I'll\x1cq　w", "", None,
         "1234   ... !!! " + "z" * 5000, "tabs\tand\nlines\r\n    end", "É́ ﬁ Å ü", " lead and trail "]


def test_word_by_word_ids_are_the_tokenizers():
    enc = tokens.WordEncoder(tokens.vocabulary_path())
    for _ in range(2):                                   # fresh, then remembered
        got = [np.frombuffer(b, "<u4").tolist() for b in enc(TEXTS)]
        assert got == [direct_ids(t) for t in TEXTS]


def test_a_word_is_looked_up_once_beside_long_ones():
    class Counted(dict):
        looks = 0

        def get(self, word, default=None):
            Counted.looks += 1
            return super().get(word, default)

        def __getitem__(self, word):
            Counted.looks += 1
            return super().__getitem__(word)

    enc = tokens.WordEncoder(tokens.vocabulary_path())
    enc.memo = Counted()
    long = "z" * (tokens.MEMO_CHARS + 1)
    texts = [f"the cat {long} sat on the mat", None, f"{long} the cat {long}", "the cat"]
    for n in (1, 2):                                     # fresh, then remembered
        got = [np.frombuffer(b, "<u4").tolist() for b in enc(texts)]
        assert got == [direct_ids(t) for t in texts]
        assert Counted.looks == n * sum(len((t or "").split()) for t in texts)
    assert long not in enc.memo


def test_odd_words_match_the_tokenizer():
    rng = random.Random(2)
    letters = "abzABZéÉßẞñÑüÜøØœŒæÆĳĲŉſİıǅΣσς́Ωждあ한0١²ª'’-.,!?;:<|>_\x01\u00ad\u0345"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 8))) for _ in range(4000)]
    words += [w + p for w in ("naïve", "Straße", "ÉCOLE", "İstanbul", "ǅ", "ﬁ", "Á", "e") for p in ("", ".", ",!", "...", "'s")]
    enc = tokens.WordEncoder(tokens.vocabulary_path())
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(tokens.vocabulary_path())
    got = [np.frombuffer(b, "<u4").tolist() for b in enc(words)]
    want = [e.ids for e in tk.encode_batch(words, add_special_tokens=False)]
    assert [(w, g, x) for w, g, x in zip(words, got, want) if g != x] == []


def test_best_configuration_is_optimal():
    rng = random.Random(5)
    for _ in range(30):
        cap = rng.randint(5, 30)
        upper = np.array(sorted(rng.sample(range(1, cap + 1), 4)))
        profit = np.array([rng.random() for _ in upper])
        best = max(sum(c * p for c, p in zip(cs, profit))
                   for cs in itertools.product(*[range(cap // u + 1) for u in upper.tolist()])
                   if sum(c * u for c, u in zip(cs, upper)) <= cap)
        got = packing.best_configuration(upper, profit, cap)
        assert (got * upper).sum() <= cap and abs((got * profit).sum() - best) < 1e-9


@pytest.mark.parametrize("kind", ["uniform", "short", "halves", "full", "thirds"])
def test_patterns_use_the_histogram_up(kind):
    rng = np.random.default_rng(2)
    n = {"uniform": rng.integers(1, 513, 4000), "short": rng.integers(1, 20, 4000),
         "halves": rng.integers(250, 262, 1000), "full": np.full(30, 512), "thirds": np.full(3001, 170)}[kind]
    hist = Counter(n.tolist())
    patterns = packing.packing_patterns(dict(hist), 512)
    used = Counter()
    for p, times in patterns:
        assert sum(k * c for k, c in p.items()) <= 512 and times > 0
        for k, c in p.items():
            used[k] += c * times
    assert used == hist
    sequences = sum(t for _, t in patterns)
    best = {"halves": None}.get(kind, -(-int(n.sum()) // 512))
    if kind == "thirds":
        best = -(-3001 // 3)
    if best:
        assert sequences <= best * 1.01 + 1
    else:
        assert sequences <= 510


def docs():
    rng = random.Random(9)
    words = "alpha beta gamma delta, epsilon! zeta 42 eta's".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(80)]
    return rows + [(100, None), (101, ""), (102, "long " * 3000)] + [(200 + i, "same length") for i in range(40)]


@pytest.mark.parametrize("bucket_rows", [1000, 7])
def test_round_trip(spark, doc_frame, monkeypatch, bucket_rows):
    monkeypatch.setattr(packing, "BUCKET_ROWS", bucket_rows)
    rows = docs()
    frame = doc_frame(rows)
    out = packing.pack_documents(frame, capacity=256)
    got = out.collect()
    assert set(out.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    ids = {d: direct_ids(t) + [1] for d, t in rows}
    for r in got:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["length"] == len(part) <= 256 and r["start"] == 256 * r["piece"]
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"]
    assert Counter(r["doc_id"] for r in got) == {d: -(-len(x) // 256) for d, x in ids.items()}
    by_seq = {}
    for r in got:
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    assert len(by_seq) <= -(-sum(map(len, ids.values())) // 256) * 1.02 + 1
    placed = spark.createDataFrame(got, out.schema)
    seqs = packing.packed_sequences(frame, placed, capacity=256).collect()
    assert len(seqs) == len(by_seq)
    for s in seqs:
        want = [i for r in sorted(by_seq[s["sequence_id"]], key=lambda r: r["offset"])
                for i in ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]]
        assert s["token_ids"] == want


def test_repeated_rows_nulls_and_empty(doc_frame):
    out = packing.pack_documents(doc_frame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)])).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in out) == [("1", 3), ("1", 3), ("None", 1), ("None", 2)]
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == 4
    assert packing.pack_documents(doc_frame([])).count() == 0
    extra = packing.pack_documents(doc_frame([(1, "a b", "s", 3)], ", length int"))
    assert extra.first()["length"] == 3


def _uses(patterns, capacity):
    used = {}
    for pattern, times in patterns:
        assert times > 0 and 0 < sum(n * c for n, c in pattern.items()) <= capacity
        for n, c in pattern.items():
            used[n] = used.get(n, 0) + c * times
    return used


def test_best_fit_decreasing_is_the_plain_one():
    """Sequences that look alike together give what one piece at a time gives."""
    rnd = random.Random(4)
    for _ in range(60):
        capacity = rnd.choice([10, 37, 100])
        pieces = sorted((rnd.randint(1, capacity) for _ in range(rnd.randint(1, 120))), reverse=True)
        rooms = []
        for n in pieces:
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - n)
            else:
                rooms.append(capacity - n)
        left = [pieces.count(n) for n in range(capacity + 1)]
        got = packing.best_fit_decreasing(left, capacity)
        assert _uses(got, capacity) == {n: c for n, c in enumerate(left) if c}
        assert sorted(capacity - sum(n * c for n, c in p.items()) for p, k in got for _ in range(k)) == sorted(rooms)


@pytest.mark.parametrize("kind", ["flat", "lognormal", "bulky"])
def test_plans_are_near_the_lower_bound(kind):
    rng = np.random.default_rng(7)
    if kind == "flat":
        histogram = {n: 20 for n in range(1, 4097)}
    else:
        lengths = rng.lognormal(6.5, 1.2, 60_000) if kind == "lognormal" else rng.integers(1400, 4097, 20_000)
        histogram = dict(zip(*np.unique(np.clip(lengths.astype(int), 1, 4096), return_counts=True)))
        histogram = {int(n): int(c) for n, c in histogram.items()}
    plan = packing.packing_patterns(histogram, rounds=600)
    assert _uses(plan, 4096) == histogram
    used = sum(k for _, k in plan)
    greedy = sum(k for _, k in packing.best_fit_decreasing([histogram.get(n, 0) for n in range(4097)], 4096))
    bound = -(-sum(n * c for n, c in histogram.items()) // 4096)
    assert used <= max(greedy, bound) * 1.002
    assert kind == "bulky" or used <= bound * 1.002
