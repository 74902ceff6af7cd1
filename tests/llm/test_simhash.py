import random

import numpy as np
import pytest

from tastemap.llm import components, simhash

DOC_COLS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fp(text, k=4):
    import re
    import xxhash
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(ids, fps, bits):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None and (r not in low or low[r] is None or d < low[r]):
            low[r] = d
        low.setdefault(r, None)
    return [low[find(i)] for i in range(len(ids))]


TEXTS = ["", None, "one", "A b\tC  d\n e", "a b c d e", "É è Ü  x y z w", "word " * 3000, "x y z\x1cq w e r"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (2**64 - 1) == brute_fp(text)


def test_spark_hash_is_the_contracts(spark):
    import xxhash
    from pyspark.sql import functions as F
    s = "a longer shingle of some words, thirty-two bytes and more é"
    got = spark.range(1).select(F.xxhash64(F.lit(s))).first()[0]
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest(s.encode(), 42)


def make_docs():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(60):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 20, 200]))]
        docs.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 6])):
            other = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                other[rng.randrange(len(other))] = rng.choice(vocab)
            docs.append(" ".join(other))
    rows = [(100 + 7 * ((i * 37) % len(docs)), t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(docs)]
    rows += [(5, None, None, None, None), (9, "", "en", "s", 0), (None, docs[0], "en", "s", 1), rows[4], rows[4],
             (None, "only me here", "en", None, 3)]
    return rows


@pytest.mark.parametrize("block", [4096, 3])
def test_components_match_brute_force(spark, block):
    rows = make_docs()
    got = simhash.simhash_components(spark.createDataFrame(rows, DOC_COLS), block=block).collect()
    fps = [brute_fp(r[1]) for r in rows]
    want = sorted(map(str, zip([r[0] for r in rows], fps, brute_components([r[0] for r in rows], fps, 4))))
    assert sorted(str((r["id"], r["fp"] & (2**64 - 1), r["component_id"])) for r in got) == want


@pytest.mark.parametrize("block", [4096, 50])
def test_all_distances(spark, block):
    """Random fingerprints at every distance: links exactly those of at most 4 bits."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = set()
    for b in base.tolist():
        fps.add(b)
        for d in range(1, 7):
            x = b
            for bit in rng.choice(64, d, replace=False).tolist():
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    edges = simhash.hamming_edges(df, block=block)
    labels = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
    want = brute_components(list(range(len(fps))), fps, 4)
    groups, mine = {}, {}
    for f, w in zip(fps, want):
        s = int(np.uint64(f).view(np.int64))
        groups.setdefault(w, set()).add(s)
        mine.setdefault(labels.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_dedup_keeps_one_of_each(spark):
    rows = make_docs()
    df = spark.createDataFrame([(*r, "x") for r in rows], DOC_COLS + ", component_id string")
    out = simhash.simhash_dedup(df)
    assert out.columns == df.columns
    kept = out.collect()
    fps = [brute_fp(r[1]) for r in rows]
    comp = brute_components(list(range(len(rows))), fps, 4)
    assert len(kept) == len(set(comp))
    for c in set(comp):
        ids = [rows[i][0] for i in range(len(rows)) if comp[i] == c and rows[i][0] is not None]
        assert sum(1 for k in kept if k["doc_id"] == (min(ids) if ids else None)) >= 1


def test_empty(spark):
    df = spark.createDataFrame([], DOC_COLS)
    assert simhash.simhash_components(df).count() == 0
    assert simhash.simhash_dedup(df).count() == 0


def test_chain_component(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000), (7, 3), (None, 4)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)}
