import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tastemap.llm import merkle

from .oracle import same_rows


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    vals = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals])


def tree(nodes):
    """(root, path of each node)."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 3 * 3:i // 3 * 3 + 3]
            paths[k].append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def manifest(rows):
    if not rows:
        return []
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found, subs = [], []
    for s in order:
        own = sorted((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), k) for k, r in enumerate(groups[s]))
        root, paths = tree([o[2] for o in own])
        subs.append(root)
        found.append([(groups[s][o[3]], o[2], p) for o, p in zip(own, paths)])
    root, tops = tree(subs)
    out = []
    for sub, own, top in zip(subs, found, tops):
        for r, leaf, path in own:
            path = path + top
            text, d = r["text"], leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
                d = leaf_of(r, text.replace("\n", ""))
            for lo, hi in path:
                d = h(lo, d, hi)
            out.append((r["doc_id"], leaf, sub, root, h(*[x for p in path for x in p]), d, d == root))
    return sorted(map(str, out))


COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(frame, depth):
    got = sorted(str(tuple(r[c] for c in COLS)) for r in merkle.document_manifest(frame, depth).collect())
    assert got == manifest([r.asDict() for r in frame.collect()])
    return got


def docs(doc_frame):
    rows = [(i, f"text {i}\nof line {i % 3}", "hot") for i in range(40)]
    rows += [(100 + i, "same\ntext", f"s{i % 4}") for i in range(9)]
    rows += [(200, None, None), (None, "x\n", "hot"), (None, "x\n", "hot"), (7, "text again", "hot"), (7, "text again", "hot"),
             (300, "", "single"), (301, "\n" * 5000, "é"), (302, "é" * 40_000 + "\n", "z"), (-5, "a\nb", ""), (303, "\n", "Z")]
    return doc_frame([(*r, 1) for r in rows], ", leaf int")


@pytest.mark.parametrize("depth", [2, 7])
def test_equals_brute_force_at_every_block_size(doc_frame, depth):
    assert len(check(docs(doc_frame), depth)) == 59


def test_matches_sql(doc_frame, duck):
    frame = docs(doc_frame).drop("leaf")
    same_rows(duck, frame, "documents", merkle.manifest_sql(), merkle.document_manifest(frame))


@pytest.mark.parametrize("n", [0, 1, 4, 10])
def test_small_tables(doc_frame, n):
    assert len(check(doc_frame([(i, f"t\n{i}", "s") for i in range(n)]), 2)) == n


def test_proofs_of_a_plain_table(spark):
    df = spark.createDataFrame([(i, f"g{i % 2}", f"{i:03d}") for i in range(25)], "k int, g string, v string")
    out = merkle.merkle_proofs(df, F.sha2("v", 256), "g", "v", F.struct("k", "g"), depth=2).collect()
    assert sorted(r["row"]["k"] for r in out) == list(range(25))
    for r in out:
        d = r["leaf"]
        for p in r["path"]:
            d = h(p["left"], d, p["right"])
        assert d == r["root"]


def test_no_join_on_rows_and_one_shuffle_a_tier(doc_frame, capsys):
    nodes, _ = merkle.ranked(merkle_leaves(docs(doc_frame)))
    merkle.rolled_up(nodes, 0, 3).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def merkle_leaves(frame):
    return frame.select(F.col("source").alias("group"), F.col("doc_id").alias("order"),
                        merkle.leaf_digest(merkle.FIELDS).alias("leaf"), F.struct("doc_id").alias("row"))
