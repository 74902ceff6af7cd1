import random
import re
from collections import defaultdict

import pytest

from tastemap.llm import linededup

from .oracle import same_rows

LONG = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
HEAD = "user alice logged in from"


def docs():
    rows = [(i, f"own line {chr(97 + i)} stays here\n{LONG}\nok") for i in range(5)]
    rows += [(10 + i, f"{HEAD} host{i} at 1{i}:00 ok\nsession 77{i} closed for worker pool number {i}\n x\ty  z ")
             for i in range(6)]
    # one word differs in a long line; two lines share the leading tokens only
    rows += [(30, LONG.replace("wfa", "other")), (31, "a b c d e f g h i j"), (32, "a b c q r s t u v w"),
             (33, "a b c d e f g h i k")]
    rows += [(40, None), (41, ""), (42, "\n\n"), (None, LONG + "\nnull id"), (None, None), (43, "one\ntwo words\none"),
             (44, LONG), (44, LONG), (44, "same id " + LONG), (45, "r r r r\nr r r r"), (46, "r r r r\nr r r r"),
             (47, "tab\ttab\ttab"), (48, "tab  tab tab"), (49, "x" * 50_000 + " " + "9" * 50_000 + " y z")]
    return rows


@pytest.mark.parametrize("min_docs", [2, 4])
def test_matches_sql(spark, duck, doc_frame, min_docs):
    frame = doc_frame(docs())
    found = linededup.dedup_lines(frame, min_docs=min_docs).select("row.doc_id", "text", "n_lines", "n_dropped")
    same_rows(duck, frame, "documents", linededup.line_dedup_sql(min_docs=min_docs), found)


def test_what_goes_and_what_stays(doc_frame):
    frame = doc_frame([(*r[:2], "s", 1.5) for r in docs()], ", n_lines double")
    rows = {r["row"]["doc_id"]: r for r in linededup.dedup_lines(frame).collect()}
    assert rows[0]["text"].split("\n")[1] == LONG                      # the first keeps the passage
    assert LONG not in rows[3]["text"] and rows[3]["text"].startswith("own line d")
    assert rows[10]["n_dropped"] == 0 and rows[12]["text"] == ""     # fields vary, the templates recur
    assert rows[30]["n_dropped"] == 0                                  # one word of sixty differs: it does not recur
    assert rows[32]["n_dropped"] == 0                                  # shares its leading tokens only
    assert rows[40]["text"] is None and rows[41]["text"] == "" and rows[42]["text"] == "\n\n"
    assert rows[45]["n_dropped"] == 0 and rows[46]["text"] == ""
    assert rows[43]["n_dropped"] == 0                                  # short lines have no leaf
    assert rows[0]["row"]["n_lines"] == 1.5                            # clashing extra column rides along


def test_empty(doc_frame):
    assert linededup.dedup_lines(doc_frame([])).count() == 0


def test_no_python_in_plan(doc_frame, capsys):
    linededup.dedup_lines(doc_frame(docs())).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "ArrowEval" not in plan


def plain_tree(rows, levels=3, values=3, constants=5, share=0.6, min_docs=2):
    """{(id, text): dropped positions} by a tree of dictionaries, one leaf at a time."""
    def split(text):
        out = []
        for pos, line in enumerate(text.split("\n")):
            w = tuple("<*>" if re.search("[0-9]", t) else t for t in re.split("[ \t\r\x0b\x0c]+", line) if t)
            if len(w) >= 3:
                out.append((pos, w))
        return out
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda d: (d[0] is None, d[0] or 0, d[1]))
    first_seen = {}
    for i, t in docs:
        for _, w in split(t):
            if w not in first_seen or (first_seen[w] is None and i is not None):
                first_seen[w] = i
    leaves = defaultdict(list)
    for w in first_seen:
        leaves[(len(w), w[:3])].append(w)
    template = {}

    def visit(lines, key, level):
        if len(lines) < values or len({first_seen[w] for w in lines} - {None}) < values:
            return
        counts = [len({w[p] for w in lines}) for p in range(len(lines[0]))]
        fixed, varying = sum(c == 1 for c in counts), [c for c in counts if c > 1]
        if min(varying) >= values and fixed >= constants and fixed >= share * len(counts):
            template.update((w, key) for w in lines)
        elif level + 1 < levels:
            cut = [p for p, c in enumerate(counts) if 1 < c < values] or [min((c, p) for p, c in enumerate(counts) if c > 1)[1]]
            parts = defaultdict(list)
            for w in lines:
                parts[tuple(w[p] for p in cut)].append(w)
            for k, part in parts.items():
                visit(part, (*key, k), level + 1)
    for key, lines in leaves.items():
        visit(lines, key, 0)
    seen = defaultdict(set)
    for d in docs:
        for _, w in split(d[1]):
            seen[template.get(w, w)].add(d)
    gone = {}
    for d in docs:
        lost = [pos for pos, w in split(d[1]) if len(seen[template.get(w, w)]) >= min_docs
                and min(seen[template.get(w, w)], key=docs.index) != d]
        if lost:
            gone[d] = lost
    return gone


def probes():
    rnd = random.Random(3)
    names, hosts = [f"N{chr(97 + i)}x" for i in range(20)], [f"H{chr(97 + i)}y" for i in range(20)]
    rows = [(1, "It was a great day"), (2, "It was a great night"), (3, "The cat sat on a red mat today"),
            (4, "The cat sat on a red hat today")]
    rows += [(100 + i, f"the user named {rnd.choice(names)} logged in from {rnd.choice(hosts)}") for i in range(40)]
    # two templates in one leaf, told apart by a constant token below the leading ones
    rows += [(200 + i, f"job on node {chr(97 + i)}{chr(97 + i)} was started by the scheduler again") for i in range(6)]
    rows += [(210 + i, f"job on node {chr(97 + i)}{chr(97 + i)} was stopped by the scheduler again") for i in range(6)]
    # many values in one document alone are no evidence
    rows += [(300, "\n".join(f"the item called {c}{c} is sold out for now" for c in "abcdef"))]
    # prose with one opening: too few positions agree
    rows += [(400 + i, "once upon a " + " ".join(rnd.choice("lorem ipsum dolor sit amet".split()) for _ in range(6))) for i in range(12)]
    return rows


def test_probes(doc_frame):
    out = {r["row"]["doc_id"]: r for r in linededup.dedup_lines(doc_frame(probes())).collect()}
    assert all(out[i]["n_dropped"] == 0 for i in (1, 2, 3, 4, 300))     # nothing of these recurs
    assert out[100]["n_dropped"] == 0 and all(out[100 + i]["text"] == "" for i in range(1, 40))
    assert out[200]["n_dropped"] == 0 and all(out[200 + i]["text"] == "" for i in range(1, 6))
    assert out[210]["n_dropped"] == 0 and all(out[210 + i]["text"] == "" for i in range(1, 6))


@pytest.mark.parametrize("min_docs", [2, 4])
def test_equals_plain_tree_and_sql(spark, duck, doc_frame, min_docs):
    rnd = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta"]
    rows = probes() + [(r[0], r[1]) for r in docs()]
    rows += [(1000 + i, "\n".join(" ".join(["start", "of", "it", *(rnd.choice(words[:1 + p % 4]) for p in range(rnd.choice([3, 7, 9])))])
                                  for _ in range(6))) for i in range(60)]
    frame = doc_frame(rows)
    found = linededup.dedup_lines(frame, min_docs=min_docs)
    gone = plain_tree(rows, min_docs=min_docs)
    for r in found.collect():
        i, text = r["row"]["doc_id"], r["row"]["text"]
        lost = gone.get((i, text), [])
        assert r["n_dropped"] == len(lost)
        if text is not None:
            assert r["text"] == "\n".join(x for p, x in enumerate(text.split("\n")) if p not in lost)
    same_rows(duck, frame, "documents", linededup.line_dedup_sql(min_docs=min_docs),
              found.select("row.doc_id", "text", "n_lines", "n_dropped"))
