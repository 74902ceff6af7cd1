import math

import pytest
from pyspark.sql import functions as F

from tastemap.llm import mixing

from .oracle import same_rows

COLS = ("row.doc_id", "row.text", "row.lang", "row.source", "row.n_chars", "copy", "shuffle_key")


def docs():
    rows = [(i, "t" * (5 + i % 7), f"src{i % 6}") for i in range(300)]
    rows += [(1000 + i, "hot " * 20, "src0") for i in range(150)]
    rows += [(2000, None, "src1"), (2001, "", "src2"), (2002, "no source", None), (None, "no id", "src3"),
             (7, "again", "src1"), (7, "again", "src1"), (3000, "", "empty only")]
    return rows


@pytest.mark.parametrize("targets", [{"src0": 0.2, "src1": 0.5}, {"src5": 0.98, "absent": 0.02}, {}])
def test_matches_sql(doc_frame, duck, targets):
    frame = doc_frame(docs())
    mixed = mixing.mix_sources(frame, targets).select(*COLS)
    if targets:
        same_rows(duck, frame, "documents", mixing.mixing_sql(targets), mixed)
    else:
        n = {r["doc_id"] for r in mixed.collect()}
        assert 100 < len(n) < 457                       # rate 1 everywhere


def test_salted_join_gives_the_same(doc_frame):
    frame = doc_frame(docs())
    a = mixing.mix_sources(frame).select(*COLS).collect()
    b = mixing.mix_sources(frame, broadcast_sources=0).select(*COLS).collect()
    assert a == b and [r["shuffle_key"] for r in a] == sorted(r["shuffle_key"] for r in a)


def test_rates_and_shares(doc_frame):
    frame = doc_frame(docs())
    rates = {r["source"]: r for r in mixing.source_rates(
        frame, {"src0": 0.2}, "source", F.length(F.coalesce("text", F.lit("")))).collect()}
    assert math.isclose(sum(r["weight"] for r in rates.values()), 1.0)
    assert math.isclose(rates["src0"]["weight"], 0.2) and rates["empty only"]["rate"] == 1.0
    total = sum(r["size"] for r in rates.values())
    for r in rates.values():
        if r["size"]:
            assert math.isclose(r["rate"], r["weight"] * total / r["size"])


@pytest.mark.parametrize("rate", [0.0, 0.3, 1.0, 7.5, 40.0])
def test_counts_are_poisson(spark, rate):
    n = 20_000
    df = spark.range(n).select(mixing.poisson_count(F.col("id").cast("string"), 3, mixing.poisson_steps(F.lit(rate)))
                               .alias("k"))
    mean, var = df.agg(F.avg("k"), F.var_pop("k")).first()
    assert abs(mean - rate) <= 5 * math.sqrt(rate / n) + 1e-9
    assert abs(var - rate) <= 0.06 * rate + 1e-9


def test_empty_and_extra_columns(doc_frame):
    assert mixing.mix_sources(doc_frame([])).count() == 0
    out = mixing.mix_sources(doc_frame([(1, "x", "s", 5), (2, "y", "s", 6)], ", copy int"), {"s": 1.0})
    assert out.columns == ["row", "copy", "shuffle_key"]


def test_no_python_in_plan(doc_frame, capsys):
    mixing.mix_sources(doc_frame(docs())).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "ArrowEval" not in plan
