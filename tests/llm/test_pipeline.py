"""Each stage against brute force on its own input, and the whole run."""
from collections import Counter

import corpus_pipeline
import pytest

from tastemap.llm import linededup, mixing, toxicity
from tastemap.llm.common import table, written

from .oracle import same_rows
from .test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF), "test-stage")
        out[name] = (docs, after)
        docs = after
    return out


def test_columns(staged):
    for name, (before, after) in list(staged.items())[:-1]:
        assert after.dtypes == before.dtypes, name


def test_toxicity_stage(spark, staged):
    before, after = staged["toxicity"]
    weights = toxicity.toxicity_fit(before, table(spark, SF, "labels"))
    scored = toxicity.toxicity_scores(before, weights).collect()
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(r["doc_id"] for r in scored if r["score"] < 0.5)


def test_line_stage(duck, staged):
    before, after = staged["line dedup"]
    found = linededup.dedup_lines(before).select("row.doc_id", "text", "n_lines", "n_dropped")
    rows = same_rows(duck, before, "documents", linededup.line_dedup_sql(), found)
    assert len(rows) == after.count()
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    for r in after.collect():
        assert r["text"] == texts[r["doc_id"]] and r["n_chars"] == len(r["text"])


def test_near_copy_stage(staged):
    before, after = staged["SimHash near-dedup"]
    rows = before.collect()
    component = brute_components([r["doc_id"] for r in rows], [brute_fp(r["text"]) for r in rows], 4)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(component))


def test_mixing_stage(duck, staged):
    before, after = staged["mixing sources"]
    duck.register("documents", before.toArrow())
    want = Counter(d for (d,) in duck.execute(mixing.mixing_sql(select="doc_id")).fetchall())
    assert Counter(r["doc_id"] for r in after.collect()) == want


def test_packing_stage(staged):
    before, after = staged["packing"]
    got = after.collect()
    assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == Counter(r["doc_id"] for r in before.collect())
    by_seq = {}
    for r in got:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096


def test_run_gives_the_stages_result(spark, staged):
    def digest(df):
        return Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert digest(corpus_pipeline.run(spark, SF)) == digest(staged["packing"][1])


def test_stages_on_odd_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, copy string"
    rows = [(1, None, None, None, None, 0.5, "c"), (2, "", "en", "s", 0, 0.5, None), (3, "x " * 30_000, "en", "s", 60_000, None, "c"),
            (None, "null id text here", "en", "src0", 17, 0.1, "c"), (4, "same row twice", "en", "src0", 14, 0.1, "c"),
            (4, "same row twice", "en", "src0", 14, 0.1, "c")]
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            after = written(stage(spark, docs, str(tmp_path)), "odd")
            if name != "packing":
                assert after.dtypes == docs.dtypes, name
            if not data:
                assert after.count() == 0, name
            docs = after
