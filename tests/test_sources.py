import gzip
import os
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from tastemap.operators import bias as B
from tastemap.sources import text as X
from tastemap.sources.models import fit_or_load, load_model, save_model


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_delimited_latin1_and_trailing_blank(spark):
    d = tempfile.mkdtemp(prefix="tastemap-test-")
    _write(f"{d}/movies.dat", "1::Café Society (1999)::Drama   \n2::Heat, The (1995)::Action|Crime\n", "latin-1")
    df = X.read_movies(spark, f"{d}/movies.dat")
    assert rows(df, "MovieID", "Title", "Genres") == [("1", "Café Society (1999)", "Drama"),
                                                        ("2", "Heat, The (1995)", "Action|Crime")]


def test_delimited_edges(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="tastemap-test-")
    _write(f"{d}/ok.dat", "1::::x y::z  \n::b.*::c:d::\n\u00e9::'q\"::,::|\n")
    cols = ["a", "b", "c", "d"]
    assert rows(X.read_delimited(spark, f"{d}/ok.dat", cols), *cols) == [
        ("", "b.*", "c:d", ""), ("1", "", "x y", "z"), ("\u00e9", "'q\"", ",", "|")]
    _write(f"{d}/bad.dat", "1::2::3::4\n3::c::d\n3::c::d::e::f\n")
    with pytest.raises(Exception, match="expected 4 fields"):
        X.read_delimited(spark, f"{d}/bad.dat", cols).collect()
    assert rows(X.bad_lines(spark, f"{d}/bad.dat", cols), "line", "n_fields") == [("3::c::d", 3), ("3::c::d::e::f", 5)]


def test_movielens_loader_and_users(spark):
    d = tempfile.mkdtemp(prefix="tastemap-test-")
    _write(f"{d}/ratings.dat", "1::10::5::978300760\n1::20::3::978302109\n2::10::4::978301968\n")
    _write(f"{d}/users.dat", "1::F::1::10::48067\n2::M::56::16::70072\n")
    _write(f"{d}/movies.dat", "10::Toy Story (1995)::Animation|Comedy\n20::Heat (1995)::Action\n")
    r, u, m = X.load_movielens(spark, d)
    assert r.schema.simpleString() == "struct<user:bigint,item:bigint,rating:double,Timestamp:string>"
    assert rows(r, "user", "item", "rating") == [(1, 10, 5.0), (1, 20, 3.0), (2, 10, 4.0)]
    assert u.columns == ["user", "Gender", "Age", "Occupation", "Zip-code"]
    assert X.read_users(spark, f"{d}/users.dat").columns == ["UserID", "Gender", "Age", "Occupation"]
    train, test = X.read_rating_maps(spark, f"{d}/ratings.dat", pivot=1.0)
    assert test.count() == 0
    got = {r["user"]: dict(r["ratings"]) for r in train.collect()}
    assert got == {"1": {"10": 5, "20": 3}, "2": {"10": 4}}


def test_rating_maps_split_heavy_user(spark):
    d = tempfile.mkdtemp(prefix="tastemap-test-")
    _write(f"{d}/r.dat", "".join(f"7::{i}::{1 + i % 5}::0\n" for i in range(50)))
    train, _ = X.read_rating_maps(spark, f"{d}/r.dat", pivot=1.0, chunks=8)
    assert train.count() >= 5
    assert train.select(F.sum(F.size("ratings"))).first()[0] == 50


def test_movielens_csv_quoted(spark):
    d = tempfile.mkdtemp(prefix="tastemap-test-")
    _write(f"{d}/movies.csv", 'movieId,title,genres\n1,"American President, The (1995)",Comedy|Drama\n'
           '2,"Quote ""inside"" (2000)",Drama\n')
    df = X.read_movielens_csv(spark, f"{d}/movies.csv", "movies")
    assert rows(df, "movieId", "title") == [(1, "American President, The (1995)"), (2, 'Quote "inside" (2000)')]


def test_click_log_gzip(spark):
    d = tempfile.mkdtemp(prefix="tastemap-test-")
    with gzip.open(f"{d}/train.gz", "wt") as f:
        f.write("id,click,hour,C1\n1,0,14102100,1005\n2,1,14102101,1002\n3,0,14102123,1005\n")
    df = X.read_click_log(spark, f"{d}/train.gz")
    got = rows(df.select("id", F.date_format("hour", "yyyy-MM-dd HH").alias("h")), "id", "h")
    assert got == [("1", "2014-10-21 00"), ("2", "2014-10-21 01"), ("3", "2014-10-21 23")]
    assert X.read_click_log(spark, f"{d}/train.gz", n_rows=2).count() == 2


def test_model_roundtrip_and_fit_or_load(spark, ratings_df):
    d = tempfile.mkdtemp(prefix="tastemap-test-")
    m = B.bias_fit(ratings_df)
    save_model(m, f"{d}/bias")
    back = load_model(spark, f"{d}/bias")
    assert back.mu == m.mu and rows(back.item_bias, "item", "bi") == rows(m.item_bias, "item", "bi")
    calls = []
    fit_or_load(spark, f"{d}/b2", lambda: calls.append(1) or B.bias_fit(ratings_df))
    fit_or_load(spark, f"{d}/b2", lambda: calls.append(1) or B.bias_fit(ratings_df))
    assert calls == [1]
    assert os.path.isdir(f"{d}/b2/item_bias")


def test_similarity_table_model_roundtrip(spark, ratings_df):
    from tastemap.operators.similarity import item_similarity
    from tastemap.sources.models import TableModel
    d = tempfile.mkdtemp(prefix="tastemap-test-")
    sims = item_similarity(ratings_df)
    save_model(TableModel({"sims": sims}, {"min_threshold": None}), f"{d}/knn")
    back = load_model(spark, f"{d}/knn")
    assert rows(back.tables()["sims"], "i", "j", "sim") == rows(sims, "i", "j", "sim")
    assert back.params == {"min_threshold": None}
