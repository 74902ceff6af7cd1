"""Registered source/sink queries (S1-S7): each writes a fixture table with Spark
to a fresh folder under the shared checkpoint folder and reads it back through
the operator; the oracle computes the same rows from the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bias as B
from ..session import scratch_path
from ..sources import text as X
from ..sources.models import fit_or_load
from ..sources.tables import read_table
from .common import R_CTE, SEED, bias_ctes, finish, md5_draw_sql, ratings
from .queries import register


def write_delimited(df: DataFrame, path: str, delimiter: str = "::") -> str:
    df.select(F.concat_ws(delimiter, *[F.col(c).cast("string") for c in df.columns]).alias("v")) \
        .write.mode("overwrite").text(path)
    return path


def _raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i"), F.col("l_quantity").cast("int").alias("r"),
        F.unix_timestamp("o_orderdate").alias("ts"))


def _users_file(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", F.col("c_nationkey").alias("age"), F.col("c_nationkey").alias("occupation"),
        "c_name")


def _movies_file(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "part").select("p_partkey", "p_name", "p_type")


_RAW_SQL = """FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""


@register("delimited_roundtrip", f"""
SELECT CAST(o_custkey AS VARCHAR) AS UserID, CAST(l_partkey AS VARCHAR) AS MovieID,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS Rating,
       CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS "Timestamp" {_RAW_SQL}""")
def delimited_roundtrip(spark, sf):
    """Order lines written as user::item::quantity::epoch, read back as strings."""
    path = write_delimited(_raw_lines(spark, sf), scratch_path(spark, "ratings_dat"))
    return X.read_delimited(spark, path, X.MOVIELENS_RATINGS, "::")


@register("movielens_roundtrip", f"""
SELECT o_custkey AS "user", l_partkey AS item, CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS rating,
       CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS "Timestamp", p_name AS Title, c_mktsegment AS Gender
{_RAW_SQL} JOIN part ON p_partkey = l_partkey JOIN customer ON c_custkey = o_custkey""")
def movielens_roundtrip(spark, sf):
    """Three '::' files (ratings, users, movies) loaded and cast, ratings joined
    with movie titles and user genders."""
    base = scratch_path(spark, "movielens")
    write_delimited(_raw_lines(spark, sf), f"{base}/ratings.dat")
    write_delimited(_users_file(spark, sf), f"{base}/users.dat")
    write_delimited(_movies_file(spark, sf), f"{base}/movies.dat")
    r, u, m = X.load_movielens(spark, base)
    return finish(r.join(m.select("item", "Title"), "item").join(u.select("user", "Gender"), "user"))


@register("people_list_roundtrip", """
SELECT CAST(c_custkey AS VARCHAR) AS UserID, c_mktsegment AS Gender, CAST(c_nationkey AS VARCHAR) AS Age,
       CAST(c_nationkey AS VARCHAR) AS Occupation FROM customer""")
def people_list_roundtrip(spark, sf):
    """User list read without its last field."""
    path = write_delimited(_users_file(spark, sf), scratch_path(spark, "users_dat"))
    return X.read_users(spark, path)


@register("csv_roundtrip", """
SELECT p_partkey AS movieId, p_name || ', ' || p_brand AS title, replace(p_type, ' ', '|') AS genres FROM part""")
def csv_roundtrip(spark, sf):
    """Movies.csv with header; titles contain commas, so the writer quotes them."""
    path = scratch_path(spark, "movies_csv")
    (read_table(spark, sf, "part")
     .select(F.col("p_partkey").alias("movieId"), F.concat_ws(", ", "p_name", "p_brand").alias("title"),
             F.regexp_replace("p_type", " ", "|").alias("genres"))
     .write.mode("overwrite").option("header", "true").option("quote", '"').option("escape", '"').csv(path))
    return X.read_movielens_csv(spark, path, "movies")


@register("click_log_roundtrip", """
SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS click,
       strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour FROM events""")
def click_log_roundtrip(spark, sf):
    """S3: events written as a gzip click log (hour as yyMMddHH), read back with the
    hour parsed."""
    path = scratch_path(spark, "clicks_gz")
    (read_table(spark, sf, "events")
     .select(F.col("event_id").alias("id"), (F.col("event_type") == "purchase").cast("int").alias("click"),
             F.date_format("ts", X.CLICK_HOUR_FORMAT).alias("hour"))
     .write.mode("overwrite").option("header", "true").option("compression", "gzip").csv(path))
    df = X.read_click_log(spark, path)
    return df.select("id", "click", F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"))


@register("ratings_map_per_user", f"""
WITH {R_CTE},
D AS (SELECT "user", CAST(rating AS INTEGER) AS rating,
             {md5_draw_sql('"user"', 'item', str(SEED))} / 4294967296.0 < 0.8 AS tr FROM R)
SELECT "user", CAST(sum(CASE WHEN tr THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
       CAST(sum(CASE WHEN tr THEN rating ELSE 0 END) AS BIGINT) AS sum_train,
       CAST(sum(CASE WHEN tr THEN 0 ELSE 1 END) AS BIGINT) AS n_test,
       CAST(sum(CASE WHEN tr THEN 0 ELSE rating END) AS BIGINT) AS sum_test
FROM D GROUP BY "user" """)
def ratings_map_per_user(spark, sf):
    """Ratings file -> per-user {item: rating} maps for train (draw < 0.8) and
    test; flattened to map sizes and value sums per user."""
    r = ratings(spark, sf).select("user", "item", F.col("rating").cast("int"), F.lit(0).alias("ts"))
    path = write_delimited(r, scratch_path(spark, "ratings_maps"))
    train, test = X.read_rating_maps(spark, path, 0.8, SEED)

    def per_user(df, tag):
        vals = F.aggregate(F.map_values("ratings"), F.lit(0).cast("long"), lambda a, x: a + x)
        return df.groupBy("user").agg(F.sum(F.size("ratings")).cast("long").alias(f"n_{tag}"),
                                      F.sum(vals).cast("long").alias(f"sum_{tag}"))

    out = per_user(train, "train").join(per_user(test, "test"), "user", "full")
    return out.select(F.col("user").cast("long").alias("user"),
                      *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
                        for c in ("n_train", "sum_train", "n_test", "sum_test")])


@register("model_roundtrip", f"""
WITH {R_CTE}, {bias_ctes('R')}
SELECT 'mu' AS kind, CAST(NULL AS BIGINT) AS id, round(mu, 6) AS value FROM MU
UNION ALL SELECT 'item', item, round(bi, 6) FROM BI
UNION ALL SELECT 'user', "user", round(bu, 6) FROM BU""")
def model_roundtrip(spark, sf):
    """fit_or_load twice on one path: the first call fits and saves the bias
    model, the second loads it; the loaded tables are returned."""
    path = scratch_path(spark, "bias_model")
    r = ratings(spark, sf)
    fit_or_load(spark, path, lambda: B.bias_fit(r))
    m = fit_or_load(spark, path, lambda: (_ for _ in ()).throw(RuntimeError("must load, not fit")))
    mu = spark.range(1).select(F.lit("mu").alias("kind"), F.lit(None).cast("long").alias("id"),
                               F.lit(m.mu).alias("value"))
    items = m.item_bias.select(F.lit("item").alias("kind"), F.col("item").alias("id"), F.col("bi").alias("value"))
    users = m.user_bias.select(F.lit("user").alias("kind"), F.col("user").alias("id"), F.col("bu").alias("value"))
    return finish(mu.unionByName(items).unionByName(users))
