"""Text sources: delimited rating files, the three-file movie data set, its CSV
flavour, user/movie lists, nested rating maps and the gzip click log (S1-S6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import unit_draw

# Column layouts of the three-file movie data set and its CSV flavour.
MOVIELENS_RATINGS = ["UserID", "MovieID", "Rating", "Timestamp"]
MOVIELENS_USERS = ["UserID", "Gender", "Age", "Occupation", "Zip-code"]
MOVIELENS_MOVIES = ["MovieID", "Title", "Genres"]
CSV_SCHEMAS = {
    "ratings": "userId long, movieId long, rating double, timestamp long",
    "tags": "userId long, movieId long, tag string, timestamp long",
    "movies": "movieId long, title string, genres string",
    "links": "movieId long, imdbId string, tmdbId long",
}
CLICK_HOUR_FORMAT = "yyMMddHH"


def _decoded_lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """(line): the text source keeps a line's bytes as they are; decode them."""
    return spark.read.text(path).select(F.decode(F.col("value").cast("binary"), encoding).alias("line"))


def read_delimited(spark: SparkSession, path: str, columns: list[str], delimiter: str = "::",
                   encoding: str = "UTF-8") -> DataFrame:
    """One row per line, split on a literal (multi-character) delimiter, no quoting,
    all strings, empty fields stay empty strings; white space at the end of the line is
    stripped.  A line whose field count differs from ``columns`` fails the read; such
    lines can be listed with ``bad_lines``."""
    fields = _fields(delimiter)
    n = len(columns)
    checked = F.when(F.size(fields) == n, fields).otherwise(F.raise_error(F.concat(
        F.lit(f"expected {n} fields, got "), F.size(fields).cast("string"), F.lit(" in line: "),
        F.substring("line", 1, 200))))
    rows = _decoded_lines(spark, path, encoding).select(checked.alias("f"))
    return rows.select(*[F.col("f")[i].alias(c) for i, c in enumerate(columns)])


def _fields(delimiter: str):
    return F.split(F.regexp_replace("line", r"\s+$", ""), "\\Q" + delimiter + "\\E", -1)


def bad_lines(spark: SparkSession, path: str, columns: list[str], delimiter: str = "::",
              encoding: str = "UTF-8") -> DataFrame:
    """(line, n_fields) of the lines that ``read_delimited`` would fail on."""
    rows = _decoded_lines(spark, path, encoding).select("line", F.size(_fields(delimiter)).alias("n_fields"))
    return rows.where(F.col("n_fields") != len(columns))


def load_movielens(spark: SparkSession, base_dir: str, encoding: str = "ISO-8859-1"
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings, users, movies; ids renamed to user / item and cast; the
    Timestamp stays a string (epoch seconds)."""
    base = base_dir.rstrip("/")
    movies = read_delimited(spark, f"{base}/movies.dat", MOVIELENS_MOVIES, "::", encoding)
    ratings = read_delimited(spark, f"{base}/ratings.dat", MOVIELENS_RATINGS, "::", encoding)
    users = read_delimited(spark, f"{base}/users.dat", MOVIELENS_USERS, "::", encoding)
    movies = movies.withColumnRenamed("MovieID", "item").withColumn("item", F.col("item").cast("long"))
    users = users.withColumnRenamed("UserID", "user").withColumn("user", F.col("user").cast("long"))
    ratings = ratings.select(F.col("UserID").cast("long").alias("user"), F.col("MovieID").cast("long").alias("item"),
                             F.col("Rating").cast("double").alias("rating"), "Timestamp")
    return ratings.where(F.col("rating") != 0), users, movies          # 0 means "not rated"


def read_users(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """User list without the last field (zip code)."""
    return read_delimited(spark, path, MOVIELENS_USERS, "::", encoding).drop(MOVIELENS_USERS[-1])


def read_movies(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Movie list, all fields."""
    return read_delimited(spark, path, MOVIELENS_MOVIES, "::", encoding)


def read_movielens_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """CSV with header, double-quote quoting and escaping, fixed schema."""
    return (spark.read.schema(CSV_SCHEMAS[kind]).option("header", "true").option("quote", '"')
            .option("escape", '"').option("encoding", "UTF-8").option("mode", "PERMISSIVE").csv(path))


def read_rating_maps(spark: SparkSession, path: str, pivot: float = 0.8, seed: int = 1,
                     chunks: int = 1) -> tuple[DataFrame, DataFrame]:
    """Ratings file -> train and test tables of (user, chunk, map<item, rating>).
    A row goes to train when its md5 draw in [0, 1) is below ``pivot``.  ``chunks`` map
    rows per user (chunk = hash of the item), so that a user with very many ratings can
    be spread over several rows; the union of a user's chunks is the user's map."""
    r = read_delimited(spark, path, MOVIELENS_RATINGS, "::").select(
        F.col("UserID").alias("user"), F.col("MovieID").alias("item"), F.col("Rating").cast("int").alias("rating"))
    r = r.withColumn("_train", unit_draw(F.col("user"), F.col("item"), F.lit(seed)) < F.lit(pivot))
    r = r.withColumn("chunk", F.pmod(F.xxhash64("item"), F.lit(chunks)))

    def maps(df: DataFrame) -> DataFrame:
        return df.groupBy("user", "chunk").agg(
            F.map_from_entries(F.collect_list(F.struct("item", "rating"))).alias("ratings"))

    return maps(r.where(F.col("_train"))), maps(r.where(~F.col("_train")))


def read_click_log(spark: SparkSession, path: str, n_rows: int | None = None,
                   partitions: int | None = None) -> DataFrame:
    """S3: gzip CSV with header, all columns strings except ``hour`` parsed from
    yyMMddHH.  ``n_rows`` keeps the first rows of the file (the reader's own
    sampling option).  A gzip file is one split, so the rows are repartitioned
    for the stages that follow."""
    df = (spark.read.option("header", "true").option("inferSchema", "false").option("mode", "PERMISSIVE")
          .csv(path))
    if n_rows is not None:
        df = df.limit(n_rows)
    df = df.withColumn("hour", F.to_timestamp(F.col("hour"), CLICK_HOUR_FORMAT))
    return df.repartition(partitions or spark.sparkContext.defaultParallelism)
