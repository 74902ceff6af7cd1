"""Shared pieces of the registered queries: fixture loading, rounding, SQL CTEs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators.prep import split_per_group, train_test
from pyspark import StorageLevel
from ..sources.tables import fixture_ratings

DIGITS = 6
SEED = 1
TEST_FRAC = 0.1


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column so two engines hash the same values."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R, cached once per query (the prepared ratings table every later action of
    the query reads instead of re-joining).  Its lineage is short and
    deterministic (parquet scans, a join, an aggregate), so a lost partition is
    recomputed exactly; iterative lineages are cut with reliable checkpoints."""
    return fixture_ratings(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Per-user 10 % md5 hold-out of R (seed 1): (train, test), from one cached
    flagged table (the md5 draw makes it deterministic)."""
    flagged = split_per_group(ratings(spark, sf_dir), TEST_FRAC, "user", SEED)
    return train_test(flagged.persist(StorageLevel.MEMORY_AND_DISK))


# ------------------------------------------------------------------ SQL (DuckDB)

R_CTE = """R AS (
  SELECT o_custkey AS "user", l_partkey AS item,
         CAST(ceil(avg(l_quantity) / 10) AS DOUBLE) AS rating
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY o_custkey, l_partkey)"""


def md5_draw_sql(*parts: str) -> str:
    s = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5({s}), 1, 8)) AS BIGINT)"


SPLIT_CTE = f"""S AS (
  SELECT "user", item, rating,
         row_number() OVER (PARTITION BY "user" ORDER BY {md5_draw_sql('"user"', 'item', str(SEED))}, "user", item) AS rn,
         count(*) OVER (PARTITION BY "user") AS n
  FROM R),
TR AS (SELECT "user", item, rating FROM S WHERE rn > round_even(CAST({TEST_FRAC} AS DOUBLE) * n, 0)),
TE AS (SELECT "user", item, rating FROM S WHERE rn <= round_even(CAST({TEST_FRAC} AS DOUBLE) * n, 0))"""


def bias_ctes(src: str, prefix: str = "", user_damping: float = 10, item_damping: float = 25) -> str:
    """mu / bi / bu CTEs over table ``src`` (same arithmetic order as the Spark code)."""
    p = prefix
    return f"""{p}MU AS (SELECT avg(rating) AS mu FROM {src}),
{p}BI AS (SELECT item, (sum(rating) - count(*) * max(mu)) / (CAST({item_damping} AS DOUBLE) + count(*)) AS bi
        FROM {src}, {p}MU GROUP BY item),
{p}BU AS (SELECT "user", sum(rating - mu - bi) / (CAST({user_damping} AS DOUBLE) + count(*)) AS bu
        FROM {src} JOIN {p}BI USING (item), {p}MU GROUP BY "user")"""


def materialized(ctes: str) -> str:
    """The same CTEs, each computed once whatever the planner makes of its readers."""
    return re.sub(r'(^|[\s,])("?\w+"?) AS \(\s*(?=SELECT)', r"\1\2 AS MATERIALIZED (", ctes)
