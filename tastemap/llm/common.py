"""Helpers of the corpus operators: table access, written intermediates, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: later readers start from
    the files (lost executors cost a re-read, not a recomputation)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that extra columns cannot clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpacked(df: DataFrame, schema, name: str = "row") -> DataFrame:
    return df.select(*[F.col(f"{name}.`{c}`").alias(c) for c in schema.fieldNames()])


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for rows that no fit may learn labels from: crc32(doc_id as text) mod 5 is 0
    (rows without an id count as held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def broadcast_value(df: DataFrame, value):
    return df.sparkSession.sparkContext.broadcast(value)
