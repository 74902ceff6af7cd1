"""Corpus pipeline: documents -> filtered, deduplicated, mixed and packed sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet and rereads as the next stage's docs.  All but
the last return the columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm import linededup, mixing, packing, simhash, toxicity
from tastemap.llm.common import table, unpacked, written
from tastemap.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (fitted on the labelled ones) does not reject."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of recurring templates that an earlier document
    has; n_chars follows the text."""
    found = linededup.dedup_lines(docs)
    schema = docs.schema
    out = found.select("row", F.col("text").alias("__text"), F.col("n_dropped").alias("__lost"))
    return out.select(*[
        F.col("__text").alias(c) if c == "text" else
        F.when(F.col("__lost") > 0, F.length("__text")).otherwise(F.col("row.n_chars")).cast(schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in schema.fieldNames()])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    ship_package(spark)
    return simhash.simhash_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in shuffled order."""
    return unpacked(mixing.mix_sources(docs), docs.schema)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: its document, its ids' place in the document and in a sequence."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("SimHash near-dedup", drop_near_copies),
          ("mixing sources", mix_sources), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier, the fingerprints and the vocabulary have no SQL form; the stages are
# tested one by one against brute force (tests/llm/test_pipeline.py).
ORACLE_SQL = None
