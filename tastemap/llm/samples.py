"""Bounded, reproducible samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import md5_draw
from .common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, seed: int,
                    id_col: str = "doc_id", label_id: str = "doc_id") -> DataFrame:
    """``docs`` rows of at most ``rows`` labelled, not held-out ids (those with the smallest
    md5 draw of the id), with column ``label`` 0/1.

    The ids are chosen from the labels alone, so only the sampled texts move; the chosen
    ids (at most ``rows`` of them) are broadcast.  Null labels and ids are no labels; of
    several labels of one id the largest counts; of repeated rows of one id one is used."""
    chosen = (labels.select(F.col(label_id).alias("__id"), F.col(label).cast("int").alias("__label"))
              .filter("__id is not null and __label is not null")
              .filter(~held_out(F.col("__id")))
              .groupBy("__id").agg(F.max("__label").alias("__label"))
              .withColumn("__draw", md5_draw(F.col("__id"), seed))
              .orderBy("__draw", "__id").limit(rows))
    return (docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__id"))
            .withColumn("label", (F.col("__label") > 0).cast("int")))


def epochs_in_order(sample: DataFrame, epochs: int) -> DataFrame:
    """The sample ``epochs`` times over as one ordered partition (bounded by the sample),
    shuffled anew in each epoch; rows carry __id and __draw."""
    return (sample.dropDuplicates(["__id"])
            .withColumn("__epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
            .withColumn("__order", md5_draw(F.col("__id"), F.col("__epoch")))
            .repartition(1).sortWithinPartitions("__epoch", "__order", "__id"))
