"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

A source with target weight w that holds ``size`` of ``total`` gets the mean repetition
rate w * total / size.  Every document inverts a Poisson distribution with its source's
rate at a uniform number hashed from its id, so its count of copies depends on nothing
but its id and the rate; it is exploded by the count, and the copies are put in the order
of a hash of (id, copy): a global shuffle that any rerun repeats.

Rates over ``PART_RATE`` are split into equal parts whose counts add up (a sum of Poisson
counts is one), so no probability underflows.  Source sizes are pre-aggregated before
their shuffle and reach the documents by a broadcast while there are at most
``BROADCAST_SOURCES`` of them, else by a join in which every source is spread over
``SALT`` keys; a source with a third of all rows is no hot group either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import md5_draw, unit_draw
from .common import packed, written

PART_RATE = 16.0
PART_TERMS = 80               # P(Poisson(16) >= 80) is below 1e-26, the draws have 32 bits
BROADCAST_SOURCES = 100_000   # rows of a name and a few numbers
SALT = 32
SEED = 5

# Target weights of the registered query; all other sources share the rest by size.
TARGETS = {"src0": 0.20, "src1": 0.10, "src2": 0.10, "src3": 0.05}


def source_rates(docs: DataFrame, targets: dict[str, float], source_col: str, size: Column) -> DataFrame:
    """(source, size, weight, rate) per source.  Sources without a target share what the
    targets leave in proportion to their sizes; weights are scaled to add up to one over
    the sources there are.  A source of size 0 keeps rate 1."""
    named = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv]) if targets else F.create_map()
    left = max(0.0, 1.0 - sum(targets.values()))
    sizes = (docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).cast("double").alias("size"))
             .withColumn("target", named[F.col("source")].cast("double") if targets else F.lit(None).cast("double")))
    totals = sizes.agg(F.sum("size").alias("total"),
                       F.coalesce(F.sum(F.when(F.col("target").isNull(), F.col("size"))), F.lit(0.0)).alias("free"),
                       F.coalesce(F.sum(F.when(F.col("size") > 0, F.col("target"))), F.lit(0.0)).alias("named"))
    weight = F.coalesce("target", F.when(F.col("free") > 0, F.lit(left) * F.col("size") / F.col("free")))
    scale = F.col("named") + F.when(F.col("free") > 0, F.lit(left)).otherwise(0.0)
    return (sizes.crossJoin(F.broadcast(totals))                       # one row
            .withColumn("weight", F.when((F.col("size") > 0) & (scale > 0), weight / scale).otherwise(0.0))
            .withColumn("rate", F.when((F.col("size") > 0) & (scale > 0),
                                       F.col("weight") * F.col("total") / F.col("size")).otherwise(1.0))
            .select("source", "size", "weight", "rate"))


def poisson_steps(rate: Column) -> Column:
    """struct(parts, cdf): into how many parts the rate is split, and the cumulative
    probabilities of one part's count."""
    parts = F.greatest(F.ceil(rate / PART_RATE), F.lit(1)).cast("int")
    mean = rate / parts
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("cdf"))

    def grow(acc, k):
        p = acc["p"] * mean / k
        c = acc["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(acc["cdf"], F.array(c)).alias("cdf"))
    terms = F.sequence(F.lit(1), F.lit(PART_TERMS)).cast("array<double>")
    return F.struct(parts.alias("parts"), F.aggregate(terms, start, grow, lambda acc: acc["cdf"]).alias("cdf"))


def poisson_count(key: Column, seed: int, steps: Column) -> Column:
    """The count whose cumulative probability first exceeds the uniform number hashed from
    (key, seed, part), added up over the parts."""
    def one(j):
        u = unit_draw(key, F.lit(seed), j)
        return F.size(F.filter(steps["cdf"], lambda c: c <= u))
    return F.aggregate(F.transform(F.sequence(F.lit(0), steps["parts"] - 1), one),
                       F.lit(0), lambda acc, n: acc + n)


def mix_sources(docs: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id",
                source_col: str = "source", text_col: str = "text", seed: int = SEED,
                broadcast_sources: int = BROADCAST_SOURCES) -> DataFrame:
    """(row, copy, shuffle_key) per copy in shuffled order: ``row`` has all columns of
    ``docs``, ``copy`` counts from 1.  Sizes are in characters.

    Null sources are one source without a target; null texts have size 0; rows with one
    id have the same count (null ids draw by their text); an empty table gives no rows;
    extra columns ride along in ``row``."""
    targets = TARGETS if targets is None else targets
    text = F.coalesce(F.col(text_col), F.lit(""))
    rates = written(source_rates(docs, targets, source_col, F.length(text)), "source-rates")
    rates = rates.select(F.col("source").alias("__source"), poisson_steps(F.col("rate")).alias("__steps"))
    base = docs.select(packed(docs), F.col(source_col).alias("__source"),
                       F.coalesce(F.col(id_col).cast("string"), F.md5(text)).alias("__key"))
    if rates.count() <= broadcast_sources:
        joined = base.join(F.broadcast(rates), base["__source"].eqNullSafe(rates["__source"]))
    else:
        spread = rates.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        salted = base.withColumn("__salt", F.pmod(F.xxhash64("__key"), F.lit(SALT)).cast("int"))
        joined = salted.join(spread, salted["__source"].eqNullSafe(spread["__source"])
                             & (salted["__salt"] == spread["__salt"]))
    counted = joined.select("row", "__key", poisson_count(F.col("__key"), seed, F.col("__steps")).alias("__n"))
    copies = (counted.filter("__n > 0")
              .select("row", "__key", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("copy")))
    return (copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", "__key", "copy", F.lit(str(seed)))))
            .orderBy("shuffle_key", "__key", "copy").select("row", "copy", "shuffle_key"))


# ------------------------------------------------------------------ the same in SQL

def mixing_sql(targets: dict[str, float] | None = None, seed: int = SEED, table: str = "documents",
               select: str = "doc_id, text, lang, source, n_chars, copy, shuffle_key") -> str:
    targets = TARGETS if targets is None else targets
    named = ", ".join(f"('{k}', CAST({v!r} AS DOUBLE))" for k, v in targets.items())
    left = repr(max(0.0, 1.0 - sum(targets.values())))
    return f"""
WITH RECURSIVE named(name, target) AS (VALUES {named}),
docs AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS key,
                length(coalesce(text, '')) AS chars FROM {table}),
sizes AS (SELECT source, CAST(sum(chars) AS DOUBLE) AS size, max(target) AS target
          FROM docs LEFT JOIN named ON source = name GROUP BY source),
totals AS (SELECT sum(size) AS total, coalesce(sum(size) FILTER (target IS NULL), 0) AS free,
                  coalesce(sum(target) FILTER (size > 0), 0) AS known FROM sizes),
rates AS (SELECT source,
                 CASE WHEN size > 0 AND known + (CASE WHEN free > 0 THEN {left} ELSE 0 END) > 0
                      THEN coalesce(target, CASE WHEN free > 0 THEN CAST({left} AS DOUBLE) * size / free END)
                           / (known + (CASE WHEN free > 0 THEN {left} ELSE 0 END)) * total / size
                      ELSE 1 END AS rate
          FROM sizes, totals),
parts AS (SELECT source, greatest(CAST(ceil(rate / {PART_RATE}) AS INTEGER), 1) AS parts, rate FROM rates),
steps(source, parts, mean, k, p, c) AS (
  SELECT source, parts, rate / parts, 0, exp(-(rate / parts)), exp(-(rate / parts)) FROM parts
  UNION ALL
  SELECT source, parts, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM steps WHERE k < {PART_TERMS}),
cdf AS (SELECT source, any_value(parts) AS parts, list(c ORDER BY k) AS cdf FROM steps GROUP BY source),
counted AS (
  SELECT d.*, list_sum(list_transform(range(0, parts), lambda j: len(list_filter(cdf, lambda c: c <=
           CAST(('0x' || substr(md5(key || ':{seed}:' || j), 1, 8)) AS BIGINT) / 4294967296.0)))) AS n
  FROM docs d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source),
copies AS (SELECT *, unnest(range(1, CAST(n AS BIGINT) + 1)) AS copy FROM counted WHERE n > 0)
SELECT {select} FROM (
  SELECT * REPLACE (CAST(copy AS INTEGER) AS copy), md5(key || ':' || copy || ':{seed}') AS shuffle_key FROM copies)"""
