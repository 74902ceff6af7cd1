"""URL filter: host and path rules, and for the rest a ratio of character language models.

Rules name a host and a path start; the longest one that fits decides.  The URLs that
rules accept and reject train two smoothed variable-order Markov models over characters:
Spark counts, over all such URLs, every context of up to ``ORDER`` characters with and
without its next character, each under its own key; a character's probability at
order k mixes its count after the last k characters with the probability at order
k - 1, so that the order in effect follows the evidence.  The counts stay a Spark table
that grows with the URLs.  The score of a URL is the length-normalised log-likelihood
difference; the threshold that separates the accepted and rejected URLs best is found
on histograms of their scores.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import broadcast_value, written

ORDER = 5
WINDOWS_PER_TASK = 200_000    # distinct windows whose probabilities a task works out
BLOCK_BYTES = 1 << 20         # of URLs scored together
MIX_WEIGHT = 2.0              # how many observations the shorter context counts as
BINS = 4001                   # histogram of scores between -8 and 8 nats a character
SPAN = 8.0

# The rules of the registered query.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ------------------------------------------------------------------ parts and rules

def split_url(df: DataFrame, url_col: str = "url") -> DataFrame:
    """``df`` with ``host`` and ``path`` (both empty for a null url or one without '://')."""
    url = F.col(url_col)
    after = F.when(F.locate("://", url) > 0,
                   F.substring(url, F.locate("://", url) + F.lit(3), F.length(url))).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return df.withColumn("host", F.translate(host, _UPPER, _LOWER)).withColumn("path", path)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        at = rule.index("/") if "/" in rule else len(rule)
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


# ------------------------------------------------------------------ character models

def windows_of(texts: list[str], order: int = ORDER):
    """(windows, owner): of every character of every text, the character and the ``order``
    before it as one integer (the character in the lowest byte), and its text's place.
    Every text is read with a start mark before and an end mark after; its characters are
    its UTF-8 bytes."""
    raw = [t.encode("utf-8", "surrogatepass") + b"\x03" for t in texts]
    pad = b"\x02" * order
    data = np.frombuffer(pad + pad.join(raw), dtype=np.uint8).astype(np.int64)
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    owner = np.repeat(np.arange(len(raw)), lengths)
    starts = order + np.concatenate(([0], np.cumsum(lengths + order)[:-1])) if len(raw) else np.empty(0, np.int64)
    at = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
    windows = np.zeros(len(at), dtype=np.int64)
    for k in range(order + 1):
        windows |= data[at - k] << (8 * k)
    return windows, owner


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(window, rejected, accepted): how often each window of ``ORDER`` + 1 characters
    occurs over all rows of ``labelled`` (text, accepted), pre-aggregated per batch.  The
    counts of all shorter grams and contexts are sums of these."""
    def count(batches):
        import pyarrow as pa
        for batch in batches:
            texts = batch.column(0).to_pylist()
            accepted = batch.column(1).to_pylist()
            for side in (False, True):
                own = [t for t, a in zip(texts, accepted) if bool(a) == side and t]
                for s in range(0, len(own), 2000):
                    window, n = np.unique(windows_of(own[s:s + 2000])[0], return_counts=True)
                    none = np.zeros(len(n), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(window), pa.array(none if side else n), pa.array(n if side else none)],
                        names=["window", "rejected", "accepted"])
    part = labelled.select("text", "accepted").mapInArrow(count, "window long, rejected long, accepted long")
    return _summed(part, F.col("window"), "window")


def _summed(counts: DataFrame, key: Column, name: str) -> DataFrame:
    return counts.groupBy(key.alias(name)).agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted"))


def _low_bytes(key: Column, n: int) -> Column:
    return key.bitwiseAND(F.lit((1 << 8 * n) - 1))


def _dense_pairs(counts: DataFrame, key: Column) -> np.ndarray:
    """Counts by a key of two bytes, of shape (2, 2**16)."""
    rows = _summed(counts, key, "pair").toArrow()                 # at most 2**16 rows
    table = np.zeros((2, 1 << 16))
    for side, name in enumerate(("rejected", "accepted")):
        table[side, rows["pair"].to_numpy()] = rows[name].to_numpy()
    return table


class CharModels:
    """Both models as tables of exact counts: windows and three-character grams stay
    Spark tables, pairs of characters are dense arrays."""

    def __init__(self, counts: DataFrame, trigrams: DataFrame, pairs: np.ndarray, contexts: np.ndarray):
        self.counts, self.trigrams, self.contexts = counts, trigrams, contexts
        square = pairs.reshape(2, 256, 256)                       # side, character before, character
        self.both_sides = bool(pairs.sum(axis=1).all())
        p = np.full((2, 1), 1 / 256)
        p = (square.sum(axis=1) + MIX_WEIGHT * p) / (pairs.sum(axis=1, keepdims=True) + MIX_WEIGHT)
        p = (square + MIX_WEIGHT * p[:, None, :]) / (square.sum(axis=2, keepdims=True) + MIX_WEIGHT)
        self.after_one = p.reshape(2, -1)                         # probability after one character

    @classmethod
    def of(cls, counts: DataFrame) -> "CharModels":
        counts = written(counts, "url-windows")
        trigrams = written(_summed(counts, _low_bytes(F.col("window"), 3), "gram"), "url-trigrams")
        return cls(counts, trigrams, _dense_pairs(trigrams, _low_bytes(F.col("gram"), 2)),
                   _dense_pairs(trigrams, F.shiftright("gram", 8)))

    def differences(self, wanted: DataFrame) -> DataFrame:
        """(window, difference) of the windows ``wanted``: the log-probability of the last
        character under the accepted model minus that under the rejected.

        Windows that share their last three context characters meet in a task, where the
        counts of orders 3 to ``ORDER`` are sums over its rows."""
        zero = F.lit(0).cast("long")
        asked = wanted.select("window").distinct().select("window", zero.alias("rejected"), zero.alias("accepted"),
                                                          F.lit(True).alias("asked"))
        every = (self.counts.withColumn("asked", F.lit(False)).unionByName(asked).groupBy("window")
                 .agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted"),
                      F.max("asked").alias("asked")))
        grams = self.trigrams.select("gram", F.col("rejected").alias("rejected3"), F.col("accepted").alias("accepted3"))
        every = (every.withColumn("gram", _low_bytes(F.col("window"), 3)).join(grams, "gram", "left")
                 .select("window", "rejected", "accepted", F.coalesce("rejected3", zero).alias("rejected3"),
                         F.coalesce("accepted3", zero).alias("accepted3"), "asked"))
        every = written(every, "url-grams")
        buckets = max(1, -(-every.count() // WINDOWS_PER_TASK))
        context = _low_bytes(F.shiftright("window", 8), 3)
        shared = broadcast_value(self.counts, (self.after_one, self.contexts))

        def mixed(table):
            import pyarrow as pa
            after_one, contexts = shared.value
            window = table["window"].to_numpy()
            keys = {}
            for k in range(3, ORDER + 1):
                keys[k] = [np.unique(z, return_inverse=True)[1] for z in
                           (window & ((1 << 8 * (k + 1)) - 1), (window >> 8) & ((1 << 8 * k) - 1))]
            difference = 0.0
            for side, sign, name in ((1, 1.0, "accepted"), (0, -1.0, "rejected")):
                own = table[name].to_numpy()
                p = ((table[name + "3"].to_numpy() + MIX_WEIGHT * after_one[side, window & 0xFFFF])
                     / (contexts[side, (window >> 8) & 0xFFFF] + MIX_WEIGHT))
                for gram, ctx in keys.values():
                    p = (np.bincount(gram, own)[gram] + MIX_WEIGHT * p) / (np.bincount(ctx, own)[ctx] + MIX_WEIGHT)
                difference = difference + sign * np.log(p)
            asked = table["asked"].to_numpy().astype(bool)
            return pa.table({"window": pa.array(window[asked]), "difference": pa.array(difference[asked])})

        return (every.groupBy(F.pmod(F.xxhash64(context), F.lit(buckets)).alias("bucket"))
                .applyInArrow(lambda key, table: mixed(table), "window long, difference double"))

    def score(self, texts: list[str]) -> np.ndarray:
        """Mean log-probability under the accepted model minus that under the rejected, of
        a few texts."""
        if not self.both_sides:
            return np.zeros(len(texts))
        spark = self.counts.sparkSession
        wanted = np.unique(windows_of([t for t in texts if t])[0]).tolist()
        found = self.differences(spark.createDataFrame([(w,) for w in wanted], "window long")).toArrow()
        return _mean_differences(texts, found["window"].to_numpy(), found["difference"].to_numpy())


def _mean_differences(texts: list[str], window: np.ndarray, difference: np.ndarray) -> np.ndarray:
    out = np.zeros(len(texts))
    full = [i for i, t in enumerate(texts) if t]
    if not full:
        return out
    order = np.argsort(window)
    mine, owner = windows_of([texts[i] for i in full])
    values = difference[order][np.searchsorted(window[order], mine)]
    out[full] = np.bincount(owner, values, len(full)) / np.bincount(owner, minlength=len(full))
    return out


def in_blocks(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with ``block``: rows that follow one another, about ``BLOCK_BYTES`` of text."""
    schema = StructType([*df.schema.fields, StructField("block", LongType())])
    place = df.columns.index(text_col)

    def number(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
            ends = seen + np.cumsum(lengths.astype(np.int64) + ORDER)
            seen = int(ends[-1]) if len(ends) else seen
            block = (np.int64(part) << 32) + ends // BLOCK_BYTES
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], names=schema.fieldNames())
    return df.mapInArrow(number, schema)


def with_score(blocked: DataFrame, models: CharModels, text_col: str, out: str = "score") -> DataFrame:
    """``blocked`` (with ``block``, as in_blocks numbers it) with the score of each text.
    A block asks for each of its windows once, however often it occurs."""
    if not models.both_sides:
        return blocked.withColumn(out, F.lit(0.0)).drop("block")

    def ask(batches):
        import pyarrow as pa
        for batch in batches:
            blocks, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for block in np.unique(blocks).tolist():
                window = np.unique(windows_of([texts[i] for i in np.flatnonzero(blocks == block) if texts[i]])[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(window), block)), pa.array(window)],
                                                 names=["block", "window"])
    asked = written(blocked.select("block", text_col).mapInArrow(ask, "block long, window long").distinct(), "url-asked")
    answers = asked.join(models.differences(asked), "window").select("block", "window", "difference")
    schema = StructType([*blocked.schema.fields, StructField(out, DoubleType())])

    def answer(rows, found):
        import pyarrow as pa
        score = _mean_differences(rows[text_col].to_pylist(), found["window"].to_numpy(), found["difference"].to_numpy())
        return rows.append_column(out, pa.array(score))
    return (blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(answer, schema).drop("block"))


def calibrated_threshold(scored: DataFrame) -> float:
    """The score at which the shares of accepted URLs above and rejected URLs below add up
    to the most (ties: nearest to zero), from two histograms of ``BINS`` rows."""
    bin_of = F.least(F.greatest(F.floor((F.col("score") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1))
    rows = scored.groupBy(bin_of.alias("bin"), "accepted").agg(F.count("*").alias("n")).collect()
    table = np.zeros((2, BINS))
    for r in rows:
        table[int(r["accepted"]), int(r["bin"])] += r["n"]
    if not table.sum(axis=1).all():
        return 0.0
    below = np.concatenate(([0.0], np.cumsum(table[0]))) / table[0].sum()
    above = 1 - np.concatenate(([0.0], np.cumsum(table[1]))) / table[1].sum()
    edges = np.arange(BINS + 1) / BINS * 2 * SPAN - SPAN
    gain = below + above
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


# ------------------------------------------------------------------ operator

def filter_urls(pages: DataFrame, url_col: str = "url", id_col: str = "page_id", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, score, threshold) per row.

    verdict is the rule's, else ``allow`` where the score reaches the threshold and
    ``block`` below.  Null urls have empty host and path and score 0; with no accepted or
    no rejected URL to learn from, every score and the threshold are 0 (allow).  Repeated
    rows and null ids are judged like any other; extra columns play no part."""
    base = split_url(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("text")), "text")
    base = base.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    base = written(in_blocks(base, "text"), "url-blocks")
    labelled = base.filter("found is not null").select("text", (F.col("found.verdict") == "allow").alias("accepted"))
    models = CharModels.of(gram_counts(labelled))
    scored = written(with_score(base, models, "text"), "url-scores")
    known = scored.filter("found is not null").select("score", (F.col("found.verdict") == "allow").alias("accepted"))
    threshold = calibrated_threshold(known)
    own = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select("id", "host", "path", F.col("found.rule").alias("rule"),
                         F.coalesce("found.verdict", own).alias("verdict"), "score",
                         F.lit(threshold).alias("threshold"))
