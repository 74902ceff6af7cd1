"""SimHash near-duplicates by multi-index hashing.

Fingerprints are compared once per distinct value.  For at most ``max_bits`` differing
bits over m segments the general pigeonhole holds: with r = max_bits // m and
a = max_bits % m, one of the first a + 1 segments differs in at most r bits, or one of
the others in at most r - 1.  Every fingerprint is stored in the table of each segment,
and looked up under the values in the small Hamming ball around its segment (only the
larger ones, so that a pair meets from one side); the rows that meet under one
(segment, value) are verified on all 64 bits.

Rows of a bucket are compared in blocks of at most ``block`` fingerprints; a larger
bucket is dealt out as pairs of blocks, so no task ever holds more than two of them.
Within a bucket only the edges of a spanning forest are emitted (each fingerprint is
compared with all that are not yet reached), never all pairs; the components of those
edges are the components of all links.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked, written
from .components import connected_components
from .features import texts_of

SHINGLE = 4
MAX_BITS = 4
SEGMENTS = (22, 21, 21)
BLOCK = 4096
SEED = 42
BROADCAST_ROWS = 200_000          # rows of 12 bytes; more heavy buckets are joined by a shuffle


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of ``text`` (A-Z lower-cased, words
    split at ASCII white space; 0 without words)."""
    import xxhash
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [hash_of(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        hashes = [hash_of(joined[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    n, counts = len(hashes), np.zeros(64, dtype=np.int64)
    h = np.array(hashes, dtype="<u8")
    for i in range(0, n, 1 << 15):
        bits = np.unpackbits(h[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed_bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(packed_bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    @F.arrow_udf("long")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle) for t in texts_of(texts)], pa.int64())
    return docs.withColumn(out, compute(F.col(text)))


def hex16(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ------------------------------------------------------------------ candidate rows

def ball_masks(bits: int, radius: int) -> list[int]:
    return [sum(1 << b for b in chosen) for k in range(1, radius + 1) for chosen in combinations(range(bits), k)]


def radii(max_bits: int, segments) -> list[int]:
    m = len(segments)
    r, a = divmod(max_bits, m)
    return [r if i <= a else r - 1 for i in range(m)]


def _probe_rows(segments, max_bits: int):
    """Arrow batches of fingerprints -> (bucket, fp, stored) rows."""
    plan = []
    shift = 0
    for width, radius in zip(segments, radii(max_bits, segments)):
        if radius >= 0:
            plan.append((shift, width, np.array(ball_masks(width, radius), dtype=np.uint64)))
        shift += width
    if shift != 64:
        raise ValueError("segments must cover 64 bits")

    def rows(batches):
        import pyarrow as pa
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for s in range(0, len(fps), 1 << 16):
                fp = fps[s:s + (1 << 16)]
                buckets, owners, stored = [], [], []
                for i, (shift, width, masks) in enumerate(plan):
                    value = (fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)
                    tag = np.uint64(i << 58)
                    buckets.append(value | tag)
                    owners.append(fp)
                    stored.append(np.ones(len(fp), dtype=bool))
                    for mask in masks:
                        # of two values one is smaller: only its owner looks the other up
                        other = value ^ mask
                        take = other > value
                        buckets.append(other[take] | tag)
                        owners.append(fp[take])
                        stored.append(np.zeros(int(take.sum()), dtype=bool))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(buckets).view(np.int64)),
                    pa.array(np.concatenate(owners).view(np.int64)),
                    pa.array(np.concatenate(stored))], names=["bucket", "fp", "stored"])
    return rows


# ------------------------------------------------------------------ verification

def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def forest(fp: np.ndarray, stored: np.ndarray, max_bits: int):
    """Edges (positions) of a spanning forest of the links among distinct fingerprints of
    one bucket; two looked-up rows need no comparison here (they meet elsewhere)."""
    left = np.arange(len(fp))
    a, b = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = popcount(fp[left] ^ fp[at]) <= max_bits
            if not stored[at]:
                near &= stored[left]
            found = left[near]
            if len(found):
                a.append(np.full(len(found), at))
                b.append(found)
                queue.extend(found.tolist())
                left = left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, int), np.empty(0, int))


def _verify_sorted(max_bits: int, small: int = 12):
    """Rows sorted by (group, fp) -> edges; the last group of a batch waits for the next."""
    def edges_of(group, fp, stored):
        out_a, out_b = [], []
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.append(starts, len(group)))
        big = sizes > small
        in_small = np.repeat(~big & (sizes > 1), sizes)
        at = np.flatnonzero(in_small)
        for d in range(1, small):
            at = at[at + d < len(group)]
            at = at[group[at] == group[at + d]]
            if not len(at):
                break
            ok = (popcount(fp[at] ^ fp[at + d]) <= max_bits) & (stored[at] | stored[at + d])
            out_a.append(fp[at[ok]])
            out_b.append(fp[at[ok] + d])
        for s, n in zip(starts[big].tolist(), sizes[big].tolist()):
            i, j = forest(fp[s:s + n], stored[s:s + n], max_bits)
            out_a.append(fp[s:s + n][i])
            out_b.append(fp[s:s + n][j])
        return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (np.empty(0, np.uint64),) * 2

    def verify(batches):
        import pyarrow as pa
        rest = None
        for batch in batches:
            group = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
            group = np.ascontiguousarray(group).view([("b", "i8"), ("p", "i8")]).ravel()
            part = [group, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64),
                    batch.column(3).to_numpy(zero_copy_only=False)]
            if rest is not None:
                part = [np.concatenate(x) for x in zip(rest, part)]
            if not len(part[0]):
                continue
            cut = _last_group(part[0])
            rest = [x[cut:] for x in part]
            if cut:
                yield _edge_batch(pa, *edges_of(*[x[:cut] for x in part]))
        if rest is not None and len(rest[0]):
            yield _edge_batch(pa, *edges_of(*rest))
    return verify


def _last_group(group: np.ndarray) -> int:
    """Where the last run of equal values begins."""
    differs = np.flatnonzero(group != group[-1])
    return int(differs[-1]) + 1 if len(differs) else 0


def _edge_batch(pa, a, b):
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a).view(np.int64)),
                                       pa.array(np.ascontiguousarray(b).view(np.int64))], names=["a", "b"])


def hamming_edges(fps: DataFrame, max_bits: int = MAX_BITS, segments=SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct fingerprints
    (column fp, no repeats) that differ in at most ``max_bits`` bits."""
    rows = fps.select("fp").mapInArrow(_probe_rows(segments, max_bits), "bucket long, fp long, stored boolean")
    heavy = written(rows.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > block)
                    .select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "simhash-heavy")
    rows = rows.withColumn("part", F.lit(0).cast("long"))
    n_heavy = heavy.count()
    if n_heavy:
        # a bucket over the block size: every pair of its blocks is one part
        marked = rows.join(F.broadcast(heavy) if n_heavy <= BROADCAST_ROWS else heavy, "bucket", "left")
        mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
        rows = (marked.withColumn("mine", mine).withColumn("other", other)
                .withColumn("part", F.when(F.col("blocks").isNull(), F.lit(0).cast("long")).otherwise(
                    F.least("mine", "other").cast("long") * F.lit(1 << 31) + F.greatest("mine", "other") + 1)))
    parts = (rows.select("bucket", "part", "fp", "stored").repartition("bucket", "part")
             .sortWithinPartitions("bucket", "part", "fp"))
    return parts.mapInArrow(_verify_sorted(max_bits), "a long, b long").distinct()


# ------------------------------------------------------------------ operator

def _components_of(base: DataFrame, max_bits: int, segments, block: int) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of ``base`` (id, fp)."""
    firsts = written(base.groupBy("fp").agg(F.min("id").alias("first")), "simhash-fps")
    labels = connected_components(hamming_edges(firsts, max_bits, segments, block))
    joined = (firsts.join(labels, firsts["fp"] == labels["node"], "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    return joined.join(smallest, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       max_bits: int = MAX_BITS, segments=SEGMENTS, block: int = BLOCK) -> DataFrame:
    """(id, fp, component_id) per row of ``docs``: component_id is the smallest id
    reachable over links of at most ``max_bits`` differing fingerprint bits.

    Null and empty texts have fingerprint 0 and link like any other; rows with equal
    fingerprints (exact copies, repeated rows) are linked; null ids are ignored when the
    smallest id is taken (a component of null ids has a null component_id).  An empty
    table gives no rows; extra columns play no part."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    base = written(with_fingerprint(slim, shingle=shingle).select("id", "fp"), "simhash")
    return base.join(_components_of(base, max_bits, segments, block).drop("root"), "fp").select(
        "id", "fp", "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  max_bits: int = MAX_BITS, segments=SEGMENTS, block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null ids
    last; among rows with one id the smallest fingerprint, then the smallest hash of the
    row).  Columns stay as they are; nulls and empty texts as in simhash_components."""
    full = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), packed(docs))
    full = written(with_fingerprint(full, shingle=shingle).drop("text"), "simhash-rows")
    base = full.select("id", "fp")
    order = F.struct(F.col("id").isNull().alias("nulls"), F.col("id"), F.col("fp"))
    best = base.groupBy("fp").agg(F.min(order).alias("w"))
    winners = (best.join(_components_of(base, max_bits, segments, block), "fp")
               .groupBy("root").agg(F.min("w").alias("w")).select(F.col("w.id").alias("wid"), F.col("w.fp").alias("wfp")))
    kept = full.join(winners, (full["fp"] == winners["wfp"]) & full["id"].eqNullSafe(winners["wid"]), "left_semi")
    one = kept.groupBy("fp", "id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return unpacked(one, docs.schema)
