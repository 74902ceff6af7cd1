"""Merkle manifest of a table: a digest per row, a tree per group, a tree over the groups,
and for every row the siblings that fold its leaf to the root.

A tree joins every ``ARITY`` consecutive nodes of a level until one is left.  A row's rank in
its group therefore spells its way up in digits.  Ranks come from one range partitioning and
one count per partition and group, so that a group of any size is ranked by all tasks.  The
leaves are then dealt out by blocks of ``ARITY ** DEPTH`` consecutive ranks and rolled up in
place: the digit columns are grouped away one after the other, the last first, each step
nesting its nodes as the children of the next; one shuffle serves all of a block's steps.
The blocks' digests are the nodes of the next tier of blocks, and the groups' roots those of
a last tree.  On the way down a nested transform and one explode turn a block's children into
their proofs.  No join is on rows of the table there; a tier only takes the proofs of its
blocks from the tier above (one row per block, ``ARITY ** DEPTH`` times fewer than rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ARITY = 3
DEPTH = 7                          # levels in a block: at most 2187 nodes
BROADCAST_RUNS = 200_000           # rows (one per range partition and group); more are joined by a shuffle

_POWERS = [ARITY ** i for i in range(40) if ARITY ** i < 2 ** 63]


def hashed(*parts: Column) -> Column:
    """H: lowercase hex sha256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(columns: list[str]) -> Column:
    """H of the columns' values: ``-`` for null, else byte count, ``:``, value as text."""
    def part(c):
        text = F.col(c).cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return hashed(*[part(c) for c in columns])


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree with ``n`` of them."""
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in _POWERS]), lambda p: p < n))


# ------------------------------------------------------------------ ranks

def ranked(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, groups) of leaves (group, order, leaf, row): nodes (tree, rank, levels,
    digest, below) with the rank from 0 in the group by order, then digest (nulls first), and
    groups (tree, total), trees numbered by group (nulls first).

    Leaves alike in all three are interchangeable; their position in the written table parts
    them, so that copies of one row are dealt over many ranges."""
    base = written(leaves.select("group", "order", "leaf", "row").withColumn("salt", F.monotonically_increasing_id()),
                   "leaves")
    by = ["group", "order", "leaf", "salt"]
    placed = written(base.repartitionByRange(*by).sortWithinPartitions(*by)
                     .select("group", "leaf", "row", F.monotonically_increasing_id().alias("at")), "placed")
    part = F.shiftright("at", 33)        # the range, in order; the low bits count its rows
    runs = placed.groupBy(part.alias("part"), "group").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    own = Window.partitionBy("group")
    earlier = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.select("part", "group", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                               F.sum("n").over(own).alias("total")), "runs")
    # a group begins in the range where nothing of it comes before; ranges follow one another
    begins = runs.filter("before = 0").select("group", "total", "part", "first")
    ahead = (begins.groupBy("part").agg(F.count("*").alias("k"))
             .select("part", F.coalesce(F.sum("k").over(
                 Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead")))
    groups = (begins.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy("first")))
              .join(ahead, "part").select("group", "total", (F.col("ahead") + F.col("nth") - 1).cast("long").alias("tree")))
    groups = written(groups, "groups")
    named = runs.drop("total").join(groups, runs["group"].eqNullSafe(groups["group"])).select(
        F.col("part").alias("run_part"), runs["group"].alias("run_group"), "first", "before", "total", "tree")
    if runs.count() <= BROADCAST_RUNS:
        named = F.broadcast(named)
    nodes = placed.join(named, (part == F.col("run_part")) & F.col("group").eqNullSafe(F.col("run_group")))
    return nodes.select("tree", (F.col("before") + F.col("at") - F.col("first")).alias("rank"),
                        _height(F.col("total")).alias("levels"), F.col("leaf").alias("digest"),
                        F.col("row").alias("below")), groups.select("tree", "total")


# ------------------------------------------------------------------ up

def rolled_up(nodes: DataFrame, done: int, depth: int = DEPTH) -> DataFrame:
    """(tree, block, levels, digest, kids): blocks of ``ARITY ** depth`` nodes (tree, rank,
    levels, digest, below), their children nested ``depth`` deep.  ``done``: levels below the
    nodes.  Levels above a tree's root hand the only node on."""
    digit = [F.floor(F.col("rank") / F.lit(ARITY ** i)) % ARITY for i in range(depth)]
    df = nodes.select("tree", F.floor(F.col("rank") / F.lit(ARITY ** depth)).alias("block"), "levels",
                      *[digit[i].cast("int").alias(f"d{i}") for i in range(1, depth)],
                      F.struct(digit[0].cast("int").alias("d"), "digest", "below").alias("node"))
    df = df.repartition("tree", "block")
    for i in range(depth):
        rest = [f"d{j}" for j in range(i + 1, depth)]
        df = df.groupBy("tree", "block", "levels", *rest).agg(F.sort_array(F.collect_list("node")).alias("kids"))
        digest = F.when(F.lit(done + i + 1) <= F.col("levels"), F.sha2(F.concat_ws("", "kids.digest"), 256)
                        ).otherwise(F.col("kids")[0]["digest"])
        df = df.withColumn("digest", digest)
        if rest:
            df = df.select("tree", "block", "levels", *rest[1:],
                           F.struct(F.col(rest[0]).alias("d"), "digest", F.col("kids").alias("below")).alias("node"))
    return df


def tiers(nodes: DataFrame, height: int, depth: int = DEPTH) -> list[DataFrame]:
    """Written blocks of every tier, the leaves' first; the last has one block a tree."""
    out = [written(rolled_up(nodes, 0, depth), "tier")]
    while len(out) * depth < height:
        above = out[-1].select("tree", F.col("block").alias("rank"), "levels", "digest", F.lit(None).cast("int").alias("below"))
        out.append(written(rolled_up(above, len(out) * depth, depth), "tier"))
    return out


# ------------------------------------------------------------------ down

def _proofs(kids: Column, depth: int, done: int, rank: Column, path: Column) -> Column:
    """Array of (rank, digest, below, path) of the nodes under ``kids``, which are ``depth``
    levels above the nodes; ``path`` and ``rank`` are those of their parent."""
    def one(k, j):
        def side(first, n):
            return F.concat_ws("", F.transform(F.slice(kids, first, n), lambda x: x["digest"]))
        step = F.struct(side(F.lit(1), j).alias("left"), side(j + 2, F.lit(ARITY)).alias("right"))
        here = F.when(F.lit(done + depth) <= F.col("levels"), F.array(step)).otherwise(F.array().cast(PATH))
        mine, place = F.concat(here, path), rank * ARITY + k["d"]
        if depth == 1:
            return F.struct(place.alias("rank"), k["digest"].alias("digest"), k["below"].alias("below"), mine.alias("path"))
        return _proofs(k["below"], depth - 1, done, place, mine)
    found = F.transform(kids, one)
    return found if depth == 1 else F.flatten(found)


PATH = "array<struct<left:string,right:string>>"


def handed_down(blocks: DataFrame, above: DataFrame, done: int, depth: int = DEPTH) -> DataFrame:
    """The nodes of a tier: ``above`` has (tree, block, path, *carried) for its blocks."""
    carried = [c for c in above.columns if c not in ("tree", "block", "path")]
    joined = blocks.join(above, ["tree", "block"])
    nodes = joined.select("tree", *carried, F.explode(
        _proofs(F.col("kids"), depth, done, F.col("block").cast("long"), F.col("path"))).alias("node"))
    return nodes.select("tree", *carried, "node.rank", "node.digest", "node.below", "node.path")


def _down(found: list[DataFrame], above: DataFrame, depth: int) -> DataFrame:
    """The lowest tier's nodes with their paths, given those of the highest tier's blocks."""
    for i in range(len(found) - 1, -1, -1):
        nodes = handed_down(found[i], above, i * depth, depth)
        above = nodes.drop("digest", "below").withColumnRenamed("rank", "block")
    return nodes


def merkle_proofs(docs: DataFrame, leaf: Column, group_col: str = "source", order_col: str = "doc_id",
                  row: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """(group's) subroot, root, leaf and path of every row of ``docs``, with ``row`` (a struct
    of what the caller wants back, by default the order column; no maps).  ``path`` holds one
    (left, right) per level, from the leaf up: the digests before and after the node in its
    run, one after the other.

    Nulls: a null group is the first of the groups, a null order the first of its group.
    Ties in the order fall to the digest; rows alike in all are leaves of their own.  Texts
    are only hashed and never shuffled, however long.  An empty table gives no rows.  Extra
    columns, whatever their names, are not looked at."""
    row = F.struct(F.col(order_col)) if row is None else row
    leaves = docs.select(F.col(group_col).alias("group"), F.col(order_col).alias("order"), leaf.alias("leaf"), row.alias("row"))
    nodes, groups = ranked(leaves)
    size = groups.agg(F.max(_height(F.col("total"))).alias("height"), F.count("*").alias("trees")).first()
    low = tiers(nodes, size["height"] or 0, depth)
    subroots = low[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"),
                              _height(F.lit(size["trees"]).cast("long")).alias("levels"), "digest", F.lit(None).cast("int").alias("below"))
    height = sum(p < size["trees"] for p in _POWERS)
    high = tiers(subroots, height, depth)
    top = high[-1].select("tree", "block", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    trees = _down(high, top, depth)
    above = trees.select(F.col("rank").alias("tree"), F.lit(0).cast("long").alias("block"), "path", "root",
                         F.col("digest").alias("subroot"))
    found = _down(low, above, depth)
    return found.select(F.col("below").alias("row"), F.col("digest").alias("leaf"), "subroot", "root", "path")


def path_digest(path: Column) -> Column:
    """H of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda p: F.concat(p["left"], p["right"]))), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to by a proof."""
    return F.aggregate(path, leaf, lambda d, p: hashed(p["left"], d, p["right"]))


# ------------------------------------------------------------------ the manifest of documents

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def tampered() -> Column:
    """Documents whose id's unsigned crc32 (of its decimal text) is even."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0


def document_manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root (of the tampered
    text's leaf where ``tampered`` holds and the text has a line feed), verified."""
    plain = leaf_digest(FIELDS)
    changed = docs.select(*FIELDS).withColumn("cut", F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    other = F.when(tampered() & F.col("text").contains("\n"), leaf_digest([*FIELDS[:-1], "cut"]))
    found = merkle_proofs(changed, plain, row=F.struct("doc_id", other.alias("other")), depth=depth)
    out = found.select("row.doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
                       folded(F.coalesce("row.other", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


# ------------------------------------------------------------------ the same in SQL

def manifest_sql(table: str = "documents") -> str:
    def part(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    def leaf(text):
        return "sha256(" + " || ".join(part(c) for c in [*FIELDS[:-1], text]) + ")"
    bits = ("flatten(list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), "
            "lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))")
    crc = (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda a, b: "
           "xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)), CAST(4294967295 AS BIGINT))")

    def tree(name, base):
        """name(g, lvl, r, d, n): nodes of every level; name_s: their siblings."""
        return f"""{name} AS (
  {base}
  UNION ALL SELECT g, lvl + 1, r // {ARITY}, sha256(string_agg(d, '' ORDER BY r)), (n + {ARITY - 1}) // {ARITY}
  FROM {name} WHERE n > 1 GROUP BY g, lvl, r // {ARITY}, n),
{name}_s AS (SELECT a.g, a.lvl, a.r, coalesce(string_agg(b.d, '' ORDER BY b.r) FILTER (b.r < a.r), '') AS lo,
                    coalesce(string_agg(b.d, '' ORDER BY b.r) FILTER (b.r > a.r), '') AS hi
             FROM {name} a JOIN {name} b ON a.g = b.g AND a.lvl = b.lvl AND a.r // {ARITY} = b.r // {ARITY}
             WHERE a.n > 1 GROUP BY a.g, a.lvl, a.r)"""

    def fold(name, base, siblings):
        """name(k, g, lvl, r, d, p): k's digest and proof so far at every level."""
        return f"""{name} AS (
  {base}
  UNION ALL SELECT f.k, f.g, f.lvl + 1, f.r // {ARITY}, sha256(lo || f.d || hi), f.p || lo || hi
  FROM {name} f JOIN {siblings} s ON f.g = s.g AND f.lvl = s.lvl AND f.r = s.r)"""

    return f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
         count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS k
  FROM (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf('cut')} AS cut_leaf, doc_id IS NOT NULL AND {crc} % 2 = 0 AS bad
        FROM (SELECT *, replace(text, chr(10), '') AS cut FROM {table}))),
{tree('low', "SELECT g, 0 AS lvl, r, leaf AS d, n FROM leaves")},
subs AS (SELECT g, d, count(*) OVER () AS n FROM low WHERE n = 1),
{tree('high', "SELECT CAST(0 AS BIGINT) AS g, 0 AS lvl, g AS r, d, n FROM subs")},
{fold('lf', "SELECT k, g, 0 AS lvl, r, CASE WHEN bad THEN cut_leaf ELSE leaf END AS d, '' AS p FROM leaves", 'low_s')},
lf_end AS (SELECT k, g, arg_max(d, lvl) AS d, arg_max(p, lvl) AS p FROM lf GROUP BY k, g),
{fold('hf', "SELECT k, CAST(0 AS BIGINT) AS g, 0 AS lvl, g AS r, d, p FROM lf_end", 'high_s')},
ends AS (SELECT k, arg_max(d, lvl) AS d, arg_max(p, lvl) AS p FROM hf GROUP BY k),
top AS (SELECT d AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, s.d AS subroot, root, sha256(e.p) AS proof_sha256, e.d AS folded_root, e.d = root AS verified
FROM leaves l JOIN subs s USING (g) JOIN ends e USING (k) CROSS JOIN top"""
