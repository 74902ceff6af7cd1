"""Line dedup by a log-template tree (DataFrame functions only).

A line is parsed at fixed depth: its leaf is its number of tokens and its first ``DEPTH``
tokens, tokens with a digit counting as the variable field ``<*>``.  The distinct lines of a
leaf are then compared position by position.  They are one template if they agree in enough
positions (``CONSTANTS`` tokens and ``CONSTANT_SHARE`` of all) and every other position is
truly variable: ``VALUES`` values or more, in lines first seen in ``VALUES`` documents or
more.  A leaf that is no template is split, up to ``LEVELS`` levels deep, by its tokens at
the positions with fewer values than that (at its position with the fewest values, if there
is none), and its parts are tried again.  A line in no template stands for itself: it recurs
only as the same line, up to its digits.

A template or line that occurs in ``MIN_DOCS`` documents or more is recurring: it is dropped
from all documents but the first (the one with the smallest id).  Lines with fewer than
``DEPTH`` tokens have no leaf and are kept.

Only hashes and positions of lines are shuffled; token by token work is done for the leaves
with at least ``VALUES`` distinct lines alone.  A line or leaf that a third of all rows share
is pre-aggregated before its shuffle, and joins to it can be split (equi-joins whose other
side has one row a key).  Leaves are told apart by a hash, but a template is found on the
tokens themselves, so two leaves under one hash are split apart before anything is dropped.
The texts move once, to be rebuilt without the dropped lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, written

DEPTH = 3
LEVELS = 3                        # of nodes below the leading tokens, the leaf included
VALUES = 3                        # of a variable field, and documents that show them
CONSTANTS, CONSTANT_SHARE = 5, 0.6
MIN_DOCS = 2

BROADCAST_LEAVES = 1_000_000      # rows of 16 bytes; more leaves are joined by a shuffle

FIELD = "<*>"
SPACES = " \t\r\x0b\x0c"          # white space inside a line


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_table(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(id, th, pos, line, n) of the lines with at least ``depth`` tokens; ``docs`` has
    (id, th, text): th tells texts with one id apart.  ``line`` has single spaces between
    its tokens and the variable field for tokens with a digit.

    The steps are transforms of the array of lines, so that each runs once per line, and
    the outer explode keeps the optimiser from evaluating the array once more in a filter."""
    def spaced(x):
        odd = x.contains("  ")
        for c in SPACES[1:]:
            odd = odd | x.contains(c)
        return F.trim(F.when(odd, F.regexp_replace(x, f"[{SPACES}]+", " ")).otherwise(x))

    def masked(x):
        # a token is tried from its start only: linear in the length of the line
        return F.when(x.rlike("[0-9]"), F.regexp_replace(x, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)).otherwise(x)

    def counted(x):
        n = F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1
        return F.struct(x.alias("line"), F.when(x == "", 0).otherwise(n).alias("n"))

    items = F.transform(F.transform(F.transform(_lines(F.col("text")), spaced), masked), counted)
    return (docs.select("id", "th", F.posexplode_outer(items).alias("pos", "item"))
            .select("id", "th", "pos", "item.line", "item.n").filter(F.col("n") >= depth))


def _keys(lines: DataFrame, depth: int) -> DataFrame:
    lead = F.substring_index("line", " ", depth)
    # a line is known by 128 bits: the hash of its leaf and its own
    return lines.select("id", "th", "pos", F.xxhash64("n", lead).alias("leaf"), F.xxhash64("line").alias("l"))


def _node_stats(lines: DataFrame, values: int, constants: int, share: float) -> DataFrame:
    """(node, general, cut) of the nodes of lines (node, id, words): whether its lines are one
    template, else the positions to split it by (null: not worth it)."""
    tokens = lines.select("node", F.posexplode("words").alias("p", "token"))
    at = (tokens.groupBy("node", "p", "token").agg(F.count("*").alias("c"))
          .groupBy("node", "p").agg(F.count("*").alias("d"), F.sum("c").alias("m")))
    # a position that some lines lack (two leaves under one hash) has one value more
    whole = lines.groupBy("node").agg(F.count("*").alias("lines"), F.count_distinct("id").alias("docs"))
    at = at.join(whole, "node").withColumn("d", F.col("d") + (F.col("m") < F.col("lines")).cast("int"))
    node = at.groupBy("node").agg(
        F.max("docs").alias("docs"), F.count("*").alias("n"), F.count_if(F.col("d") == 1).alias("fixed"),
        F.min(F.when(F.col("d") > 1, F.struct("d", "p"))).alias("least"),
        F.sort_array(F.collect_list(F.when((F.col("d") > 1) & (F.col("d") < values), F.col("p")))).alias("few"))
    enough = (F.col("fixed") >= constants) & (F.col("fixed") >= F.lit(share) * F.col("n"))
    general = (F.col("least.d") >= values) & enough
    cut = F.when(F.size("few") > 0, F.col("few")).otherwise(F.array(F.col("least.p")))
    return (node.filter(F.col("docs") >= values)         # parts of a node have no more documents than it
            .select("node", general.alias("general"), F.when(~general, cut).alias("cut")))


def template_lines(lines: DataFrame, keyed: DataFrame, depth: int = DEPTH, levels: int = LEVELS, values: int = VALUES,
                   constants: int = CONSTANTS, share: float = CONSTANT_SHARE) -> DataFrame:
    """(leaf, l, node) of the distinct lines that belong to a template."""
    distinct = keyed.groupBy("leaf", "l").agg(F.lit(1).alias("one")).drop("one")
    several = written(distinct.groupBy("leaf").agg(F.count("*").alias("lines")).filter(F.col("lines") >= values)
                      .select("leaf"), "leaves")
    if several.count() <= BROADCAST_LEAVES:
        several = F.broadcast(several)
    lead = F.substring_index("line", " ", depth)
    texts = (lines.withColumn("leaf", F.xxhash64("n", lead)).join(several, "leaf")
             .groupBy("leaf", F.xxhash64("line").alias("l")).agg(F.first("line").alias("line"), F.min("id").alias("id")))
    open_ = written(texts.select("leaf", F.col("leaf").alias("node"), "l", "id", F.split("line", " ").alias("words")), "leaf-lines")
    found = []
    for level in range(levels):
        stats = written(_node_stats(open_, values, constants, share), "nodes")
        found.append(open_.join(stats.filter("general"), "node").select("leaf", "l", "node"))
        if level + 1 < levels:
            parts = open_.join(stats.filter("not general").select("node", "cut"), "node")
            child = F.xxhash64("node", F.transform("cut", lambda p: F.get("words", p)))
            parts = parts.select("leaf", child.alias("node"), "l", "id", "words")
            big = parts.groupBy("node").agg(F.count("*").alias("lines")).filter(F.col("lines") >= values).select("node")
            open_ = written(parts.join(big, "node", "left_semi").select("leaf", "node", "l", "id", "words"), "leaf-lines")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def dropped_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, **template) -> DataFrame:
    """(id, th, dropped): positions of the lines to drop, for documents that lose any.
    ``docs`` has (id, th, text)."""
    lines = line_table(docs, depth)
    keyed = written(_keys(lines, depth), "line-keys")
    members = template_lines(lines, keyed, depth, **template)
    # known by its leaf and its node (a template's line) or its own hash
    templated = (keyed.join(members, ["leaf", "l"], "left")
                 .select("id", "th", "pos", F.col("leaf").alias("t1"), F.coalesce("node", "l").alias("t2"),
                         F.col("node").isNotNull().alias("t3")))
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("th"))
    if min_docs <= 2:
        # two documents or more: the first and the last differ (no row per document needed)
        ends = templated.groupBy("t1", "t2", "t3").agg(F.min(first).alias("first"), F.max(first).alias("last"))
        found = ends.filter(F.lit(min_docs < 2) | (~F.col("first").eqNullSafe(F.col("last"))))
    else:
        found = (templated.groupBy("t1", "t2", "t3", "id", "th").agg(F.lit(1).alias("one"))
                 .groupBy("t1", "t2", "t3").agg(F.count("*").alias("docs"), F.min(first).alias("first"))
                 .filter(F.col("docs") >= min_docs))
    again = templated.join(found.select("t1", "t2", "t3", "first"), ["t1", "t2", "t3"])
    again = again.filter(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th"))))
    return again.groupBy("id", "th").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                min_docs: int = MIN_DOCS, **template) -> DataFrame:
    """(row, text, n_lines, n_dropped) per row of ``docs``: all columns in ``row``, the
    text without its dropped lines.  ``template``: levels, values, constants, share.

    Null texts stay null (no lines), an empty text has one empty line.  Rows with the same
    id and text are one document; a null id comes after all others when the first document
    of a template is chosen.  An empty table gives no rows; extra columns ride along."""
    base = docs.select(packed(docs), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    base = base.withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))
    slim = base.filter("text is not null").select("id", "th", "text")
    lost = dropped_lines(slim, depth, min_docs, **template).select(
        F.col("id").alias("lost_id"), F.col("th").alias("lost_th"), "dropped")
    joined = base.join(lost, base["id"].eqNullSafe(lost["lost_id"]) & (base["th"] == lost["lost_th"]), "left")
    lines = _lines(F.col("text"))
    numbered = F.zip_with(lines, F.sequence(F.lit(0), F.size(lines) - 1),
                          lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    gone = F.map_from_entries(F.transform("dropped", lambda p: F.struct(p, F.lit(True))))
    kept = F.transform(F.filter(numbered, lambda z: gone[z["i"]].isNull()), lambda z: z["x"])
    return joined.select(
        "row", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).alias("n_dropped"))


# ------------------------------------------------------------------ the same in SQL

def line_dedup_sql(depth: int = DEPTH, min_docs: int = MIN_DOCS, levels: int = LEVELS, values: int = VALUES,
                   constants: int = CONSTANTS, share: float = CONSTANT_SHARE, table: str = "documents") -> str:
    spaces = "[ \\t\\r\\x0b\\x0c]+"
    steps = []
    for k in range(levels):
        steps.append(f"""tk{k} AS (SELECT node, unnest(w) AS token, unnest(range(len(w))) AS p FROM o{k}),
at{k} AS (SELECT node, p, count(DISTINCT token) AS d FROM tk{k} GROUP BY node, p),
st{k} AS MATERIALIZED (SELECT node, any_value(docs) AS docs, count(*) FILTER (d = 1) AS fixed, count(*) AS n, min(d) FILTER (d > 1) AS least,
  arg_min(p, d * 1000000 + p) FILTER (d > 1) AS choice, list(p ORDER BY p) FILTER (d > 1 AND d < {values}) AS few
  FROM at{k} JOIN (SELECT node, count(DISTINCT id) AS docs FROM o{k} GROUP BY node) USING (node) GROUP BY node),
gen{k} AS (SELECT node, least >= {values} AND fixed >= {constants} AND fixed >= CAST({share} AS DOUBLE) * n AS general,
  coalesce(few, [choice]) AS cut FROM st{k} WHERE docs >= {values}),
mem{k} AS (SELECT w, node FROM o{k} JOIN gen{k} USING (node) WHERE general)""")
        if k + 1 < levels:
            steps.append(f"""o{k + 1} AS MATERIALIZED (SELECT w, id, node FROM (SELECT w, id,
    node || chr(10) || array_to_string(list_transform(cut, lambda p: w[p + 1]), ' ') AS node
  FROM o{k} JOIN gen{k} USING (node) WHERE NOT general) QUALIFY count(*) OVER (PARTITION BY node) >= {values})""")
    members = " UNION ALL ".join(f"SELECT w, node FROM mem{k}" for k in range(levels))
    return f"""
WITH docs AS (SELECT doc_id AS id, text, string_split(text, chr(10)) AS ls FROM {table}),
uniq AS (SELECT DISTINCT id, text, ls FROM docs WHERE text IS NOT NULL),
raw AS (SELECT id, text, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM uniq),
toks AS (SELECT id, text, pos, list_transform(list_filter(regexp_split_to_array(line, '{spaces}'), lambda t: t <> ''),
                lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END) AS w FROM raw),
lines AS MATERIALIZED (SELECT id, text, pos, w FROM toks WHERE len(w) >= {depth}),
o0 AS MATERIALIZED (SELECT w, min(id) AS id, len(w) || ' ' || array_to_string(list_slice(w, 1, {depth}), ' ') AS node FROM lines
  GROUP BY w QUALIFY count(*) OVER (PARTITION BY node) >= {values}),
{", ".join(steps)},
member AS ({members}),
templ AS (SELECT l.id, l.text, l.pos, m.node, CASE WHEN m.w IS NULL THEN l.w END AS own FROM lines l LEFT JOIN member m ON l.w = m.w),
occ AS (SELECT DISTINCT node, own, id, text FROM templ),
ranked AS (SELECT *, count(*) OVER (PARTITION BY node, own) AS d,
                  row_number() OVER (PARTITION BY node, own ORDER BY id NULLS LAST, text) AS r FROM occ),
gone AS (SELECT t.id, t.text, list(t.pos) AS ps FROM templ t JOIN ranked k
           ON t.node IS NOT DISTINCT FROM k.node AND t.own IS NOT DISTINCT FROM k.own
          AND t.id IS NOT DISTINCT FROM k.id AND t.text = k.text
         WHERE k.d >= {min_docs} AND k.r > 1 GROUP BY t.id, t.text)
SELECT d.id AS doc_id,
       CASE WHEN g.ps IS NULL THEN d.text ELSE coalesce(array_to_string(list_transform(
            list_filter(range(len(ls)), lambda i: NOT list_contains(g.ps, i)), lambda i: ls[i + 1]), chr(10)), '') END AS text,
       CAST(coalesce(len(ls), 0) AS INTEGER) AS n_lines, CAST(coalesce(len(g.ps), 0) AS INTEGER) AS n_dropped
FROM docs d LEFT JOIN gone g ON d.id IS NOT DISTINCT FROM g.id AND d.text = g.text"""
