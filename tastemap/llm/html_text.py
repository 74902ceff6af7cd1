"""Main text of web pages by consensus paths of their hosts.

A page is read as a tree of containers.  Every container is named by its generalised path:
the tags and classes from the root, digits replaced, known by a 64-bit hash of the parent's
path and its own name, so that a page takes time and memory in proportion to its length
however deep it nests.  First pass: each page scores its
containers by the text they hold directly (link text counts against them, part of the
score passes to the parents) and votes for the path of the best, and names the other paths
that hold text on it.  Spark adds both up per host: a path wins if it is the best on at
least half of the host's pages that have it, so that every layout of a host has its own.
Second pass: each page is read again and gives the text under the winning path with the
most votes, or under another one that scores much higher on the page.  A page whose own
best path neither wins nor loses on its host stands for itself.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_value, written
from .urls import split_url

BROADCAST_HOSTS = 100_000      # at most so many paths of hosts are broadcast (under 30 MB)
MIN_RATE = 0.5                 # of a host's pages with a path: on so many the winning path is the best
MUCH = 2.0                     # a path with fewer votes is taken if it scores so many times higher
MOST = 0.5                     # of a page's text: a container with more is not dropped by its name
MOST_COMMENTS = 0.9            # the same for containers of reader comments
SALT = 32
CLIMB = 0.1

# Fixed values of the HTML standard and of common page markup.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s
samp small span strike strong sub sup time tt u var wbr br img""".split())
TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr caption figcaption hr".split())
RAW_TEXT = set("script style title textarea noscript template iframe noframes xmp noembed".split())
DROPPED = set("""nav header footer aside form button select option fieldset menu dialog svg canvas object
audio video map input head math""".split()) | RAW_TEXT
DROPPED_NAMES = re.compile(
    r"^(?:(?:site|page|main|top|bottom|left|right|global|primary|secondary)[-_])?(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|"
    r"overlay|newsletter|subscribe|sidebar|side|aside|widget\w*|menu\w*|nav\w*|breadcrumbs?|pagination|pager|"
    r"header|masthead|footer|copyright|comments?|commentlist|replies|reply|respond|disqus|share|sharing|"
    r"social|related|recommend\w*|login|signup|search|toolbar|skip|hidden)(?:$|[-_ ])", re.I)
COMMENT_NAMES = re.compile(r"^(?:comments?|commentlist|replies|reply|respond|disqus)(?:$|[-_ ])", re.I)
DROPPED_ROLES = set("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
TAG_WEIGHT = {"article": 1.5, "main": 1.3, "body": 0.5, "html": 0.2, "ul": 0.5, "ol": 0.6, "table": 0.8}

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_DIGITS = re.compile(r"\d+")


class Container:
    __slots__ = ("tag", "path", "parent", "dropped", "named", "blocks", "linked", "had")

    def __init__(self, tag: str, path: int, parent, dropped: bool, named: float = 0.0):
        """``dropped``: for good; ``named``: dropped by its name, unless it holds more than
        this share of the page's text (0: not by its name)."""
        self.tag, self.path, self.parent, self.dropped, self.named = tag, path, parent, dropped, named
        self.blocks: list[tuple[int, str]] = []
        self.linked = 0


def _attributes(raw: str) -> dict[str, str]:
    if not raw or "=" not in raw and "hidden" not in raw:
        return {}
    return {k.lower(): unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(raw)}


def _name(tag: str, attributes: dict) -> str:
    classes = sorted({_DIGITS.sub("0", c) for c in attributes.get("class", "").split()})
    return ".".join([tag, *classes])


def path_of(parent: int, name: str) -> int:
    """The path below ``parent`` (0: the root) of a container called ``name``: 64 bits, signed."""
    h = xxhash.xxh64_intdigest(name, parent & (2 ** 64 - 1))
    return h - (1 << 64) if h >> 63 else h


def _is_dropped(tag: str, attributes: dict) -> bool:
    if tag in DROPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if attributes.get("role", "").lower() in DROPPED_ROLES:
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    return False


def _dropped_name(tag: str, attributes: dict) -> float:
    """The share of a page's text up to which a container of this name is dropped, or 0."""
    if tag in ("html", "body", "article", "main"):
        return 0.0
    names = [n for n in attributes.get("class", "").split() + [attributes.get("id", "")] if n]
    if any(COMMENT_NAMES.search(n) for n in names):
        return MOST_COMMENTS
    return MOST if any(DROPPED_NAMES.search(n) for n in names) else 0.0


def _drop_by_name(containers: list[Container]) -> None:
    """Takes the text from containers with a dropped name and from those below them, but
    not where the name stands for most of the page's text outside of links."""
    for c in containers:
        c.had = bool(c.blocks)
    if not any(c.named for c in containers):
        return
    size = {id(c): max(0, sum(len(t) for _, t in c.blocks) - c.linked) for c in containers}
    total = sum(size.values())
    for c in reversed(containers):                                # children come after their parents
        if c.parent is not None:
            size[id(c.parent)] += size[id(c)]
    gone = set()
    for c in containers:
        if (c.parent is not None and id(c.parent) in gone) or (c.named and size[id(c)] <= c.named * total):
            gone.add(id(c))
            c.dropped, c.blocks, c.linked = True, [], 0


def read_containers(html: str) -> list[Container]:
    """The containers of a page in order, each with its own text blocks (page order number,
    text); text under menus, headers, footers, forms, scripts and the like is left out."""
    root = Container("", 0, None, False)
    found, stack = [root], [root]
    open_tags: dict[str, int] = defaultdict(int)
    parts: list[str] = []
    block_no = 0
    linked = 0

    def flush():
        nonlocal block_no, linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            top = stack[-1]
            if text and not top.dropped:
                top.blocks.append((block_no, text))
                top.linked += min(linked, len(text))
                block_no += 1
        linked = 0

    at, links, silent = 0, 0, 0      # links: open <a>; silent: open dropped inline or text blocks
    quiet: list[str] = []
    for m in iter(lambda: _MARKUP.search(html, at), None):
        if m.start() > at and not quiet:
            text = html[at:m.start()]
            parts.append(text)
            if links:
                linked += len(text)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        rest = m[3] if m[2] else m[6]
        if closing:
            if quiet:
                if tag == quiet[-1]:
                    quiet.pop()
                    continue
                if tag in INLINE or tag in TEXT_BLOCKS or not open_tags[tag]:
                    continue
                quiet.clear()
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                continue
            flush()
            if tag in TEXT_BLOCKS:
                continue
            if open_tags[tag]:
                while (last := stack.pop().tag) != tag:
                    open_tags[last] -= 1
                open_tags[tag] -= 1
            continue
        if tag in RAW_TEXT:
            end = re.compile(rf"</{tag}(?=[\s/>]|$)", re.I).search(html, at)
            if tag not in ("noscript", "template", "textarea", "title"):
                flush()
            at = end.start() if end else len(html)
            if end:
                close = html.find(">", at)
                at = close + 1 if close >= 0 else len(html)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        attributes = _attributes(rest)
        if quiet:
            if tag == quiet[-1]:
                quiet.append(tag)
            elif not (tag in INLINE or tag in TEXT_BLOCKS) and quiet[-1] in TEXT_BLOCKS:
                quiet.clear()
            else:
                continue
        if tag in INLINE:
            if attributes and (_is_dropped(tag, attributes) or _dropped_name(tag, attributes)):
                quiet.append(tag)
            elif tag == "a":
                links += 1
            continue
        flush()
        if tag in TEXT_BLOCKS:
            if tag != "hr" and attributes and (_is_dropped(tag, attributes) or _dropped_name(tag, attributes)):
                quiet.append(tag)
            continue
        top = stack[-1]
        node = Container(tag, path_of(top.path, _name(tag, attributes)), top,
                         top.dropped or _is_dropped(tag, attributes), _dropped_name(tag, attributes))
        if not rest.endswith("/") or tag not in ("svg", "math"):
            stack.append(node)
            open_tags[tag] += 1
        found.append(node)
    if at < len(html) and not quiet:
        parts.append(html[at:])
    flush()
    _drop_by_name(found)
    return found


def container_scores(containers: list[Container]) -> dict[int, float]:
    """Score of each path: text held directly, less link text; half of it passes on to the
    parent, a quarter to its parent and so on."""
    own = {id(c): float(max(0, sum(len(t) for _, t in c.blocks) - 2 * c.linked)) for c in containers}
    scores: dict[int, float] = defaultdict(float)
    for c in reversed(containers):                                # children come after their parents
        size = own[id(c)]
        if size > 0:
            scores[c.path] += size * TAG_WEIGHT.get(c.tag, 1.0)
            if c.parent is not None:
                own[id(c.parent)] += size / 2
    return scores


def _up(containers: list[Container], values: dict[int, float], join) -> dict[int, float]:
    """By path, ``join`` of the values at the path and at all paths below it."""
    parents = {c.path: None if c.parent is None else c.parent.path for c in containers}
    out = {p: values.get(p, 0) for p in parents}
    for p, up in reversed(parents.items()):                       # a path's first container comes after its parent's
        if up is not None:
            out[up] = join(out[up], out[p])
    return out


def best_path(containers: list[Container]) -> int | None:
    """The path with the highest score (ties: the first of the page); its parent instead, as
    long as the parent (below body) holds text blocks of its own, ``CLIMB`` of the path's
    text or more: sections of an article that also has paragraphs outside them."""
    scores = container_scores(containers)
    if not scores:
        return None
    place = {c.path: n for n, c in reversed(list(enumerate(containers)))}
    best = min(scores, key=lambda p: (-scores[p], place[p]))
    direct: dict[int, int] = defaultdict(int)
    for c in containers:
        direct[c.path] += max(0, sum(len(t) for _, t in c.blocks) - 2 * c.linked)
    below = _up(containers, direct, lambda a, b: a + b)
    parents = {c.path: c.parent for c in containers}
    while (up := parents[best]) is not None and up.tag not in ("", "html", "body"):
        if not direct[up.path] or direct[up.path] < CLIMB * below[best]:
            break
        best = up.path
    return best


def text_under(containers: list[Container], path: int) -> str:
    """Blocks of the containers at or below ``path``, in page order."""
    inside: set[int] = set()
    blocks: list[tuple[int, str]] = []
    for c in containers:
        if c.path == path or (c.parent is not None and id(c.parent) in inside):
            inside.add(id(c))
            blocks += c.blocks
    return "\n".join(t for _, t in sorted(blocks))


def held_paths(containers: list[Container]) -> set[int]:
    """The paths that hold text of their own or below them, dropped by name or not: a box
    that is most of a few short pages does not win on its host."""
    held = set()
    for c in containers:
        if c.had:
            while c is not None and c.path not in held:
                held.add(c.path)
                c = c.parent
    return held


def main_text(html: str | None, known) -> str:
    """The text under the page's path: of the paths ``known`` of its host (path, wins; most
    votes first) the first winning one that holds text here, or one that scores more than
    ``MUCH`` times as high; the page's own best path counts too if it is not known to lose.
    Empty if no container holds text."""
    if not html:
        return ""
    containers = read_containers(html)
    own = best_path(containers)
    held = held_paths(containers)
    known = {} if known is None else {k["path"]: k["wins"] for k in known if k["path"] in held}
    kept = _up(containers, {c.path: 1 for c in containers if c.blocks}, max)
    paths = [p for p, wins in known.items() if wins and kept[p]]
    if own is not None and own not in known:
        paths.append(own)
    if len(paths) > 1:
        highest = _up(containers, container_scores(containers), max)
        inside = [highest[p] for p in paths]
        taken = 0
        for i in range(1, len(paths)):
            if inside[i] > MUCH * inside[taken]:
                taken = i
        paths = paths[taken:]
    if not paths:
        return "" if own is None else text_under(containers, own)
    return text_under(containers, paths[0])


# ------------------------------------------------------------------ operator

def host_paths(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(host, path, votes, wins): the paths that are the best of some page and hold text on
    two or more pages of the host, and whether they win there."""
    @F.pandas_udf("array<long>")
    def vote(htmls: pd.Series) -> pd.Series:
        def of(html):
            containers = read_containers(html) if html else []
            best = best_path(containers)
            return None if best is None else np.array([best, *sorted(held_paths(containers) - {best})], dtype=np.int64)
        return pd.Series([of(h) for h in htmls], dtype=object)
    votes = (pages.select("host", vote(F.col(html_col)).alias("paths")).filter("paths is not null")
             .select("host", F.posexplode("paths").alias("place", "path"))
             .groupBy("host", "path").agg(F.count("*").alias("held"), F.count_if(F.col("place") == 0).alias("votes")))
    return (votes.filter("votes > 0 and held > 1")
            .select("host", "path", "votes", (F.col("votes") >= MIN_RATE * F.col("held")).alias("wins")))


def _listed():
    """Paths of a group as an array, most votes first (ties: by hash)."""
    return F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("rank"), "path", "wins")))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """(id, url, text) per row.  Null or empty html gives an empty text; pages without a
    host (null url) vote together under the empty host; repeated rows give the same text
    each; extra columns play no part; pages of any length and depth are read whole, in time in
    proportion.  The table of paths is written, so the pages are read twice and no more."""
    base = split_url(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                                  F.col(html_col).alias("html")), "url").drop("path")
    paths = written(host_paths(base), "host-paths")
    if paths.count() <= BROADCAST_HOSTS:
        table = {r["host"]: [{"path": k["path"], "wins": k["wins"]} for k in r["known"]]
                 for r in paths.groupBy("host").agg(_listed().alias("known")).collect()}
        shared = broadcast_value(base, table)

        @F.pandas_udf("string")
        def extract(hosts: pd.Series, htmls: pd.Series) -> pd.Series:
            return pd.Series([main_text(h, shared.value.get(host)) for host, h in zip(hosts, htmls)], dtype=object)
        out = base.select("id", "url", extract("host", "html").alias("text"))
    else:
        # too many to send around: every different page asks for the paths it has, with
        # each path of a host spread over SALT keys
        @F.pandas_udf("array<long>")
        def held(htmls: pd.Series) -> pd.Series:
            return pd.Series([np.array(sorted(held_paths(read_containers(h))), dtype=np.int64) for h in htmls], dtype=object)

        @F.pandas_udf("string")
        def extract_by(known: pd.Series, htmls: pd.Series) -> pd.Series:
            return pd.Series([main_text(h, k) for k, h in zip(known, htmls)], dtype=object)
        keyed = base.withColumn("page", F.sha2("html", 256))
        salted = paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        asked = (keyed.filter("html is not null").select("host", "page", F.explode(held("html")).alias("path"))
                 .distinct().withColumn("salt", F.pmod(F.xxhash64("page"), F.lit(SALT)).cast("int")))
        known = asked.join(salted, ["host", "path", "salt"]).groupBy("host", "page").agg(_listed().alias("known"))
        out = keyed.join(known, ["host", "page"], "left").select("id", "url", extract_by("known", "html").alias("text"))
    return out
