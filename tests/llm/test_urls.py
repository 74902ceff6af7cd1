import math
import random
import re
from collections import Counter

import numpy as np

from tastemap.llm import urls

PAGES = "page_id long, url string, html string"

URLS = ["http://a.com/x?q#f", "https://EXAMPLE.com/en/1", "https://www.example.com/en/1", "https://m.example.com/en/",
        "https://example.com/de/", "http://b.net/es/1", "http://b.net/fr/", "http://b.net/de/2", "http://net/es/",
        "http://fakenet/es/", "http://b.net", "http://a.com", "http://a.com?x=/y", "http://a.com#/en/", "nothing",
        "", None, "x://b.net/esp", "ftp://u@c.org:80/p?q", "http://é.com/Ünï", "http://a.com/b://c.net/es/?x://y",
        "://", "http:///path", "http://www.Example.com/en/?a", "http://a.com/\nx"]


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:cut]


def brute_rule(host, path):
    best = None
    for verdict, rule in urls.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return best


def frame(spark, values):
    return spark.createDataFrame([(i, u, "<p>x") for i, u in enumerate(values)], PAGES)


def test_parts_rules_and_verdicts(spark):
    got = {r["id"]: r for r in urls.filter_urls(frame(spark, URLS)).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = brute_parts(u)
        rule = brute_rule(host, path)
        assert (got[i]["host"], got[i]["path"]) == (host, path), u
        assert got[i]["rule"] == (rule and rule[1]), u
        if rule:
            assert got[i]["verdict"] == rule[0]
        else:
            assert got[i]["verdict"] == ("allow" if got[i]["score"] >= got[i]["threshold"] else "block")


def brute_score(text, train, order):
    """Interpolated character models from plain dictionaries."""
    def counts(texts):
        with_symbol, context = Counter(), Counter()
        for t in texts:
            s = b"\x02" * order + t.encode() + b"\x03"
            for i in range(order, len(s)):
                for k in range(order + 1):
                    with_symbol[s[i - k:i + 1]] += 1
                    context[k, s[i - k:i]] += 1
        return with_symbol, context
    s = b"\x02" * order + text.encode() + b"\x03"
    total = 0.0
    for side, sign in ((True, 1), (False, -1)):
        both, context = counts([t for t, a in train if a == side])
        for i in range(order, len(s)):
            p = 1 / 256
            for k in range(order + 1):
                p = (both[s[i - k:i + 1]] + urls.MIX_WEIGHT * p) / (context[k, s[i - k:i]] + urls.MIX_WEIGHT)
            total += sign * math.log(p)
    return total / (len(s) - order)


def test_scores_match_plain_dictionaries(spark):
    train = [(f"http://good{i % 7}.com/page/{i}", True) for i in range(40)]
    train += [(f"https://bad{i % 5}.net/es/{i}?é", False) for i in range(30)]
    counts = urls.gram_counts(spark.createDataFrame([(*t,) for t in train] + [(None, True), ("", False)],
                                                    "text string, accepted boolean"))
    models = urls.CharModels.of(counts)
    texts = ["http://good3.com/page/99", "https://bad1.net/es/4", "something else", "x"]
    got = models.score([*texts, "", None])
    want = [brute_score(t, train, urls.ORDER) for t in texts]
    assert np.allclose(got[:4], want, atol=1e-3) and got[4] == got[5] == 0.0
    assert got[0] > 0 > got[1]


def test_filter_separates_unseen_urls(spark):
    values = [f"http://s{i}.com/articles/{i}" for i in range(60)] + [f"http://t{i}.net/es/casino/{i}" for i in range(60)]
    values += ["http://s5.org/articles/77", "http://t9.org/es/casino/12"]
    got = {r["id"]: r["verdict"] for r in urls.filter_urls(frame(spark, values)).collect()}
    assert got[120] == "allow" and got[121] == "block"


def test_edges(spark):
    assert urls.filter_urls(spark.createDataFrame([], PAGES)).count() == 0
    one_sided = urls.filter_urls(frame(spark, ["http://a.com/", "http://a.org/"])).collect()
    assert [r["verdict"] for r in one_sided] == ["allow", "allow"] and all(r["score"] == 0 for r in one_sided)
    extra = spark.createDataFrame([(1, "http://a.com/", 5, "h"), (1, "http://a.com/", 5, "h"), (None, "u" * 30_000, 1, "")],
                                  "page_id long, url string, score int, host string")
    rows = urls.filter_urls(extra).collect()
    assert len(rows) == 3 and sum(r["rule"] == "com/" for r in rows) == 2


def test_scores_stay_exact_beyond_half_a_million_grams(spark):
    """Far more different grams than fit 2**19 hash buckets: counts of unrelated contexts
    are not added together."""
    rng = random.Random(3)
    train = [("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=40)), i % 2 == 0) for i in range(20_000)]
    counts = urls.gram_counts(spark.createDataFrame(train, "text string, accepted boolean"))
    models = urls.CharModels.of(counts)
    assert models.counts.count() > 2 ** 19
    probes = [train[0][0][:15], train[1][0][-15:], "abcabcabc0"]
    got = models.score(probes)
    joined = {a: b"".join(b"\x02" * urls.ORDER + t.encode() + b"\x03" for t, x in train if x == a) for a in (True, False)}

    def seen(side, pattern):
        return sum(1 for _ in re.finditer(b"(?=" + pattern + b")", joined[side], re.S))
    for text, score in zip(probes, got):
        s = b"\x02" * urls.ORDER + text.encode() + b"\x03"
        total = 0.0
        for i in range(urls.ORDER, len(s)):
            for side, sign in ((True, 1), (False, -1)):
                p = 1 / 256
                for k in range(urls.ORDER + 1):
                    p = ((seen(side, s[i - k:i + 1]) + urls.MIX_WEIGHT * p)
                         / (seen(side, s[i - k:i] + b"[^\x02]") + urls.MIX_WEIGHT))
                total += sign * math.log(p)
        assert abs(total / (len(s) - urls.ORDER) - score) < 1e-9
